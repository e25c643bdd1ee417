"""Exact top-k search by inner product: tiled matrix products, a selection per tile, and a tree of merges.

Queries are dealt into blocks of bounded size and candidates into shards; a tile is one block against one shard, numbered,
and a task of its own or one of few. In a task the tile's queries come first; candidates then pass by in batches, of which
each is multiplied with the queries and leaves, with what was best before, k rows a query. So a tile leaves k rows a query
however many candidates it saw. Lists of a query are then merged FAN at a time until one is left, so that no
group holds more than FAN lists.

Scores are whole numbers. Products are taken in double precision where no sum can exceed 2**53, else in 64-bit integers;
vectors whose scores might exceed those give an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, table, tidy, told_apart, wide

TOP, SCALE = 10, 1024
#: Queries of a block, candidates of a shard, and lists that are merged at once.
QUERIES, SHARD, FAN = 4096, 1 << 18, 16
#: Queries and candidates that are multiplied at once.
STRIPE, BATCH = 256, 4096
_LEAST = np.iinfo(np.int64).min


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of all rows of two arrays of whole numbers, exactly."""
    most = a.shape[1] * max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min()))) if a.size and b.size else 0
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    raise ValueError("the scores of these vectors would not fit in 64 bits")


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k greatest scores of each row (all, if fewer), of equal ones the first, by column."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    level = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    above = scores > level
    ties = scores == level
    take = above | (ties & (np.cumsum(ties, axis=1) <= k - above.sum(axis=1)[:, None]))
    return np.nonzero(take)[1].reshape(len(scores), k)


class _Best:
    """The best k candidates so far of each query of a tile, for vectors of one length."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> None:
        self.keys, self.ids, self.x, self.k = keys, ids, x, k
        self.scores, self.found = np.empty((len(keys), 0), np.int64), np.empty((len(keys), 0), np.int64)

    def meet(self, keys: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        keys, ids, y = keys[order], ids[order], y[order]
        parts = []
        for at in range(0, len(self.keys), STRIPE):
            own = slice(at, at + STRIPE)
            scores = products(self.x[own], y)
            scores[self.keys[own, None] == keys[None, :]] = _LEAST  # a query is no candidate of its own
            take = select(scores, self.k)
            found = np.concatenate([self.found[own], ids[take]], axis=1)
            scores = np.concatenate([self.scores[own], np.take_along_axis(scores, take, 1)], axis=1)
            by_id = np.argsort(found, axis=1, kind="stable")
            found, scores = np.take_along_axis(found, by_id, 1), np.take_along_axis(scores, by_id, 1)
            take = select(scores, self.k)
            parts.append((np.take_along_axis(found, take, 1), np.take_along_axis(scores, take, 1)))
        self.found, self.scores = (np.concatenate([p[i] for p in parts]) for i in (0, 1))

    def lists(self, shard: int) -> pa.RecordBatch | None:
        real = self.scores != _LEAST
        ends = np.cumsum([0, *real.sum(axis=1)])
        told = pa.StructArray.from_arrays([pa.array(-self.scores[real]), pa.array(self.found[real])], names=["down", "vec_id"])
        return pa.RecordBatch.from_arrays([pa.array(self.keys), pa.array(self.ids), pa.array(np.full(len(self.keys), shard, np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), told)], names=["key", "query_id", "shard", "top"])


_LISTS = "key long, query_id long, shard long, top array<struct<down:bigint,vec_id:bigint>>"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _tiles(k: int, shards: int):
    """The lists of every tile, from rows sorted by tile, length and role: queries (role 0) before candidates."""

    def of(batches):
        at, asked, best = None, [], None

        def ended():
            if best is not None:
                yield best.lists(at[0] % shards)

        for whole in batches:
            for begin in range(0, whole.num_rows, BATCH):
                batch = whole.slice(begin, BATCH)
                columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "dim", "role", "key", "vec_id")]
                new = np.flatnonzero(np.any([np.diff(c, prepend=c[0] - 1) != 0 for c in columns[:3]], axis=0))
                for lo, hi in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows], strict=True):
                    tile, dim, role = (int(c[lo]) for c in columns[:3])
                    keys, ids, x = columns[3][lo:hi], columns[4][lo:hi], _matrix(batch.slice(lo, hi - lo))
                    if (tile, dim) != at:
                        yield from ended()
                        at, asked, best = (tile, dim), [], None
                    if role == 0:
                        asked.append((keys, ids, x))
                        continue
                    if best is None and asked:
                        best = _Best(*(np.concatenate(p) for p in zip(*asked, strict=True)), k)
                    if best is not None:
                        best.meet(keys, ids, x)
        yield from ended()

    return of


def top_k(rows: DataFrame, asked: str, k: int = TOP, block: int = QUERIES, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (key, vec_id, ints) for which the SQL condition `asked` holds.

    Every row but the query's own is a candidate; key tells rows apart. The k greatest inner products are returned (all, if
    fewer), ranked from 1, of equal ones that of the smaller vec_id first. A row meets only vectors of its own length. Rows
    that share an id are queries and candidates of their own. Rows whose vector is null or has a null number, and rows without id, take
    no part.
    """
    spark = rows.sparkSession
    rows = staged(rows.where("vec_id IS NOT NULL AND ints IS NOT NULL AND forall(ints, v -> v IS NOT NULL)").select("key", "vec_id", "ints"), "searched")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(F.expr(asked)).alias("q")).first()
    # at least as many shards as tasks, so that a small table keeps all of them busy
    shards, blocks = max(math.ceil(sizes["n"] / shard), wide(spark)), max(math.ceil(sizes["q"] / block), 1)
    own = lambda n, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = rows.where(asked).select("*", F.lit(0).alias("role"), own(blocks, 1).alias("block"), every(shards).alias("shard"))
    candidates = rows.select("*", F.lit(1).alias("role"), every(blocks).alias("block"), own(shards, 2).alias("shard"))
    both = queries.unionByName(candidates).select((F.col("block") * shards + F.col("shard")).alias("tile"), F.size("ints").alias("dim"), "role", "key", "vec_id", "ints")
    tasks = min(shards * blocks, max(shards, wide(spark)))
    dealt = both.repartitionById(tasks, F.pmod("tile", F.lit(tasks)).cast("int")).sortWithinPartitions("tile", "dim", "role")
    lists = dealt.mapInArrow(tidy(_tiles(k, shards)), _LISTS)
    while shards > 1:
        lists = lists.groupBy("key", "query_id", F.floor(F.col("shard") / FAN).alias("shard")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        shards = math.ceil(shards / FAN)
    return lists.select("query_id", F.posexplode("top").alias("at", "one")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.down")).alias("score"))


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(key, vec_id, ints): floor(scale * x) of every component; without vectors that are null, empty or have null or non-finite components.

    An error is raised where scale * x does not fit in 64 bits. key is a number that tells rows apart.
    """
    kind = vectors.schema["vec_id"].dataType
    if not isinstance(kind, T.IntegralType):
        raise ValueError("vec_id must be a whole number")
    rows, key = told_apart(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "vec_id")
    fine = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf'))"
    number = lambda v: F.when(F.abs(v.cast("double")) * scale >= 2.0**63, F.raise_error(F.lit("a number does not fit in 64 bits")).cast("long")).otherwise(F.floor(v.cast("double") * scale))
    return rows.where(fine).select(F.col(key).alias("key"), "vec_id", F.transform("embedding", number).alias("ints"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(whole_numbers(table(spark, sf_dir, "embeddings")), "vec_id % 100 = 0")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
