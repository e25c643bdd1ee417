"""Product codes of vectors: one codebook a part, learned by Elkan's form of Lloyd's rounds over whole numbers.

Each component becomes floor(scale * x). For every part of every vector the state between rounds is its entry, an upper
bound of the distance to it and one lower bound per entry. When entries move, upper bounds grow by the movement of the own
entry and lower bounds shrink by that of each other one. A part is left alone if its upper bound is less than half the
distance from its entry to the nearest other one; else an entry is looked at only if neither its lower bound nor half its
distance from the own entry is greater than the upper bound. Both comparisons are strict, and bounds are rounded away from
the truth, so an entry that is passed over is strictly farther: what decides, ties too, are squared distances in whole
numbers, of which the lowest index wins.

The state is a table beside the vectors' numbers in the shared folder. A lower bound is one byte there, in steps of a
width common to a part and rounded down (a smaller bound only prunes less), so the state of a vector of 64 components
takes 1.1 KB. Sums and counts of entries are added up in tasks, then by Spark; at most parts x entries rows come to
the driver, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Greatest absolute value of scale * x for which all sums of squares fit in 64 bits.
GREATEST = 2**28
#: Labels of a thousandth of all rows or more; there are at most a thousand of them, and they are broadcast.
HOT = 1000


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x * (1 + 1e-12), np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.asarray(x * (1 - 1e-12), np.float32), np.float32(-np.inf)), np.float32(0))


class Codebooks:
    """entries[part, entry, position], and how far entries are from one another, rounded down."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        parts, n, _ = entries.shape
        self.apart = np.zeros((parts, n, n), np.float32)
        for i in range(parts):
            d = entries[i][:, None, :] - entries[i][None, :, :]
            self.apart[i] = _down(np.sqrt((d * d).sum(axis=2).astype(np.float64)))
        lone = self.apart + np.where(np.eye(n, dtype=bool), np.float32(np.inf), np.float32(0))
        self.nearest = lone.min(axis=2) / 2
        #: Width of the steps of stored lower bounds: 255 of them reach as far as entries are apart.
        self.step = np.maximum(self.apart.max(axis=(1, 2)) / 255, np.float32(1 / 16))

    def moved(self, after: Codebooks) -> np.ndarray:
        d = after.entries - self.entries
        return _up(np.sqrt((d * d).sum(axis=2).astype(np.float64))) * (d != 0).any(axis=2)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def first_assignment(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, upper, lower) of a part of some vectors, from all distances."""
    d = np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)
    own = d.argmin(axis=1)  # the first of equal ones
    root = np.sqrt(d.astype(np.float64))
    return own, _up(root[np.arange(len(x)), own]), _down(root)


def next_assignment(x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, books: Codebooks, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry, upper, lower, distances computed) of a part, from bounds that hold for the entries of books."""
    entries, rows = books.entries[part], np.arange(len(x))
    own, upper, lower = own.copy(), upper.copy(), lower.copy()
    open_ = np.flatnonzero(upper >= books.nearest[part][own])
    if not len(open_):
        return own, upper, lower, 0
    squared = ((x[open_] - entries[own[open_]]) ** 2).sum(axis=1)
    upper[open_] = _up(np.sqrt(squared.astype(np.float64)))
    bound = np.maximum(lower[open_], books.apart[part][own[open_]] / 2)
    bound[rows[: len(open_)], own[open_]] = np.inf
    i, j = np.nonzero(upper[open_][:, None] >= bound)
    d = ((x[open_[i]] - entries[j]) ** 2).sum(axis=1)
    lower[open_[i], j] = _down(np.sqrt(d.astype(np.float64)))
    lower[open_, own[open_]] = _down(np.sqrt(squared.astype(np.float64)))
    # candidates stand by row, then by entry, so the first of equal distances has the lowest index
    best, at = squared.copy(), own[open_].copy()
    order = np.lexsort((j, d, i))
    i, j, d = i[order], j[order], d[order]
    head = np.flatnonzero(np.diff(i, prepend=-1))
    better = (d[head] < best[i[head]]) | ((d[head] == best[i[head]]) & (j[head] < at[i[head]]))
    best[i[head[better]]], at[i[head[better]]] = d[head[better]], j[head[better]]
    own[open_] = at
    upper[open_] = _up(np.sqrt(best.astype(np.float64)))
    return own, upper, lower, len(open_) + len(d)


def _numbers(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """ints[row, part, position]."""
    flat = batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(batch.num_rows, parts, -1)


def _fixed(column, n: int, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), n)


def _binary(a: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())


_STATE = "own binary, upper binary, lower binary"


def _stepped(lower: np.ndarray, step: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(lower / step), 255).astype(np.uint8)


def _assigned(books: Codebooks, before: Codebooks | None):
    """Batches with the state for books; the bounds that a batch has are those for the codebooks before."""
    parts, n, _ = books.entries.shape
    moved = before.moved(books) if before else None

    def of(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _numbers(batch, parts)
            own, upper, lower = np.empty((len(x), parts), np.uint8), np.empty((len(x), parts), np.float32), np.empty((len(x), parts, n), np.uint8)
            if before:
                o, u, b = _fixed(batch.column("own"), parts, np.uint8), _fixed(batch.column("upper"), parts, np.float32), _fixed(batch.column("lower"), parts * n, np.uint8).reshape(-1, parts, n)
            for i in range(parts):
                if before:
                    grown = np.nextafter(u[:, i] + moved[i][o[:, i]], np.float32(np.inf))
                    shrunk = np.maximum(np.nextafter(b[:, i] * before.step[i] - moved[i], np.float32(-np.inf)), np.float32(0))
                    own[:, i], upper[:, i], low, _ = next_assignment(x[:, i], o[:, i].astype(np.int64), grown, shrunk, books, i)
                else:
                    own[:, i], upper[:, i], low = first_assignment(x[:, i], books.entries[i])
                lower[:, i] = _stepped(np.nextafter(low, np.float32(0)), books.step[i])
            kept = batch.select([c for c in batch.schema.names if c not in ("own", "upper", "lower")])
            yield pa.RecordBatch.from_arrays([*kept.columns, _binary(own), _binary(upper), _binary(lower.reshape(len(x), -1))], names=[*kept.schema.names, "own", "upper", "lower"])

    return of


def _summed(shape: tuple[int, int, int]):
    """The sums and counts of the parts of each entry, of all rows of a task."""
    parts, n, width = shape

    def of(batches):
        sums, counts = np.zeros((parts * n, width), np.int64), np.zeros(parts * n, np.int64)
        for batch in batches:
            if batch.num_rows:
                x, own = _numbers(batch, parts), _fixed(batch.column("own"), parts, np.uint8)
                for i in range(parts):
                    counts[i * n : (i + 1) * n] += np.bincount(own[:, i], minlength=n)
                    np.add.at(sums, i * n + own[:, i].astype(np.int64), x[:, i])
        used = np.flatnonzero(counts)
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), values], names=["entry", "n", "sums"])

    return of


def _coded(books: Codebooks):
    parts = books.entries.shape[0]

    def of(batches):
        for batch in batches:
            if batch.num_rows:
                x, own = _numbers(batch, parts), _fixed(batch.column("own"), parts, np.uint8).astype(np.int64)
                apart = x - books.entries[np.arange(parts)[None, :], own]
                kept = batch.select([c for c in batch.schema.names if c not in ("own", "ints")])
                codes = pa.array([r.astype(np.uint8).tobytes().hex() for r in own], pa.string())
                yield pa.RecordBatch.from_arrays([*kept.columns, codes, pa.array((apart * apart).sum(axis=(1, 2)))], names=[*kept.schema.names, "code", "error"])

    return of


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    width = books.entries.shape[2]
    part = state.select("ints", "own").mapInArrow(tidy(_summed(books.entries.shape)), "entry int, n long, sums array<long>")
    rows = part.groupBy("entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[k]) for k in range(width))).alias("sums")).collect()
    entries = books.entries.copy()
    for r in rows:
        entries.reshape(-1, width)[r["entry"]] = [s // r["n"] for s in r["sums"]]
    return Codebooks(entries)


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, carry: tuple[str, ...] = ()) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, carried columns, code, error) of the kept rows of vectors (vec_id, embedding), and the final codebooks.

    Rows are kept whose vector has only finite components and as many of them as the kept one of the smallest vec_id, a
    number that `parts` divides; others are left out. Null ids count as the greatest; rows that share an id are told apart
    by their components, and equal rows are rows of their own. Codebooks begin with the parts of the first `entries` rows
    (of all, if there are fewer). Without kept rows the codebooks are None. An error is raised where scale * x exceeds 2**28, for
    which squares would not fit in 64 bits. entries is 256 at most. Only vec_id, embedding and the carried columns are read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index of an entry has one byte")
    fine = F.expr(f"embedding IS NOT NULL AND size(embedding) > 0 AND size(embedding) % {parts} = 0 AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf'))")
    rows = vectors.where(fine).select(F.col("vec_id").alias("_id"), *(F.col(c).alias(f"_carried{i}") for i, c in enumerate(carry)), "embedding")
    number = lambda v: F.when(F.abs(v.cast("double")) * scale > GREATEST, F.raise_error(F.lit(f"a component times {scale} exceeds 2**28")).cast("int")).otherwise(F.floor(v.cast("double") * scale).cast("int"))
    order = [F.col("_id").asc_nulls_last(), "ints"]
    rows = rows.select(*(c for c in rows.columns if c != "embedding"), F.transform("embedding", number).alias("ints"))
    first = rows.orderBy(*order).limit(1).select(F.size("ints").alias("n")).collect()
    named = [F.col("_id").alias("vec_id"), *(F.col(f"_carried{i}").alias(c) for i, c in enumerate(carry))]
    if not first:
        return rows.select(*named, F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    rows = rows.where(F.size("ints") == first[0]["n"])
    start = np.array([r["ints"] for r in rows.orderBy(*order).limit(entries).select("ints").collect()], np.int64)
    books, before, state = Codebooks(start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy()), None, rows
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    for _ in range(rounds):
        state = staged(state.mapInArrow(tidy(_assigned(books, before)), f"{own}, {_STATE}"), "codes")
        before, books = books, _updated(state, books)
    state = state.mapInArrow(tidy(_assigned(books, before)), f"{own}, {_STATE}").drop("upper", "lower")
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ints")
    return state.mapInArrow(tidy(_coded(books)), f"{own}, code string, error long").select(*named, "code", "error"), books


def with_totals(rows: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """rows with the sum of value over the rows of the same key, nulls together.

    Sums of frequent keys (at most HOT of them) are broadcast, those of rare ones are joined, so no task gets a hot key.
    """
    rows = staged(rows, "valued")
    told = staged(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(total), F.count("*").alias("_n")), "totals")
    least = (told.agg(F.sum("_n")).first()[0] or 0) / HOT
    hot = told.where(F.col("_n") >= least).select("_key", total, F.lit(True).alias("_hot"))
    rare = told.where(F.col("_n") < least).select("_key", total)
    one = rows.join(F.broadcast(hot), rows[key].eqNullSafe(F.col("_key")), "left").drop("_key")
    often = one.where("_hot").drop("_hot")
    seldom = one.where("_hot IS NULL").drop("_hot", total)
    return often.unionByName(seldom.join(rare.hint("merge"), seldom[key].eqNullSafe(F.col("_key"))).drop("_key"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"), carry=("label",))
    told = with_totals(codes, "label", "error", "label_error")
    return told.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))


def _sql_round(k: int) -> str:
    """Assignment a{k} to the entries c{k}, and the entries after it."""
    return f"""
d{k} AS (SELECT r, x.i, j, list_sum(list_transform(range(1, len(x.v) + 1), lambda q: (x.v[q] - c.v[q]) * (x.v[q] - c.v[q])))::BIGINT AS d FROM part x JOIN c{k} c USING (i)),
a{k} AS MATERIALIZED (SELECT r, i, arg_min(j, [d, j]) AS j, min(d) AS d FROM d{k} GROUP BY r, i),
s{k} AS (SELECT i, j, q, sum(v[q])::HUGEINT AS s, count(*) AS n FROM a{k} JOIN part USING (r, i), unnest(range(1, width + 1)) AS u(q) GROUP BY i, j, q),
m{k} AS (SELECT i, j, list((CASE WHEN s < 0 THEN -((-s + n - 1) // n) ELSE s // n END)::BIGINT ORDER BY q) AS v FROM s{k} GROUP BY i, j),
c{k + 1} AS MATERIALIZED (SELECT c.i, c.j, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m USING (i, j)),"""


ORACLE = f"""
WITH x AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), part AS MATERIALIZED (SELECT r, i, len(v) // 16 AS width, v[i * (len(v) // 16) + 1:(i + 1) * (len(v) // 16)] AS v FROM x, unnest(range(16)) AS u(i)),
c0 AS MATERIALIZED (SELECT i, r AS j, v FROM part WHERE r < 64),
{_sql_round(0)}{_sql_round(1)}{_sql_round(2)}
told AS (SELECT r, string_agg(printf('%02x', j), '' ORDER BY i) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY i, j)) AS s FROM c2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, s AS codebooks_sha256 FROM x JOIN told USING (r), books
"""
