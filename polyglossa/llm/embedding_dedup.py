"""Near-duplicate vectors by collision counting on sorted one-dimensional projections.

Unit vectors are projected on LINES random lines. On each line the vectors are sorted, and two of them collide if one lies
in the window centred at the other. The difference of two projections is normal with the vectors' distance as its standard
deviation, whatever their dimension, and lines are independent; so the collisions of a pair are binomial, and the count
that a pair needs is the largest one that a pair of exactly the threshold reaches with the recall asked for. Pairs that
reach it are verified by their cosine.

Blocks. The vectors of a label are cut into blocks of bounded size by the quantiles of one projection after another (each
level sorts the parts that are still too big by another line). Two blocks meet only if the ranges of their projections
come within a window on as many lines as the count asks for, which no colliding pair can miss. A vector travels once for
each block that its own block meets; pairs never travel: they are counted inside the meeting and leave it as counts and
spanning links.

What the method costs: a window holds a share of all vectors however narrow it is (one dimension separates near from far
by the ratio of their distances alone), so scattered vectors of one label meet block by block, (size / block)² / 2
meetings, of which clustered ones skip those of far blocks.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, local_roots, named, staged, table, tidy, told_apart, whole_groups, whole_ids, wide

THRESHOLD, RECALL = 0.93, 0.9995
#: Lines, and half the width of a window in distances of a pair of the threshold.
LINES, WIDTH = 40, 1.0
#: Vectors of a block, most parts that one projection cuts a block into, and projections that cut.
BLOCK, BRANCHES, LEVELS = 2048, 16, 5


def half_window(threshold: float) -> float:
    return WIDTH * math.sqrt(2 - 2 * threshold)


def chance(cosine: float, threshold: float) -> float:
    """The chance that two unit vectors of this cosine collide on a line."""
    apart = math.sqrt(max(2 - 2 * cosine, 1e-300))
    return math.erf(half_window(threshold) / apart / math.sqrt(2))


def reached(q: float, count: int, lines: int) -> float:
    """The chance of at least `count` collisions on the lines, for one of q a line."""
    return sum(math.comb(lines, i) * q**i * (1 - q) ** (lines - i) for i in range(count, lines + 1))


@lru_cache(64)
def needed(threshold: float, recall: float, lines: int = LINES) -> int:
    """The most collisions that a pair of exactly the threshold reaches with the recall; an error if that is none."""
    if not -1 <= threshold < 1:
        raise ValueError("the threshold must be from -1 to less than 1")
    q = chance(threshold, threshold)
    count = max((c for c in range(1, lines + 1) if reached(q, c, lines) >= recall), default=0)
    if not count:
        raise ValueError(f"{lines} lines cannot reach a recall of {recall}")
    return count


@lru_cache(16)
def _lines(dim: int) -> np.ndarray:
    return np.random.default_rng(7_919).standard_normal((dim, LINES))


def _vectors(column) -> np.ndarray:
    """Vectors scaled by a power of two each, so that no square overflows or vanishes and no digit changes."""
    x = np.stack([np.asarray(v, np.float64) for v in column])
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _projected(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ _lines(x.shape[1])


def _leads(batches):
    """The projections that blocks are cut by."""
    for pdf in batches:
        for _, own in pdf.groupby("dim"):
            p = _projected(_vectors(own["embedding"]))[:, :LEVELS]
            yield own[["label", "dim", "cid"]].assign(lead=list(p))


_BLOCK = ["label", "dim", "block"]


def _ranges(batches):
    """The smallest and the greatest projection on every line, of each block's rows in a batch."""
    for pdf in batches:
        for _, own in pdf.groupby(_BLOCK):
            p = _projected(_vectors(own["embedding"]))
            yield own[_BLOCK].iloc[:1].assign(low=[p.min(axis=0)], high=[p.max(axis=0)])


def _blocks(placed: DataFrame, block: int) -> DataFrame:
    """(label, dim, cid, block) for (label, dim, cid, lead)."""
    at = placed.withColumn("block", F.lit(0).cast("long"))
    quantiles = [i / BRANCHES for i in range(1, BRANCHES)]
    for level in range(LEVELS):
        own = F.col("lead")[level]
        big = at.groupBy(*_BLOCK).agg(F.count("*").alias("n"), F.percentile_approx(own, quantiles, 1000).alias("cuts")).where(F.col("n") > block)
        if big.isEmpty():
            break
        # no more parts than bring a block under its size: each one more is a journey more of all vectors of a label
        every = F.greatest(F.lit(1), F.lit(BRANCHES) / F.pow(F.lit(2), F.ceil(F.log2(F.col("n") / block)))).cast("int")
        big = big.withColumn("every", every).withColumn("cuts", F.filter("cuts", lambda c, i: (i + 1) % F.col("every") == 0)).drop("every")
        # approximate quantiles may repeat or miss; any cuts are right, they only decide sizes
        part = F.coalesce(F.size(F.filter("cuts", lambda c: c < own)), F.lit(0))  # noqa: B023
        at = at.join(big.drop("n"), _BLOCK, "left").select("label", "dim", "cid", "lead", (F.col("block") * BRANCHES + F.when(F.col("cuts").isNull(), 0).otherwise(part)).alias("block"))
        at = staged(at, "cuts")
    sizes = at.groupBy(*_BLOCK).agg(F.count("*").alias("n"))
    # what lines cannot tell apart is dealt out by hash
    parts = F.ceil(F.col("n") / (2 * block)).cast("long")
    return at.join(sizes, _BLOCK).select("label", "dim", "cid", (F.col("block") * 2**24 + F.pmod(F.xxhash64("cid"), parts)).alias("block"))


def _meetings(vectors: DataFrame, threshold: float, count: int) -> DataFrame:
    """(label, dim, x, y): the pairs of blocks, each with itself too, that may hold a pair with enough collisions."""
    spark, half, salts = vectors.sparkSession, half_window(threshold), wide(vectors.sparkSession)
    blocks = vectors.select(*_BLOCK).distinct()
    alone = blocks.select("label", "dim", F.col("block").alias("x"), F.col("block").alias("y"))
    several = blocks.groupBy("label", "dim").agg(F.count("*").alias("n")).where("n > 1").select("label", "dim")
    if several.isEmpty():
        return alone
    kind = dict(vectors.dtypes)["label"]
    told = vectors.join(several, ["label", "dim"], "left_semi").select(*_BLOCK, "embedding").mapInPandas(tidy(_ranges), f"label {kind}, dim int, block long, low array<double>, high array<double>")
    over = lambda f, c: F.array(*(f(F.col(c)[i]) for i in range(LINES))).alias(c)
    ranges = staged(told.groupBy(*_BLOCK).agg(over(F.min, "low"), over(F.max, "high")), "ranges")
    x = ranges.select("label", "dim", F.col("block").alias("x"), F.col("low").alias("xl"), F.col("high").alias("xh"), F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"))
    y = ranges.select("label", "dim", F.col("block").alias("y"), F.col("low").alias("yl"), F.col("high").alias("yh"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = F.aggregate(F.sequence(F.lit(0), F.lit(LINES - 1)), F.lit(0), lambda n, i: n + F.when((F.get("xl", i) - half <= F.get("yh", i)) & (F.get("yl", i) - half <= F.get("xh", i)), 1).otherwise(0))
    return alone.unionByName(x.join(y, ["label", "dim", "salt"]).where((F.col("x") < F.col("y")) & (met >= count)).select("label", "dim", "x", "y"))


def collisions(p: np.ndarray, q: np.ndarray, half: float) -> np.ndarray:
    """How often each row of p collides with each row of q: per line, q is sorted, and p's windows are stretches of its ranks."""
    kind = np.min_scalar_type(len(q))
    out, rank = np.zeros((len(p), len(q)), np.min_scalar_type(p.shape[1])), np.empty(len(q), kind)
    for k in range(p.shape[1]):
        order = np.argsort(q[:, k], kind="stable")
        line = q[order, k]
        rank[order] = np.arange(len(q))
        first = np.searchsorted(line, p[:, k] - half, side="left")
        width = (np.searchsorted(line, p[:, k] + half, side="right") - first).astype(kind)[:, None]
        first = first.astype(kind)[:, None]
        for lo in range(0, len(p), 64):
            some = slice(lo, lo + 64)
            # ranks before a window wrap round and are no part of it either
            out[some] += (rank - first[some]) < width[some]
    return out


_MEETING = ["label", "dim", "x", "y"]


def _linked(threshold: float, count: int):
    half = half_window(threshold)

    def of(batches):
        for pdf, first in whole_groups(batches, _MEETING, 2_000):
            ends = np.append(first, len(pdf))[1:]
            block, xs, ys = (pdf[c].to_numpy() for c in ("block", "x", "y"))
            copies, cid = pdf["copies"].to_numpy(np.int64), pdf["cid"].to_numpy(np.int64)
            links, root = np.zeros(len(pdf), np.int64), cid.copy()
            for at, end in zip(first.tolist(), ends.tolist(), strict=True):
                if end - at < 2:
                    continue
                x = _vectors(pdf["embedding"].iloc[at:end])
                p, norm = _projected(x), np.sqrt((x * x).sum(axis=1))
                apart = xs[at] != ys[at]
                left = np.flatnonzero(block[at:end] == xs[at])
                right = np.flatnonzero(block[at:end] == ys[at])
                all_a, all_b = [], []
                for lo in range(0, len(left), 512):
                    # a block with itself: what lies before a stretch was counted with the stretches before it
                    some, others = left[lo : lo + 512], right if apart else right[lo:]
                    i, j = np.nonzero(collisions(p[some], p[others], half) >= count)
                    a, b = some[i], others[j]
                    if not apart:  # a block with itself: each pair once
                        a, b = a[a < b], b[a < b]
                    for k in range(0, len(a), 100_000):
                        c, d = a[k : k + 100_000], b[k : k + 100_000]
                        yes = np.einsum("ij,ij->i", x[c], x[d]) / (norm[c] * norm[d]) >= threshold
                        all_a.append(c[yes])
                        all_b.append(d[yes])
                a, b = np.concatenate([np.zeros(0, int), *all_a]), np.concatenate([np.zeros(0, int), *all_b])
                if len(a):
                    own, mine = copies[at:end], cid[at:end]
                    links[at:end] = np.bincount(a, own[b], end - at) + np.bincount(b, own[a], end - at)
                    v, r = local_roots(mine[a], mine[b])
                    root[at:end] = np.where(np.isin(mine, v), r[np.searchsorted(v, mine).clip(0, len(v) - 1)], mine)
            has = links > 0
            yield pd.DataFrame({"cid": cid[has], "root": root[has], "links": links[has]})

    return of


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id and kept.

    Rows link when their labels are equal and not null and their cosine, in double precision, is the threshold or more.
    Null, empty and zero vectors and those with null or non-finite components link with nothing, as do rows without id;
    vectors of different length never link. Equal vectors are met once and count with their number. component_id is
    the smallest vec_id reachable by links; the row whose id it is is kept. Rows that share an id are
    rows of their own and link like others. Ids that are no whole numbers are ordered as they are. Raises an error where
    the lines cannot reach the recall. Only the three columns are read.
    """
    spark, count = vectors.sparkSession, needed(threshold, recall)
    kind = vectors.schema["embedding"].dataType.elementType
    exact = kind if isinstance(kind, (T.FloatType, T.DoubleType)) else T.DoubleType()
    rows, names = whole_ids(vectors.select("vec_id", "label", F.col("embedding").cast(T.ArrayType(exact)).alias("embedding")), "vec_id")
    fine = "label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf')) AND exists(embedding, v -> v <> 0)"
    rows = rows.withColumn("fine", F.expr(f"coalesce({fine}, false)"))
    classes = rows.where("fine").groupBy("label", "embedding").agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"))
    classes, key = told_apart(staged(classes.withColumn("dim", F.size("embedding")), "vectors"), "cid")
    own = None if key == "cid" else classes.select(F.col(key).alias("n"), F.col("cid").alias("name"))
    classes = classes.withColumn("cid", F.col(key)).select("label", "embedding", "cid", "copies", "dim")
    label = dict(rows.dtypes)["label"]
    # Projections alone, not vectors, decide the blocks.
    placed = classes.select("label", "dim", "cid", "embedding").mapInPandas(tidy(_leads), f"label {label}, dim int, cid long, lead array<double>")
    dealt = staged(classes.join(_blocks(staged(placed, "leads"), block), ["label", "dim", "cid"]), "blocks")
    meetings = _meetings(dealt, threshold, count).withColumn("block", F.explode(F.array_distinct(F.array("x", "y"))))
    met = dealt.join(meetings, _BLOCK).repartition(wide(spark), *_MEETING).sortWithinPartitions(*_MEETING)
    told = met.select(*_MEETING, "block", "cid", "copies", "embedding").mapInPandas(tidy(_linked(threshold, count)), "cid long, root long, links long")
    told = staged(told, "links")
    group = components(told.where("cid <> root"), "cid", "root").withColumnRenamed("node", "cid")
    links = told.groupBy("cid").agg(F.sum("links").alias("links"))
    answer = classes.join(links, "cid", "left").join(group, "cid", "left")
    answer = answer.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"), F.lit(True).alias("fine"))
    out = rows.join(named(answer, own, ["component_id"]), ["label", "embedding", "fine"], "left")
    component = F.coalesce("component_id", "vec_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    return named(out, names, ["vec_id", "component_id"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / pow(2.0, floor(log2(list_max(list_transform(embedding, lambda y: abs(y::DOUBLE))))))) AS e
  FROM embeddings WHERE label IS NOT NULL AND list_max(list_transform(embedding, lambda y: abs(y::DOUBLE))) > 0
), n AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) = e.vec_id AS kept
FROM embeddings e
"""
