"""Similarity join on word shingles: a MinHash LSH forest retrieves pairs, exact Jaccard decides.

Equal texts are one class. Each class gets a signature of DEPTH minima in each of TREES trees. A tree is the sorted list of
its signatures: classes with a common prefix stand together, as below a node of a trie. The deepest prefixes are matched
first: at each depth, from DEPTH down, two classes meet if this is the longest prefix they share in any tree, in the first
tree in which they share so much. Pairs that meet are verified exactly. Then the prefixes are shortened by one, until the
recall is reached: either as measured on the links found (each link of similarity s was found with the known chance
1 - (1 - s^depth)^TREES, and the sum of its inverses estimates all links), or, without counting on the data, because at
this depth a pair of exactly the threshold meets with the chance asked for.

Large groups are cut into blocks and met block by block, so that no task holds a whole group, and pairs are counted inside
their block: what leaves it are counts and spanning links, never pairs.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, Windows, components, compressed, decompressor, local_roots, mixed, named, shingles, staged, table, tidy, told_apart, whole_groups, whole_ids, wide, word_chunks

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH, RECALL = 16, 6, 0.9995
#: Classes of a group that one task meets with as many others at most.
BLOCK = 400
#: Links that must be known before their similarities count as a measure of the recall.
MEASURED = 20_000
#: Steps of the similarity in which links are counted for that measure.
BINS = 1000


def met(similarity: float | np.ndarray, depth: int, trees: int = TREES):
    """The chance that a pair of this similarity shares a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def shortest_prefix(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> tuple[int, int]:
    """(depth, trees): the depth at which a pair of exactly the threshold meets with the recall, and the trees for it.

    Trees are added where even prefixes of one minimum would miss the recall.
    """
    while depth > 1 and met(threshold, depth, trees) < recall:
        depth -= 1
    return depth, max(trees, 1 if threshold >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))


def measured_recall(links: dict[int, int], depth: int, trees: int = TREES) -> float:
    """The share of all links that those found so far are, from how many were found in each step of the similarity."""
    found = sum(links.values())
    return found / sum(n / met(b / BINS, depth, trees) for b, n in links.items()) if found else 0.0


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20240517).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signatures(shingle: int, trees: int, shortest: int, depth: int):
    """Per row and tree (empty without shingles): hashes of the prefixes of the signature, from the shortest to the whole."""
    levels = depth - shortest + 1

    def of(batches):
        hashes, windows, odd = WordHashes(), Windows(), _multipliers(trees * depth)
        for batch in batches:
            prefixes = []
            for _, counts, w in word_chunks(batch.column("text").cast(pa.binary()).to_pylist(), hashes, 1 << 16):
                row, h = shingles(counts, w, windows, shingle)
                if len(row) and (np.diff(row) < 0).any():
                    order = np.argsort(row, kind="stable")
                    row, h = row[order], h[order]
                n = np.bincount(row, minlength=len(counts))
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                out = np.zeros((len(full), trees, levels), np.uint64)
                for t in range(trees):
                    prefix = np.zeros(len(full), np.uint64)
                    for i in range(depth):
                        low = np.minimum.reduceat(_permuted(h, odd[t * depth + i]), starts) if len(full) else np.empty(0, np.uint64)
                        prefix = mixed(prefix ^ (low + np.uint64(i + 1)))
                        if i + 1 >= shortest:
                            out[:, t, i + 1 - shortest] = prefix
                mine = np.full(len(counts), -1)
                mine[full] = np.arange(len(full))
                flat = out.reshape(len(full), trees * levels).view(np.int64)
                prefixes += [flat[m] if m >= 0 else np.empty(0, np.int64) for m in mine]
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(prefixes, pa.list_(pa.int64()))], names=[*keep, "prefixes"])

    return of


def _permuted(h: np.ndarray, odd: np.uint64) -> np.ndarray:
    x = h * odd
    return x ^ (x >> np.uint64(32))


def _first_meetings(p: np.ndarray, tree: int, level: int) -> np.ndarray:
    """Which rows of the prefixes p (row, tree, level) share this one in this tree and in none before it, and none deeper."""
    same = p[:, None, tree, level] == p[None, :, tree, level]
    for t in range(tree):
        same &= p[:, None, t, level] != p[None, :, t, level]
    if level + 1 < p.shape[2]:
        for t in range(p.shape[1]):
            same &= p[:, None, t, level + 1] != p[None, :, t, level + 1]
    np.fill_diagonal(same, False)
    return same


def _blocked(pairs: np.ndarray, side: np.ndarray, split: bool) -> np.ndarray:
    """In a meeting of two different blocks only the pairs across count."""
    return pairs & (side[:, None] != side[None, :]) if split else pairs


def _key(pdf: pd.DataFrame) -> tuple[int, bool]:
    """(tree, whether two different blocks meet) of a meeting's rows."""
    return int(pdf["tree"].iloc[0]), pdf["x"].iloc[0] != pdf["y"].iloc[0]


def _pairs(pdf: pd.DataFrame, p: np.ndarray, level: int) -> np.ndarray:
    tree, split = _key(pdf)
    return _blocked(_first_meetings(p, tree, level), pdf["block"].to_numpy(), split)


def _stacked(prefixes: pd.Series, trees: int) -> np.ndarray:
    return np.stack(prefixes.to_numpy()).reshape(len(prefixes), trees, -1)


_MEETING = ["tree", "prefix", "x", "y"]


def _needed(trees: int, level: int):
    """The members of a meeting that have a pair to verify in it. Meetings of two rows are looked at all at once."""

    def of(batches):
        for pdf, first in whole_groups(batches, _MEETING):
            p, n = _stacked(pdf["prefixes"], trees), np.diff(np.append(first, len(pdf)))
            keep = np.zeros(len(pdf), bool)
            two = first[n == 2]
            apart = (pdf["x"].to_numpy()[two] == pdf["y"].to_numpy()[two]) | (pdf["block"].to_numpy()[two] != pdf["block"].to_numpy()[two + 1])
            same = p[two] == p[two + 1]
            new = ~same[:, :, level + 1].any(axis=1) if level + 1 < p.shape[2] else np.ones(len(two), bool)
            yes = two[(same[:, :, level].argmax(axis=1) == pdf["tree"].to_numpy()[two]) & apart & new]
            keep[yes] = keep[yes + 1] = True
            for at, size in zip(first[n > 2].tolist(), n[n > 2].tolist(), strict=True):
                keep[at : at + size] = _pairs(pdf.iloc[at : at + size], p[at : at + size], level).any(axis=1)
            yield pdf.loc[keep, ["tree", "prefix", "x", "y", "block", "cid"]]

    return of


def _common_counts(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Sizes of all pairwise intersections, from incidence matrices of a bounded number of shingles at a time."""
    ids, col = np.unique(h, return_inverse=True)
    often = np.bincount(col) > 1
    keep = often[col]
    row, col = row[keep], (np.cumsum(often) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, n), np.float32)
    step = max(64, min(4096, 8_000_000 // max(n, 1)))
    for at in range(0, int(often.sum()), step):
        a, b = np.searchsorted(col, [at, at + step])
        m = np.zeros((n, step), np.float32)
        m[row[a:b], col[a:b] - at] = 1
        out += m @ m.T
    return out


def _verified(shingle: int, threshold: float, trees: int, level: int):
    """Counts and spanning links of the meetings, and how many pairs link in each step of the similarity (rows with a bin)."""
    ratio = Fraction(str(threshold))

    def of(batches):
        hashes, windows, unpack = WordHashes(), Windows(), decompressor()
        for pdf, first in whole_groups(batches, _MEETING, 1_000):
            rows, hs = [], []
            for begin, counts, w in word_chunks(map(unpack, pdf["text"]), hashes):
                r, h = shingles(counts, w, windows, shingle)
                rows.append(r + begin)
                hs.append(h)
            row, h = np.concatenate(rows), np.concatenate(hs)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
            row, h = row[new], h[new]
            size = np.bincount(row, minlength=len(pdf)).astype(np.int64)
            n = np.diff(np.append(first, len(pdf)))
            copies, cid = pdf["copies"].to_numpy(np.int64), pdf["cid"].to_numpy(np.int64)
            links, root = np.zeros(len(pdf), np.int64), cid.copy()
            # Meetings of two rows: their common shingles are the neighbours that are equal in the order of (meeting, hash).
            group = np.repeat(np.arange(len(first)), n)
            two = np.flatnonzero(n == 2)
            own = n[group[row]] == 2
            g, x = group[row[own]], h[own]
            order = np.lexsort((x, g))
            g, x = g[order], x[order]
            common = np.bincount(g[1:][(g[1:] == g[:-1]) & (x[1:] == x[:-1])], minlength=len(first))[two]
            a = first[two]
            yes = a[ratio.denominator * common >= ratio.numerator * (size[a] + size[a + 1] - common)]
            linked_two = np.isin(a, yes)
            bins = [common[linked_two] * BINS // (size[yes] + size[yes + 1] - common[linked_two])]
            links[yes], links[yes + 1] = copies[yes + 1], copies[yes]
            root[yes] = root[yes + 1] = np.minimum(cid[yes], cid[yes + 1])
            for at, m in zip(first[n > 2].tolist(), n[n > 2].tolist(), strict=True):
                part = slice(at, at + m)
                pairs = _pairs(pdf.iloc[part], _stacked(pdf["prefixes"].iloc[part], trees), level)
                lo, hi = np.searchsorted(row, [at, at + m])
                common = _common_counts(row[lo:hi] - at, h[lo:hi], m).astype(np.int64)
                linked = pairs & (ratio.denominator * common >= ratio.numerator * (size[part, None] + size[None, part] - common))
                links[part] = linked @ copies[part]
                i, j = np.nonzero(np.triu(linked))
                if len(i):
                    both = common[i, j]
                    bins.append(both * BINS // (size[part][i] + size[part][j] - both))
                    v, r = local_roots(cid[part][i], cid[part][j])
                    where = np.isin(cid[part], v)
                    root[part] = np.where(where, r[np.searchsorted(v, cid[part]).clip(0, len(v) - 1)], cid[part])
            has = links > 0
            yield pd.DataFrame({"cid": cid[has], "root": root[has], "links": links[has], "bin": -1})
            step, n_links = np.unique(np.concatenate(bins), return_counts=True)
            yield pd.DataFrame({"cid": 0, "root": 0, "links": n_links, "bin": step})

    return of


def jaccard_join(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK, measured: int = MEASURED
) -> DataFrame:
    """Per row of docs: doc_id, class_id, n_links, group_id and kept.

    A shingle is five consecutive words (runs without ASCII white space, unchanged); a text of one to four words is one
    shingle. Rows link when the Jaccard similarity of their shingle sets is the threshold or more. class_id is the
    smallest id of the rows with the same text, n_links the number of other rows linked directly (copies included),
    group_id the smallest id reachable by links, and kept holds for the row whose id is the group_id. Null, empty and
    blank texts have no shingles: they link with nothing, each such row is its own group and is kept. A text is a class
    by its SHA-256 digest. Rows with a null id are left out of the links and kept; ids should be unique, and rows that
    share an id are answered alike. Ids that are no whole numbers are ordered as they are. Only the id and text columns
    are read.
    """
    spark = docs.sparkSession
    shortest, trees = shortest_prefix(threshold, trees, depth, recall)
    depth = max(depth, shortest)
    levels = depth - shortest + 1
    src, names = whole_ids(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), "doc_id")
    src = src.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = staged(src.select("doc_id", "digest", "text").mapInArrow(tidy(_signatures(shingle, trees, shortest, depth)), "doc_id long, digest binary, prefixes array<bigint>"), "signatures")
    classes = rows.where("size(prefixes) > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("cid"), F.count("*").alias("copies"), F.first("prefixes").alias("prefixes"))
    classes = staged(classes, "classes")
    dealt = lambda df: df.repartition(wide(spark), *_MEETING).sortWithinPartitions(*_MEETING)

    def grouped(member: DataFrame) -> DataFrame:
        """member (cid, tree, prefix, ...) with the size of its group, for groups of more than one class."""
        return member.join(member.groupBy("tree", "prefix").agg(F.count("*").alias("size")).where("size > 1"), ["tree", "prefix"])

    # The forest: each tree's signatures in order, less the classes that share not even the shortest prefix with another.
    own = lambda t: F.get("prefixes", t * levels)
    member = classes.select("cid", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), own)).alias("tree", "prefix"))
    forest = grouped(member).select("cid", "tree").join(classes.select("cid", "prefixes"), "cid")
    forest = forest.select("cid", "tree", F.slice("prefixes", F.col("tree") * levels + 1, F.lit(levels)).alias("signature"))
    forest = staged(forest.repartitionByRange(wide(spark), "tree", "signature").sortWithinPartitions("tree", "signature"), "forest")
    texts, told, links = compressed(src.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("cid"), "text"), "text"), [], {}
    for level in range(levels - 1, -1, -1):
        at = grouped(forest.select("cid", "tree", F.get("signature", F.lit(level)).alias("prefix")))
        at = at.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "cid", "tree", "prefix", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
        )
        found = dealt(at.join(classes.select("cid", "prefixes"), "cid")).mapInPandas(tidy(_needed(trees, level)), "tree int, prefix long, x int, y int, block int, cid long")
        found = staged(found, "meetings")
        if not found.isEmpty():
            # Joins of one kind at every size: the texts are dealt out by id once, compressed.
            wanted = found.select("cid").distinct()
            sent = texts.join(wanted.hint("merge"), "cid", "left_semi").dropDuplicates(["cid"]).join(classes.select("cid", "copies", "prefixes").hint("merge"), "cid")
            verified = dealt(found.join(sent.hint("merge"), "cid")).mapInPandas(tidy(_verified(shingle, threshold, trees, level)), "cid long, root long, links long, bin int")
            told.append(staged(verified, "links"))
            for r in told[-1].where("bin >= 0").groupBy("bin").agg(F.sum("links").alias("n")).collect():  # at most BINS + 1 rows
                links[r["bin"]] = links.get(r["bin"], 0) + r["n"]
        if sum(links.values()) >= measured and measured_recall(links, shortest + level, trees) >= recall:
            break
    none = spark.createDataFrame([], "cid long, root long, links long, bin int")
    linked = reduce(DataFrame.unionByName, told, none).where("bin < 0").drop("bin")
    group = components(linked.where("cid <> root"), "cid", "root").withColumnRenamed("node", "cid")
    answer = classes.select("digest", "cid", "copies").join(linked.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(group, "cid", "left")
    answer = answer.select("digest", F.col("cid").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cid").alias("group_id"))
    out = rows.select("doc_id", "digest", (F.col("doc_id").isNotNull() & (F.size("prefixes") > 0)).alias("full")).join(answer, "digest", "left")
    mine = lambda c: F.when(F.col("full"), F.col(c)).otherwise(F.col("doc_id"))
    out = out.select("doc_id", mine("class_id").alias("class_id"), F.when(F.col("full"), F.col("n_links")).otherwise(F.lit(0)).alias("n_links"), mine("group_id").alias("group_id"), (~F.col("full") | (F.col("doc_id") == F.col("group_id"))).alias("kept"))
    return named(out, names, ["doc_id", "class_id", "group_id"])


def dedup_rows(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that stay when one of each group of links does: the smallest id, null last.

    Rows with null or repeated ids are rows of their own. Texts without shingles link with nothing, so all of them stay.
    """
    rows, key = told_apart(docs, doc_id)
    gone = jaccard_join(rows, doc_id=key, **options).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    left = rows.join(gone, rows[key] == gone["_gone"], "left_anti")
    return left if key == doc_id else left.drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(l[i:i + 4], ' ') AS s FROM w, unnest(range(1, greatest(len(l) - 4, 1) + 1)) AS r(i) WHERE len(l) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
g AS (SELECT a, min(b) AS low FROM reach GROUP BY a), k AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS class_id FROM w WHERE len(l) > 0)
SELECT w.doc_id, coalesce(c.class_id, w.doc_id) AS class_id, coalesce(k.n, 0) AS n_links, least(w.doc_id, coalesce(g.low, w.doc_id)) AS group_id,
       least(w.doc_id, coalesce(g.low, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN k ON k.a = w.doc_id LEFT JOIN g ON g.a = w.doc_id
"""
