"""Block alignment of two paragraph sequences and bridge joins through a pivot language."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import staged
from .corpus import running_totals

#: Cost of every paragraph beyond one in a block, and what an empty side costs where it is allowed.
STEP_PENALTY, GAP_COST = 0.025, 0.2
#: Rows a side of a tile of scores.
TILE = 512


def block_means(x: np.ndarray, k: int) -> np.ndarray:
    """The means of every k rows that follow each other, as unit vectors (zero where the mean is)."""
    m = sum(x[i : len(x) - k + 1 + i] for i in range(k)) / k
    n = np.sqrt((m * m).sum(axis=1))
    return m / np.where(n > 0, n, np.inf)[:, None]


def block_scores(left: np.ndarray, right: np.ndarray, a: int, b: int) -> np.ndarray:
    """cosine of the means of every block of a left and b right rows, [first left, first right]."""
    return block_means(left, a) @ block_means(right, b).T


def align(left: np.ndarray, right: np.ndarray, max_group: int = 3, penalty: float = STEP_PENALTY, gap: float | None = None) -> tuple[float, list[tuple[int, int, int, int, float | None]]] | None:
    """(total, groups): the best monotone cover of both sides by blocks of 1..max_group rows.

    A group is (first left, how many, first right, how many, cosine), from 0. Every group scores its cosine less the
    penalty for each row beyond one a side; with `gap`, one row may also stand alone at that cost. Of equal scores the
    larger left block, then the larger right block stays. Rows of the score table depend on max_group rows before them
    alone, so only those are kept, with one byte a cell for the way taken; the cosines of a row are computed when it is.
    None if the sides cannot be covered.
    """
    n, m = len(left), len(right)
    if max_group > 15:
        raise ValueError("groups have at most 15 rows")
    took = np.zeros((n + 1, m + 1), np.uint8)  # 16 times the rows of the left block, plus those of the right one
    steps = [(a, b) for a in range(max_group, 0, -1) for b in range(max_group, 0, -1) if a <= n and b <= m]
    lefts, rights = ({k: block_means(x, k) for k in range(1, max_group + 1) if k <= len(x)} for x in (left, right))
    best: dict[int, np.ndarray] = {}
    for i in range(n + 1):
        best[i] = row = np.full(m + 1, -np.inf)
        best.pop(i - max_group - 1, None)
        if not i:
            row[0] = 0
        for a, b in steps:
            if i < a:
                continue
            value = np.full(m + 1, -np.inf)
            value[b:] = best[i - a][: m + 1 - b] + rights[b] @ lefts[a][i - a] - penalty * (a + b - 2)
            better = value > row
            row[better] = value[better]
            took[i][better] = 16 * a + b
        if gap is not None:
            if i:
                value = best[i - 1] - gap
                better = value > row
                row[better] = value[better]
                took[i][better] = 16
            _alone(row, took[i], gap)
    if not np.isfinite(best[n][m]):
        return None
    groups, i, j = [], n, m
    while i or j:
        a, b = divmod(int(took[i, j]), 16)
        groups.append((i - a, a, j - b, b, float(lefts[a][i - a] @ rights[b][j - b]) if a and b else None))
        i, j = i - a, j - b
    return float(best[n][m]), groups[::-1]


def _alone(row: np.ndarray, took: np.ndarray, gap: float) -> None:
    """Lets rows of the right side stand alone: a cell is at least its left neighbour's value less the gap's cost."""
    cost = gap * np.arange(len(row))
    before = np.maximum.accumulate(np.r_[-np.inf, (row + cost)[:-1]])
    better = before > row + cost
    row[better] = (before - cost)[better]
    took[better] = 1


def first_pass(left: np.ndarray, right: np.ndarray, k: int = 3) -> list[tuple[int, int]]:
    """The chain of pairs, rising on both sides, with the greatest sum of cosines among the k nearest right rows of each left row.

    Cosines are taken for some left rows at a time; a Fenwick tree of the best chain up to a right row finds each
    pair's predecessor, so n left rows take n * k * log m steps and no table of all pairs.
    """
    u, v = block_means(left, 1), block_means(right, 1)
    n, m, k = len(u), len(v), min(k, len(v))
    pairs: list[tuple[int, int, int]] = []  # left, right, pair before
    tree: list[tuple[float, int]] = [(0.0, -1)] * (m + 1)
    for at in range(0, n, 256):
        s = u[at : at + 256] @ v.T
        near = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else np.empty((len(s), 0), int)
        for i, js in enumerate(near.tolist()):
            # from right to left, so that no pair of a row follows another one of it
            for j in sorted((j for j in js if s[i, j] > 0), reverse=True):
                best, x = (0.0, -1), j
                while x > 0:
                    best, x = max(best, tree[x]), x & (x - 1)
                told, x = (best[0] + float(s[i, j]), len(pairs)), j + 1
                pairs.append((at + i, j, best[1]))
                while x <= m:
                    tree[x], x = max(tree[x], told), x + (x & -x)
    last, x, out = (0.0, -1), m, []
    while x > 0:
        last, x = max(last, tree[x]), x & (x - 1)
    p = last[1]
    while p >= 0:
        out.append(pairs[p][:2])
        p = pairs[p][2]
    return out[::-1]


def align_two_pass(left: np.ndarray, right: np.ndarray, most: int = 5, penalty: float = STEP_PENALTY, gap: float = GAP_COST, k: int = 3, margin: int = 64) -> tuple[float, list[tuple[int, int, int, int, float | None]]]:
    """(total, groups) as of align, by blocks of at most `most` rows of both sides together and single rows that stand alone.

    The first pass finds a chain of near pairs, the second looks only at cells within `margin` right rows of it (wider
    where the chain jumps). It needs max(n, m) * margin steps and bytes, and gives the best cover of all if the band
    holds it, as it does wherever no side has more than `margin` rows.
    """
    n, m = len(left), len(right)
    pairs = first_pass(left, right, k) if n and m else []
    path = np.interp(np.arange(n + 1), [0, *(i + 1 for i, _ in pairs if i + 1 < n), n], [0, *(j + 1 for i, j in pairs if i + 1 < n), m])
    lo, hi = np.maximum(np.floor(path).astype(int) - margin, 0), np.minimum(np.ceil(path).astype(int) + margin, m)
    lo[0], hi[n] = 0, m
    lo[1:] = np.minimum(lo[1:], hi[:-1])
    steps = [(a, b) for a in range(most - 1, 0, -1) for b in range(most - a, 0, -1) if a <= n and b <= m]
    lefts, rights = ({c: block_means(x, c) for c in range(1, most) if c <= len(x)} for x in (left, right))
    best: dict[int, np.ndarray] = {}
    took: list[np.ndarray] = []
    for i in range(n + 1):
        best[i] = row = np.full(hi[i] - lo[i] + 1, -np.inf)
        way = np.zeros(len(row), np.uint8)
        best.pop(i - most, None)
        if not i:
            row[0] = 0
        for a, b in [*steps, (1, 0)]:
            if i < a:
                continue
            first, last = max(lo[i], lo[i - a] + b), min(hi[i], hi[i - a] + b)
            if first > last:
                continue
            own, before = slice(first - lo[i], last - lo[i] + 1), best[i - a][first - b - lo[i - a] : last - b - lo[i - a] + 1]
            value = before - gap if not b else before + rights[b][first - b : last - b + 1] @ lefts[a][i - a] - penalty * (a + b - 2)
            better = value > row[own]
            row[own] = np.where(better, value, row[own])
            way[own] = np.where(better, 16 * a + b, way[own])
        _alone(row, way, gap)
        took.append(way)
    groups, i, j = [], n, m
    while i or j:
        a, b = divmod(int(took[i][j - lo[i]]), 16)
        groups.append((i - a, a, j - b, b, float(lefts[a][i - a] @ rights[b][j - b]) if a and b else None))
        i, j = i - a, j - b
    return float(best[n][m - lo[n]]), groups[::-1]


def align_blocks(vectors: DataFrame, chapter: str = "chapter", max_group: int = 3, gap: float | None = None, two_pass: bool = False, **options) -> DataFrame:
    """Pair groups (chapter, g, left, right, similarity) of vectors (chapter, side 'left'/'right', p, embedding).

    Chapters are independent: one grouped-map task aligns a chapter, whose state is its score table; with two_pass a band
    of it (options are those of align_two_pass). A chapter that cannot be covered gives one row with g 0 and no paragraphs.
    """
    method = (lambda x, y: align_two_pass(x, y, **options)) if two_pass else lambda x, y: align(x, y, max_group, gap=gap)

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("p")
        sides = {s: pdf[pdf["side"] == s] for s in ("left", "right")}
        x = {s: np.stack([np.asarray(v, float) for v in d["embedding"]]) if len(d) else np.zeros((0, 1)) for s, d in sides.items()}
        key = pdf[chapter].iloc[0]
        found = method(x["left"], x["right"]) if len(x["left"]) and len(x["right"]) else None
        if found is None:
            return pd.DataFrame({chapter: [key], "g": [0], "left": [[]], "right": [[]], "similarity": [None]})
        p = {s: d["p"].to_numpy() for s, d in sides.items()}
        return pd.DataFrame([{chapter: key, "g": k, "left": p["left"][i : i + a].tolist(), "right": p["right"][j : j + b].tolist(), "similarity": None if s is None else round(s, 4)} for k, (i, a, j, b, s) in enumerate(found[1], 1)])

    kind = dict(vectors.dtypes)[chapter]
    # Only the needed columns reach the grouped map: Catalyst does not prune through it.
    return vectors.select(chapter, "side", "p", "embedding").groupBy(chapter).applyInPandas(of, f"{chapter} {kind}, g int, left array<int>, right array<int>, similarity double")


def score_blocks(vectors: DataFrame, chapter: str = "chapter", a: int = 1, b: int = 1, tile: int = TILE) -> DataFrame:
    """(chapter, i, j, score): block_scores of every `a` left and `b` right rows that follow each other, by their first rows.

    vectors: (chapter, side 'left'/'right', p from 1 without gaps, embedding). The table of a chapter is cut into tiles of
    `tile` rows a side, each the work of one task: it holds 2 * tile vectors and tile * tile scores, whatever the size of
    a chapter. Rows go once to every tile of their row or column; the last rows of a block also to the tile before.
    """
    own = vectors.where(F.col(chapter).isNotNull()).select(chapter, "side", "p", "embedding")
    counts = own.groupBy(chapter).agg(*(F.ceil(F.max(F.when(F.col("side") == s, F.col("p"))) / tile).alias(f"_{s}") for s in ("left", "right")))

    def dealt(side: str, other: str, k: int, at: str, across: str) -> DataFrame:
        first = F.greatest(F.floor((F.col("p") - k) / tile), F.lit(0))
        rows = own.where(F.col("side") == side).select(chapter, "p", "embedding", F.explode(F.sequence(first, F.floor((F.col("p") - 1) / tile))).alias(at))
        return rows.join(counts.where(f"_{other} > 0"), chapter).select(
            # new names of the same columns tell the two sides apart
            *(F.col(c).alias(c) for c in (chapter, "p", "embedding", at)), F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}") - 1)).alias(across)
        )

    def of(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) < a or len(right) < b:
            return pd.DataFrame(columns=[chapter, "i", "j", "score"], dtype=object)
        left, right = left.sort_values("p"), right.sort_values("p")
        s = block_scores(*(np.stack(x["embedding"].to_numpy()).astype(float) for x in (left, right)), a, b)[:tile, :tile]
        i, j = np.indices(s.shape, np.int32)
        i, j = i.ravel() + np.int32(left["p"].iloc[0]), j.ravel() + np.int32(right["p"].iloc[0])
        return pd.DataFrame({chapter: left[chapter].to_numpy()[:1].repeat(s.size), "i": i, "j": j, "score": s.ravel()})

    key = [chapter, "row", "column"]
    lefts, rights = dealt("left", "right", a, "row", "column"), dealt("right", "left", b, "column", "row")
    kind = dict(vectors.dtypes)[chapter]
    return lefts.groupBy(*key).cogroup(rights.groupBy(*key)).applyInPandas(of, f"{chapter} {kind}, i int, j int, score double")


def coverage(groups: DataFrame, chapter: str = "chapter") -> DataFrame:
    """Group count and covered paragraphs of each side."""
    return groups.where("g > 0").groupBy(chapter).agg(F.count("*").alias("groups"), F.sum(F.size("left")).alias("left_covered"), F.sum(F.size("right")).alias("right_covered"))


def alignment_totals(groups: DataFrame, chapter: str = "chapter", penalty: float = STEP_PENALTY) -> DataFrame:
    """The penalised score of each chapter."""
    return groups.where("g > 0").groupBy(chapter).agg(F.sum(F.col("similarity") - penalty * (F.size("left") + F.size("right") - 2)).alias("total"))


def bridge_by_cuts(zh_en: DataFrame, en_ru: DataFrame, chapter: str = "chapter") -> DataFrame:
    """Units of two groupings that cover the pivot contiguously: (chapter, unit, zh, en, ru).

    zh_en: (chapter, g, left: zh, right: en), en_ru: (chapter, g, left: en, right: ru). A unit ends where a group of
    both sides ends. Groups of both sides run in one order of their ends, so that one pass over a chapter finds the ends
    that both have and numbers the units by those before; a chapter is shuffled once.
    """
    none = F.lit(None)
    both = zh_en.select(chapter, F.lit(0).alias("side"), F.array_max("right").alias("cut"), F.col("left").alias("zh"), F.col("right").alias("en"), none.cast("array<int>").alias("ru"))
    both = both.unionByName(en_ru.select(chapter, F.lit(1).alias("side"), F.array_max("left").alias("cut"), none.cast("array<int>").alias("zh"), none.cast("array<int>").alias("en"), F.col("right").alias("ru")))
    ends = Window.partitionBy(chapter).orderBy("cut", "side")
    before = Window.partitionBy(chapter).orderBy("cut").rangeBetween(Window.unboundedPreceding, -1)
    closes = (F.col("side") == 1) & (F.lag("side").over(ends) == 0) & (F.lag("cut").over(ends) == F.col("cut"))
    at = both.withColumn("closes", F.coalesce(closes.cast("int"), F.lit(0))).withColumn("unit", F.coalesce(F.sum("closes").over(before), F.lit(0)) + 1)
    sides = at.groupBy(chapter, "unit").agg(F.min("side").alias("lo"), F.max("side").alias("hi"), *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("zh", "en", "ru")))
    return sides.where("lo = 0 AND hi = 1").select(chapter, "unit", "zh", "en", "ru")


def bridge(zh_en: DataFrame, en_ru: DataFrame, chapter: str = "chapter", extras: bool = False, keep_en: bool = False) -> DataFrame:
    """Units (chapter, unit, zh, en, ru): connected components of groups that share pivot numbers, per chapter.

    Units follow the smallest zh_en group in them. en_ru groups out of reach are left out, or with `extras` appended in
    their order with zh empty, and en empty too unless keep_en.
    """
    a = zh_en.select(chapter, F.lit(0).alias("side"), "g", F.col("right").alias("en"), F.col("left").alias("own"))
    b = en_ru.select(chapter, F.lit(1).alias("side"), "g", F.col("left").alias("en"), F.col("right").alias("own"))

    def units(rows: list) -> list[tuple[list[int], list[int], list[int]]]:
        side, en, own = ([r[c] for r in rows] for c in ("side", "en", "own"))
        parent = list(range(len(rows)))

        def top(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        owner: dict[int, int] = {}
        for i, numbers in enumerate(en):
            for n in numbers:
                x, y = top(i), top(owner.setdefault(int(n), i))
                parent[max(x, y)] = min(x, y)
        members: dict[int, list[int]] = {}
        for i in range(len(rows)):
            members.setdefault(top(i), []).append(i)
        gather = lambda ids, what, s=None: sorted({int(v) for i in ids if s is None or side[i] == s for v in what[i]})
        out = [(gather(ids, own, 0), gather(ids, en), gather(ids, own, 1)) for root, ids in sorted(members.items()) if side[root] == 0]
        if extras:
            out += [([], gather([i], en) if keep_en else [], gather([i], own)) for i in range(len(rows)) if side[top(i)] == 1]
        return out

    def of(batches):
        for pdf in batches:
            rows = [(key, k, *u) for key, own in zip(pdf[chapter], pdf["rows"], strict=True) for k, u in enumerate(units(own), 1)]
            yield pd.DataFrame(rows, columns=[chapter, "unit", "zh", "en", "ru"])

    # One row a chapter, many chapters a batch: small chapters cost no Python call each.
    gathered = a.unionByName(b).groupBy(chapter).agg(F.array_sort(F.collect_list(F.struct("side", "g", "en", "own"))).alias("rows"))
    kind = dict(zh_en.dtypes)[chapter]
    return gathered.mapInPandas(of, f"{chapter} {kind}, unit int, zh array<int>, en array<int>, ru array<int>")


def _tops(links: DataFrame) -> DataFrame:
    """(chapter, node, top): the smallest node of the component, for the nodes of links (chapter, a, b).

    In a round every node takes its smallest neighbour, or itself, as its pointer; pointers are followed to their ends by
    doubling, and the links between ends are what the next round works on. Two rounds leave at most half of the nodes.
    Each step is written to the shared folder.
    """
    tops = None
    while tops is None or not links.isEmpty():
        both = links.select("chapter", F.col("a").alias("node"), F.col("b").alias("near")).unionByName(links.select("chapter", F.col("b").alias("node"), F.col("a").alias("near")))
        up = staged(both.groupBy("chapter", "node").agg(F.min("near").alias("near")).select("chapter", "node", F.least("node", "near").alias("top")))
        while True:
            above = up.select("chapter", F.col("node").alias("top"), F.col("top").alias("above"))
            up = staged(up.join(above, ["chapter", "top"]).select("chapter", "node", F.col("above").alias("top"), (F.col("above") < F.col("top")).alias("moved")))
            done = up.where("moved").isEmpty()
            up = up.select("chapter", "node", "top")
            if done:
                break
        end = lambda own: up.select("chapter", F.col("node").alias(own), F.col("top").alias(f"{own}_top"))  # noqa: B023, E731
        if tops is None:
            tops = up
        else:
            tops = staged(tops.join(end("top"), ["chapter", "top"], "left").select("chapter", "node", F.coalesce("top_top", "top").alias("top")))
        ends = links.join(end("a"), ["chapter", "a"]).join(end("b"), ["chapter", "b"])
        links = staged(ends.select("chapter", F.col("a_top").alias("a"), F.col("b_top").alias("b")).where("a <> b").distinct())
    return tops


def bridge_by_links(zh_en: DataFrame, en_ru: DataFrame, chapter: str = "chapter") -> DataFrame:
    """bridge without extras for chapters of any size: no task holds a chapter, only the rows of a number or of a group.

    The groups that share a number are linked to the smallest of them. What the links reach is found in rounds that leave
    only the links between the groups that the round ended at, so that later rounds have little to do.
    """
    side = lambda df, k, en, own: df.select(F.col(chapter).alias("chapter"), (F.col("g").cast("long") * 2 + k).alias("node"), F.col(en).alias("en"), F.col(own).alias("own"))
    # Written once: the groupings are computed neither for the links nor for the units again.
    groups = staged(side(zh_en, 0, "right", "left").unionByName(side(en_ru, 1, "left", "right")).where("chapter IS NOT NULL AND node IS NOT NULL"))
    numbers = groups.select("chapter", "node", F.explode("en").alias("number")).where("number IS NOT NULL")
    least = numbers.withColumn("b", F.min("node").over(Window.partitionBy("chapter", "number")))
    tops = _tops(staged(least.select("chapter", F.col("node").alias("a"), "b").where("a <> b").distinct()))
    member = groups.join(tops, ["chapter", "node"], "left").withColumn("top", F.coalesce("top", "node")).withColumn("zh_group", F.col("node") % 2 == 0)
    gathered = lambda c, mine=None: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(mine, F.col(c)) if mine is not None else F.col(c)))))
    units = member.groupBy("chapter", "top").agg(
        F.min(F.when(F.col("zh_group"), F.col("node"))).alias("first"), gathered("own", F.col("zh_group")).alias("zh"), gathered("en").alias("en"), gathered("own", ~F.col("zh_group")).alias("ru")
    ).where("first IS NOT NULL")
    numbered = running_totals(staged(units), ["chapter"], ["first"], {"unit": F.lit(1)})
    return numbered.select(F.col("chapter").alias(chapter), (F.col("unit") + 1).cast("int").alias("unit"), "zh", "en", "ru")


def weak_context(groups: DataFrame, chapter: str = "chapter", minimum: float = 0.65, around: int = 2) -> DataFrame:
    """The groups around the first one below the minimum: chapter, first_suspect_group, g, left, right, similarity.

    A missing similarity counts as 0. Chapters without a weak group give no rows.
    """
    whole = Window.partitionBy(chapter)
    first = F.min(F.when(F.coalesce("similarity", F.lit(0.0)) < minimum, F.col("g"))).over(whole)
    return groups.withColumn("first_suspect_group", first).where(F.col("g").between(F.col("first_suspect_group") - around, F.col("first_suspect_group") + around))


def gate(groups: DataFrame, chapter: str = "chapter", minimum: float = 0.65) -> DataFrame:
    """(chapter, status, first_suspect_group): passed, or review_required from the first weak group."""
    weak = F.min(F.when(F.coalesce("similarity", F.lit(0.0)) < minimum, F.col("g")))
    return groups.groupBy(chapter).agg(weak.alias("first_suspect_group")).withColumn("status", F.when(F.col("first_suspect_group").isNull(), "passed").otherwise("review_required"))
