"""Periodic runs of words, found by Main-Lorentz divide and conquer, and their removal.

The words of a text are interned as whole numbers and the text is halved again and again. A run that is long enough is
whole in exactly one segment whose midpoint lies inside it; there at least two of its periods lie to one side of the
midpoint. So, on each side, the periods p are sought at which the words from the midpoint on repeat at once (a square that
begins at the midpoint: the Z-function of the side is p or more at p). The Z-value tells how far the repetition goes on
that side, and a comparison of the other side's words how far it goes there. A repetition that goes on beyond its segment
is left to the segment that holds it whole; equal intervals keep their smallest period.

Of the squares at one midpoint only primitive ones count: with a period p that reaches as far as r, any other period below
r / 2 is a multiple of it. All segments of one size, of all texts of a batch, are screened together by numpy (the first two
words must repeat); a Z-function is computed only where something is left.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tidy

#: A run has at least so many words, and at least so many periods.
LEAST, PERIODS = 6, 4
#: Words of a batch of texts that are worked on together; one longer text is a batch of its own.
WORDS = 1 << 18


class _Interned(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two stretches share from their beginnings on."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = at + step, 2 * step
    return n


def z_function(v: np.ndarray, most: int) -> dict[int, int]:
    """For places i of 1..most whose word is the first one: how many words from i on are those from 0 on. Others have 0."""
    z: dict[int, int] = {}
    left = right = 0
    for i in (np.flatnonzero(v[1 : most + 1] == v[0]) + 1).tolist():
        known = z.get(i - left, 0) if i < right else 0
        if i < right and (known != right - i or right == len(v)):
            z[i] = min(known, right - i)
            continue
        start = max(i, right)
        end = start + _same(v[start:], v[start - i :])
        z[i], left, right = end - i, i, end
    return z


def _squares(v: np.ndarray) -> Iterator[tuple[int, int]]:
    """(p, reach) of the primitive squares that v begins with: v[:reach] has the period p, and reach >= 2 * p."""
    beyond = 0
    for p, n in z_function(v, len(v) // 2).items():
        if n >= p and 2 * p > beyond:
            beyond = p + n
            yield p, beyond


def _screen(ids: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments of which a square may begin at the midpoint, to the right and to the left."""
    out = []
    for first, most, way in ((mid, (hi - mid) // 2, 1), (mid - 1, (mid - lo) // 2, -1)):
        seg = np.repeat(np.arange(len(mid)), most)
        p = np.arange(len(seg)) - np.repeat(np.cumsum(most) - most, most) + 1
        take = np.flatnonzero(ids[first[seg] + way * p] == ids[first][seg])
        seg, p = seg[take], p[take]
        # a run of one word has three of them to one side at least, so two words must repeat in any case
        second = first[seg] + way * (p + 1)
        fine = (second >= lo[seg]) & (second < hi[seg])
        seg, second = seg[fine], second[fine]
        out.append(np.unique(seg[ids[second] == ids[first[seg] + way]]))
    return out[0], out[1]


def runs(ids: np.ndarray, counts: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> dict[int, list[tuple[int, int, int]]]:
    """row -> its runs (start, length, period) by start and period, for texts of `counts` interned words each."""
    if least < 6 or periods < 4:
        raise ValueError("runs have six words and four periods at least")
    found: dict[int, dict[tuple[int, int], int]] = {}
    begin = np.cumsum(counts) - counts
    row, lo, hi = np.arange(len(counts)), begin, begin + counts
    first, last = lo, hi
    while True:
        fit = hi - lo >= least
        row, lo, hi, first, last = row[fit], lo[fit], hi[fit], first[fit], last[fit]
        if not len(row):
            break
        mid = (lo + hi) // 2
        right, left = _screen(ids, lo, mid, hi)
        for segments, forward in ((right, True), (left, False)):
            for k in segments.tolist():
                a, m, b = int(lo[k]), int(mid[k]), int(hi[k])
                side = ids[m:b] if forward else ids[a:m][::-1]
                for p, reach in _squares(side):
                    if forward:
                        start, end = m - _same(ids[a:m][::-1], ids[a : m + p][::-1]), m + reach
                    else:
                        start, end = m - reach, m + _same(ids[m:b], ids[m - p : b])
                    if end - start < max(least, periods * p):
                        continue
                    if (start == a > first[k] and ids[a - 1] == ids[a - 1 + p]) or (end == b < last[k] and ids[b] == ids[b - p]):
                        continue
                    own = found.setdefault(int(row[k]), {})
                    at = (start - int(first[k]), end - start)
                    own[at] = min(p, own.get(at, p))
        row, first, last = np.repeat(row, 2), np.repeat(first, 2), np.repeat(last, 2)
        lo, hi = np.stack([lo, mid], 1).ravel(), np.stack([mid, hi], 1).ravel()
    return {r: sorted((s, n, p) for (s, n), p in own.items()) for r, own in found.items()}


def _batches(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Runs of rows with about WORDS words."""
    first, texts, n = 0, [], 0
    for i, t in enumerate(batch.column(text)):
        own = t.as_py()
        texts.append(own.encode().split() if own else [])
        n += len(texts[-1])
        if n >= WORDS or i + 1 == batch.num_rows:
            yield batch.slice(first, len(texts)), texts
            first, texts, n = i + 1, [], 0


def _collapsed(words: list[bytes], own: list[tuple[int, int, int]]) -> bytes:
    edge = np.zeros(len(words) + 1, np.int32)
    for start, length, period in own:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(itertools.compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(text: str, least: int, periods: int):
    def of(batches):
        for whole in batches:
            for batch, texts in _batches(whole, text):
                interned = _Interned()
                ids = np.fromiter(map(interned.__getitem__, itertools.chain.from_iterable(texts)), np.int32)
                told = runs(ids, np.array([len(t) for t in texts], np.int64), least, periods)
                lists = [told.get(i, []) for i in range(len(texts))]
                flat = np.array([r for own in lists for r in own], np.int64).reshape(-1, 3)
                parts = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
                ends = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
                kept = pa.array([_collapsed(w, own) if own else b" ".join(w) for w, own in zip(texts, lists, strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, parts), kept], names=[*batch.schema.names, "runs", "collapsed_text"])

    return of


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """docs with runs, array<struct<start, length, period>> by start and period, and collapsed_text.

    Words are runs of characters other than ASCII white space, numbered from 0. A run is a longest stretch of consecutive
    words with smallest period q, of at least `least` words and `periods` periods (six and four or more). collapsed_text
    joins by one space the words that are in no run or among the first q of each run that holds them. Null and empty texts
    have no words, no runs and an empty collapsed_text. Every row stays, equal ones too; no column but the text is
    looked at, and columns of docs with the names that are added are replaced. A text is the work of one task, whose memory
    and time follow its words (time times the logarithm of their number).
    """
    docs = docs.drop("runs", "collapsed_text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_text string"])
    return docs.mapInArrow(tidy(_found(text, least, periods)), schema)


def repeating(doc_id: Column, text: Column) -> Column:
    """The text, or for ids whose crc32 is divisible by ten its words with the last ones replaced by a repetition of some."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        return F.concat(F.slice(w, 1, a), F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), 1, n - a))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = F.array_join(F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(w)), 1), " ")
    return F.when((h % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    longest = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    told = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, longest).alias("top"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    length = -F.col("top.n")
    exponent = F.expr("(1000 * -top.n) div top.period")
    return out.select("doc_id", "n_runs", F.col("top.start").alias("start"), length.alias("length"), F.col("top.period").alias("period"), exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: crc32 stands as a polynomial over the bits of the id's digits, as SQL has no such function.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, text, doc_id::VARCHAR AS s FROM documents),
bits AS (
  SELECT r, s, 0 AS k, 4294967295::UBIGINT AS c FROM d
  UNION ALL
  SELECT r, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::UBIGINT) ELSE c END AS x FROM bits WHERE k < 8 * length(s))
), h AS (SELECT r, xor(c, 4294967295::UBIGINT)::BIGINT AS h FROM bits WHERE k = 8 * length(s)),
w0 AS (
  SELECT r, doc_id, coalesce(h, 1) AS h, coalesce(h, 1) // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM d LEFT JOIN h USING (r)
), w1 AS (SELECT *, len(l)::BIGINT AS n, CASE WHEN len(l) > 0 THEN g % len(l) END AS a FROM w0),
w2 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM w1),
w AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN l[i + 1] ELSE l[a + (i - a) % p + 1] END) ELSE l END AS l FROM w2
), single AS (SELECT r, n, i, l[i + 1] AS word FROM w, unnest(range(n)) AS u(i)),
pairs AS (SELECT x.r, y.i - x.i AS p, x.i FROM single x JOIN single y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM pairs),
stretches AS (SELECT r, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY r, p, island HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (SELECT r, start, length, min(p) AS period FROM stretches GROUP BY r, start, length),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         arg_min({'start': start, 'length': length, 'period': period}, [-length, start, period]) AS top
  FROM runs GROUP BY r
), gone AS (SELECT DISTINCT r, i FROM runs, unnest(range(start + period, start + length)) AS u(i)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM single ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period, 1000 * top.length // top.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (r) LEFT JOIN kept USING (r)
"""
