"""Substring dedup: repeated windows of words are found through anchors on a difference cover, then removed.

Two equal windows of n words share an aligned anchor: with a difference cover D modulo v, any two positions i and j have
a shift below v that takes both into D. So it is enough to hash runs of n - v + 1 words at positions in D. Runs that
occur twice are the seeds. Seeds are extended by whole windows: only the windows that hold a seed are hashed, to 95 bits (64 and
31), and those whose hash occurs again are the repeated ones. They are not compared word by word, so "equal" means equal
up to collisions of 95 bits. Of equal texts all words of all copies go (given n words), and one copy stands for them where
windows are compared; frequent digests are answered by a broadcast of bounded size, the rest by a shuffle.

Each task first removes repeats of its own block, so that the shuffle gets one row a block for any hash however hot it is.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WordHashes, Windows, compressed, decompressor, mixed, positions, staged, table, tidy, told_apart, word_chunks
from .exact_dedup import frequent

WORDS = 35
PERIOD = 21
#: Hashes that a task holds before it passes them on.
BLOCK = 1 << 19


@lru_cache
def cover(period: int) -> tuple[int, ...]:
    """A smallest set D with every residue modulo period the difference of two members."""
    for size in range(1, period + 1):
        if size * (size - 1) + 1 < period:
            continue
        for rest in itertools.combinations(range(1, period), size - 1):
            d = (0, *rest)
            if len({(a - b) % period for a in d for b in d}) == period:
                return d
    raise ValueError(period)


def _local(h: np.ndarray, h2: np.ndarray, key: np.ndarray, pos: np.ndarray, salt: int) -> pa.RecordBatch:
    """A block's hashes with repeats of the block marked; of equal ones only the first keeps its hash as the key to be dealt by."""
    order = np.argsort(h, kind="stable")
    a, b = h[order], h2[order]
    same = np.zeros(len(a), bool)
    same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    seen = same.copy()
    seen[:-1] |= same[1:]
    mark, again = np.zeros(len(a), bool), order[same]
    mark[order] = seen
    h, h2 = h.copy(), h2.copy()
    h[again] = mixed(again.astype(np.uint64) + np.uint64(salt))
    h2[again] = mixed(key[again].view(np.uint64) ^ mixed(pos[again].astype(np.uint64))) >> np.uint64(33)
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(h2.astype(np.int32)), pa.array(key), pa.array((2 * pos + mark).astype(np.int32))], names=["h", "h2", "key", "at"])


class _Blocks:
    def __init__(self) -> None:
        self.parts, self.n, self.salt = [], 0, 1

    def add(self, *part: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(part)
        self.n += len(part[0])
        if self.n >= BLOCK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            self.salt += self.n
            whole = _local(*(np.concatenate(x) for x in zip(*self.parts, strict=True)), self.salt)
            self.parts, self.n = [], 0
            for at in range(0, whole.num_rows, 1 << 17):
                yield whole.slice(at, 1 << 17)


#: at: twice the position, plus 1 if the block has the hash again.
_HASHED = "h long, h2 int, key long, at int"


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("_text").cast(pa.binary()).to_pylist()


def _unpacked(batch: pa.RecordBatch) -> list[bytes | None]:
    return list(map(decompressor(), batch.column("_text").to_pylist()))


def _anchors(words: int, period: int):
    at, run = np.isin(np.arange(period), cover(period)), words - period + 1

    def of(batches):
        hashes, windows, blocks = WordHashes(), Windows(), _Blocks()
        for batch in batches:
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            for first, counts, w in word_chunks(_texts(batch), hashes):
                h = windows.hashes(w, run)
                row, pos = positions(counts)
                row, pos, end = row[: len(h)], pos[: len(h)], row[run - 1 :]
                take = (row == end) & at[pos % period] & (counts[row] >= words)
                yield from blocks.add(h[take], np.zeros(int(take.sum()), np.uint64), keys[first + row[take]], pos[take])
        yield from blocks.flush()

    return of


def _around(words: int, period: int):
    """The whole windows around seeds, in 95 bits."""

    def of(batches):
        hashes, one, two, blocks = WordHashes(), Windows(0), Windows(1), _Blocks()
        for batch in batches:
            # Of copies one speaks for all.
            batch = batch.filter(pc.and_(batch.column("_pos").is_valid(), pc.invert(pc.fill_null(pc.equal(batch.column("_role"), 1), False))))
            if not batch.num_rows:
                continue
            keys, seeds = batch.column("_key").to_numpy(zero_copy_only=False), batch.column("_pos")
            for first, counts, w in word_chunks(_unpacked(batch), hashes):
                if len(w) < words:
                    continue
                own = seeds.slice(first, len(counts))
                n = np.asarray(own.value_lengths().to_numpy(zero_copy_only=False), np.int64)
                starts = np.cumsum(counts) - counts
                seed = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(starts, n)
                low = np.maximum(seed - (period - 1), np.repeat(starts, n))
                mark = np.zeros(len(w) + 2, np.int32)
                np.add.at(mark, low, 1)
                np.add.at(mark, seed + 1, -1)
                row, pos = positions(counts)
                m = len(w) - words + 1
                take = np.flatnonzero((np.cumsum(mark)[:m] > 0) & (row[:m] == row[words - 1 :]))
                yield from blocks.add(one.hashes(w, words)[take], two.hashes(w, words)[take] >> np.uint64(33), keys[first + row[take]], pos[take])
        yield from blocks.flush()

    return of


def _repeated(hashed: DataFrame) -> DataFrame:
    """(key, positions) of hashes that occur more than once."""
    same = Window.partitionBy("h", "h2")
    told = hashed.withColumn("twice", (F.max(F.col("at").bitwiseAND(1)).over(same) > 0) | (F.count("*").over(same) > 1)).where("twice")
    return told.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.shiftright("at", 1)).alias("_pos"))


def _copies(digests: DataFrame) -> DataFrame:
    """(_key, _role) for rows whose digest other rows have too: 0 for the row with the smallest key, 1 for the others.

    Verified winners of frequent digests are broadcast (at most TRACKED rows), so that only rare digests are dealt out.
    """
    digests = staged(digests, "digests")
    first = [F.min("_key").alias("first"), F.count("*").alias("n")]
    hot = digests.join(F.broadcast(frequent(digests, "digest")), "digest", "left_semi").groupBy("digest").agg(*first).where("n > 1")
    told = digests.join(F.broadcast(hot), "digest", "left")
    rest = told.where("n IS NULL").select("_key", "digest")
    many = rest.groupBy("digest").agg(*first).where("n > 1")
    both = told.where("n IS NOT NULL").unionByName(rest.join(many.hint("merge"), "digest"))
    return both.select("_key", (F.col("_key") != F.col("first")).cast("int").alias("_role"))


def _cut(words: int, name: str):
    def of(batches):
        for batch in batches:
            n_words, n_removed, kept, texts = [], [], [], _unpacked(batch)
            for text, pos, role in zip(texts, batch.column("_pos"), batch.column("_role").to_pylist(), strict=True):
                own = text.split() if text else []
                gone = 0
                if role is not None and len(own) >= words:
                    gone, left = len(own), b""
                elif pos.is_valid:
                    mark = np.zeros(len(own) + 1, np.int32)
                    at = pos.values.to_numpy(zero_copy_only=False)
                    np.add.at(mark, at, 1)
                    np.add.at(mark, at + words, -1)
                    stay = np.cumsum(mark[:-1]) == 0
                    gone = len(own) - int(stay.sum())
                    left = b" ".join(itertools.compress(own, stay.tolist()))
                else:
                    left = b" ".join(own)
                n_words.append(len(own))
                n_removed.append(gone)
                kept.append(left)
            out = batch.drop_columns(["_key", "_pos", "_text", "_role"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[*out.schema.names, name, "n_words", "n_removed", "kept_text"])

    return of


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, period: int = PERIOD) -> DataFrame:
    """docs with n_words, n_removed and kept_text: the words that no repeated window of `words` words covers, joined by one space.

    Words are runs without ASCII white space, unchanged. Windows are judged on the input. Null and empty texts have no
    words and an empty kept_text. Rows are told apart by doc_id where its ids are whole numbers, unique and not null, else
    they are numbered; equal rows are rows of their own, and each counts as another place of the other's windows.
    Columns of docs with the names that are added are replaced; other columns are carried along.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")
    docs, key = told_apart(docs, doc_id)
    # own columns with names that are used inside travel under other ones
    clash = {c: f"_own{i}_{c}" for i, c in enumerate(docs.columns) if c in ("_key", "_text", "_pos", "_role") and c not in (text, key)}
    docs = docs.withColumnsRenamed(clash)
    whole = docs.withColumnRenamed(text, "__text").withColumn("__key", F.col(key).cast("long"))
    whole = whole.drop(*(c for c in ("_key", "_text", "_pos", "_role", *([key] if key != doc_id else [])) if c in whole.columns))
    whole = whole.withColumnsRenamed({"__text": "_text", "__key": "_key"})
    kept_columns = [f for f in whole.schema.fields if f.name not in ("_key", "_text")]
    seeds = _repeated(whole.select("_key", "_text").mapInArrow(tidy(_anchors(words, period)), _HASHED))
    roles = _copies(whole.where("_text <> ''").select("_key", F.sha2("_text", 256).alias("digest")))
    sent = compressed(whole, "_text")

    def beside(found: DataFrame) -> DataFrame:
        """The same shuffle of the texts serves both joins."""
        return sent.join(found.join(roles.hint("merge"), "_key", "full").hint("merge"), "_key", "left")

    around = beside(seeds).mapInArrow(tidy(_around(words, period)), _HASHED)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_columns), "`{text}` string, n_words long, n_removed long, kept_text string".format(text=text)])
    out = beside(_repeated(around)).select(*(f"`{f.name}`" for f in kept_columns), "_key", "_text", "_pos", "_role").mapInArrow(tidy(_cut(words, text)), schema)
    return out.withColumnsRenamed({own: c for c, own in clash.items()})


def dedup_text(docs: DataFrame) -> DataFrame:
    """The columns of docs with text cut; texts that lose nothing stay as they are, and n_chars follows the text."""
    out = substring_dedup(docs).withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
v AS (SELECT doc_id, i::BIGINT AS i, array_to_string(l[i:i + 34], ' ') AS words FROM w, unnest(range(1, len(l) - 33)) AS r(i)),
many AS (SELECT words FROM v GROUP BY words HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM v SEMI JOIN many USING (words), unnest(range(35)) AS r(j)),
single AS (SELECT doc_id, i, l[i] AS word FROM w, unnest(range(1, len(l) + 1)) AS r(i)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(l)::BIGINT AS n_words, len(l)::BIGINT - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""
