"""Packing documents into sequences of a fixed number of tokens by patterns of lengths.

Tokens are counted once, pieces (documents, or cuts of long ones) go to a histogram of at most `capacity` lengths, and
the driver plans on that histogram alone: patterns of one to three lengths that fill a sequence exactly are enumerated,
their repeats are fitted to the histogram by non-negative least squares, rounded, and what remains is packed best
fit first, longest pieces first. The plan is a table of runs (length, ranks, sequence, offset) whose size does not
depend on the number of documents; every piece finds its run by its rank among the pieces of its length.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, staged, table, tidy

CAPACITY = 4096
END = 1
#: Lengths that may be the middle one of three, and rounds of the fit.
MIDDLES, ROUNDS = 48, 400


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Runs:
    """Token ids of known strings: the strings, and where the ids of each stand in one pool. The first is empty."""

    def __init__(self) -> None:
        self.names = pa.array([""])
        self.lengths, self.pool = np.zeros(1, np.int64), np.zeros(0, "<u4")

    def find(self, names: pa.Array) -> np.ndarray:
        """The place of each name, -1 for unknown ones."""
        return pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def ids(self, at: np.ndarray) -> np.ndarray:
        """The ids of the strings at these places, one after another."""
        n = self.lengths[at]
        first = (np.cumsum(self.lengths) - self.lengths)[at] - (np.cumsum(n) - n)
        return self.pool[np.repeat(first, n) + np.arange(n.sum())]

    def add(self, names: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.names = pa.concat_arrays([self.names, names])
        self.lengths, self.pool = np.concatenate([self.lengths, lengths]), np.concatenate([self.pool, ids])

    def keep(self, at: np.ndarray) -> np.ndarray:
        """Forgets all but the strings at these places, which it returns in the order kept."""
        at = np.union1d(at, [0])
        self.pool, self.lengths, self.names = self.ids(at), self.lengths[at], self.names.take(pa.array(at))
        return at


class WordIds:
    """Token ids of texts by way of their runs without ASCII white space.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its runs in order.
    Distinct runs are looked up a batch at a time. New runs of Latin letters with trailing punctuation are cut in two,
    and unknown parts encoded many at a time and told apart by word-end tokens. Past a bounded number of known strings, or of
    their bytes, those of the present batch alone are kept.
    """

    LIMIT = 150_000
    #: Most bytes of known strings and of their ids.
    BYTES = 48 << 20
    #: Bytes of text worked on at once, beside at most one longer text.
    STEP = 2 << 20
    _MARKS = ".,;:!?%&$*#|"
    _LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    _PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?%&$*#|]*$"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for text that is normalised and cut already: lower case, blanks between runs of letters and of marks.
        with open(path, encoding="utf-8") as f:
            bare = json.load(f)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        # A run of letters ends where a token with the word-end suffix stands.
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words, self.parts = Runs(), Runs()

    @staticmethod
    def _raw(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _each(self, tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, ids of all) by one call a text."""
        found = [self._raw(tokenizer, t) for t in texts]
        return np.array([len(x) for x in found], np.int64), np.concatenate([np.zeros(0, "<u4"), *found])

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for lower-case runs of letters and runs of marks, by one call for all."""
        ids = self._raw(self.bare, " ".join(parts))
        ends = np.flatnonzero(self.last[ids]) + 1
        whole = len(ends) == len(parts) and (not len(ids) or ends[-1] == len(ids))
        return (np.diff(ends, prepend=0), ids) if whole else self._each(self.bare, parts)

    def _known(self, runs: Runs, names: pa.Array, learn) -> np.ndarray:
        """The places of distinct names, after learning the unknown ones; learn tells their order."""
        at = runs.find(names)
        new = at < 0
        if new.any():
            if len(runs.names) + new.sum() > self.LIMIT or runs.names.nbytes + runs.pool.nbytes + names.nbytes > self.BYTES:
                at = np.where(new, -1, np.searchsorted(runs.keep(at[~new]), at))
            before = len(runs.names)
            at[new] = before + learn(names.filter(pa.array(new)))
        return at

    def _learn_parts(self, parts: pa.Array) -> np.ndarray:
        found = []
        for first in range(0, len(parts), 2000):
            some = parts.slice(first, 2000)
            found.append(self._encoded(some.to_pylist()))
        self.parts.add(parts, *map(np.concatenate, zip(*found, strict=True)))
        return np.arange(len(parts))

    def _learn_words(self, words: pa.Array) -> np.ndarray:
        is_plain = pc.match_substring_regex(words, self._PLAIN)
        plain, other = words.filter(is_plain), words.filter(pc.invert(is_plain))
        stems, tails = pc.utf8_lower(pc.utf8_rtrim(plain, characters=self._MARKS)), pc.utf8_ltrim(plain, characters=self._LETTERS)
        cut = pa.concat_arrays([stems, tails]).dictionary_encode()
        at = self._known(self.parts, cut.dictionary, self._learn_parts)[cut.indices.to_numpy()].reshape(2, -1)
        self.words.add(plain, self.parts.lengths[at].sum(0), self.parts.ids(at.T.ravel()))
        self.words.add(other, *self._each(self.tokenizer, other.to_pylist()))
        return np.argsort(np.argsort(~is_plain.to_numpy(zero_copy_only=False), kind="stable"))

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text and the end id."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        step = (np.cumsum(sizes) - 1) // self.STEP
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(texts)]
        for first, end in itertools.pairwise(cuts):
            split = pc.ascii_split_whitespace(pc.fill_null(texts.slice(first, end - first), ""))
            flat = split.flatten().dictionary_encode()
            at = self._known(self.words, flat.dictionary, self._learn_words)[flat.indices.to_numpy()]
            ids = self.words.ids(at)
            stops = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
            ends = np.concatenate([[0], np.cumsum(self.words.lengths[at])])[stops]
            ids = np.insert(ids, ends, END)
            yield from np.split(ids, (ends + np.arange(1, len(ends) + 1))[:-1]) if len(ends) else ()


_CACHE: dict[str, WordIds] = {}


def _pieces(path: str, capacity: int, keep_ids: bool):
    def of(batches):
        if path not in _CACHE:
            _CACHE[path] = WordIds(path)
        cache = _CACHE[path]
        chunk, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, cols = batch.column("_id").to_pylist(), [[] for _ in range(8)]
            for doc, tokens in zip(ids, cache.ids(batch.column("_text").cast(pa.string())), strict=True):
                for k, at in enumerate(range(0, len(tokens), capacity)):
                    own = tokens[at : at + capacity]
                    n = len(own)
                    for c, v in zip(cols, (doc, k, at, n, zlib.crc32(own), chunk, int(ranks[n]), own.tobytes() if keep_ids else None), strict=True):
                        c.append(v)
                    ranks[n] += 1
            types = (batch.schema.field("_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "chunk", "local", "ids")
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays if keep_ids else arrays[:-1], names=names[: 7 + keep_ids])
            give_back()

    return of


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` tokens: doc_id, piece, start, length, ids_crc32, and ids (little-endian bytes) if kept."""
    src = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, chunk int, local long" + ", ids binary" * keep_ids
    return src.mapInArrow(tidy(_pieces(path or tokenizer_path(), capacity, keep_ids)), schema)


# ---- the plan ---------------------------------------------------------------------------------


def patterns(counts: np.ndarray, middles: int = MIDDLES) -> np.ndarray:
    """Patterns of one to three present lengths that sum to the capacity, as rows of three lengths (0: none)."""
    cap = len(counts) - 1
    there = np.flatnonzero(counts)
    there = there[there > 0]
    is_there = counts > 0
    out = [np.array([[cap, 0, 0]])] if is_there[cap] else []
    a = there[there * 2 >= cap]
    a = a[(a < cap) & is_there[cap - a]]
    out.append(np.stack([a, cap - a, 0 * a], 1))
    middle = there[np.argsort(-counts[there], kind="stable")[: middles // 2]]
    middle = np.union1d(middle, there[np.linspace(0, len(there) - 1, min(middles, len(there))).astype(int)] if len(there) else there)
    for b in middle:
        x = there[there < cap - b]
        c = cap - b - x
        ok = (x >= c) & (c > 0)
        x, c = x[ok], c[ok]
        ok = is_there[c]
        out.append(np.stack([x[ok], np.full(ok.sum(), b), c[ok]], 1))
    p = np.sort(np.concatenate(out), axis=1)[:, ::-1] if out else np.empty((0, 3), int)
    return np.unique(p, axis=0)


def fitted(p: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of the patterns that bring least squares of (lengths used - counts) down, by multiplicative steps."""
    h = counts.astype(float)
    h[0] = 0
    if not len(p):
        return np.zeros(0)
    present = p > 0
    gather = lambda v: (v[p] * present).sum(1)
    x = np.ones(len(p)) * h.sum() / (3 * len(p))
    pull = gather(h)
    for _ in range(rounds):
        used = np.bincount(p.ravel(), (x[:, None] * present).ravel(), minlength=len(h))
        used[0] = 0
        x = x * pull / np.maximum(gather(used), 1e-12)
    return x


def plan(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """(runs, sequences) for counts[length]: a run is (length, first rank, pieces, first sequence, step, offset).

    The pieces of a run with ranks first, first + 1, ... stand at the same offset of the sequences first sequence,
    first sequence + step, ...; step 0 puts the pieces one after another in one sequence.
    """
    cap = len(counts) - 1
    left, rank, runs, sequences = counts.astype(np.int64).copy(), np.zeros(cap + 1, np.int64), [], 0
    left[0] = 0

    def put(length: int, n: int, sequence: int, step: int, offset: int) -> None:
        runs.append((length, int(rank[length]), n, sequence, step, offset))
        rank[length] += n
        left[length] -= n

    p = patterns(left)
    x = np.rint(fitted(p, left)).astype(np.int64)  # where rounding up asks for more pieces than there are, fewer are taken
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        own = [int(v) for v in p[i] if v]
        n = min(int(x[i]), *(int(left[v]) // own.count(v) for v in own))
        if n:
            at = 0
            for v in own:
                put(v, n, sequences, 1, at)
                at += v
            sequences += n
    # Best fit for the rest: the open sequences as runs (first sequence, how many), by the room they have.
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def opened(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                insort(rooms, space)
            room.setdefault(space, []).append((first, n))

    for length in range(cap, 0, -1):
        while left[length]:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = cap // length
                first, n, space = sequences, max(1, int(left[length]) // each), cap
                sequences += n
            else:
                space = rooms[at]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space], rooms[at]
            each = space // length
            whole = min(n, int(left[length]) // each)
            if not whole:  # fewer pieces than one sequence takes
                k = int(left[length])
                put(length, k, first, 0, cap - space)
                opened(space - k * length, first, 1)
                opened(space, first + 1, n - 1)
                continue
            for k in range(each):
                put(length, whole, first, 1, cap - space + k * length)
            opened(space - each * length, first, whole)
            opened(space, first + whole, n - whole)
    return np.array(runs, np.int64).reshape(-1, 6), sequences


def packed(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset. parts is what pieces() gives; it is written once and read again."""
    spark = parts.sparkSession
    parts = staged(parts, "pieces")
    per = staged(parts.groupBy("chunk", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    runs, _ = plan(counts)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    sent = spark.sparkContext.broadcast(runs)
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = parts.join(offsets.hint("merge"), ["chunk", "length"]).withColumn("rank", F.col("local") + F.col("before"))

    def place(batches):
        runs = sent.value
        keys = (runs[:, 0] << 44) + runs[:, 1]
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(), pdf["rank"].to_numpy()
            run = runs[np.searchsorted(keys, (length << 44) + rank, side="right") - 1] if len(pdf) else np.zeros((0, 6), np.int64)
            k = rank - run[:, 1]
            yield pdf[kept].assign(sequence_id=run[:, 3] + k * run[:, 4], offset=run[:, 5] + np.where(run[:, 4] == 0, k * length, 0))

    fields = [f for f in parts.schema.fields if f.name not in ("chunk", "local")]
    kept = [f.name for f in fields]
    return ranked.select(*kept, "rank").mapInPandas(place, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset (and ids if keep_ids).

    Patterns of three lengths are tried for at most MIDDLES middle lengths, which bounds the plan; it leaves no piece out.

    A null or empty text is a document of the end id alone. Documents longer than the capacity are cut into full pieces
    and one shorter last piece; no other is cut. Each row of docs is packed, rows with equal or null ids too. An empty
    table gives no rows. Sequences are filled from offset 0 without gaps. Only the id and text columns are read.
    """
    return packed(pieces(docs, path, capacity, **options), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
