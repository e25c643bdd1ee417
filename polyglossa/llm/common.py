"""What the training-data operators share: tables, lineage cuts, word hashes and components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The six ASCII characters that separate words; bytes.split() uses the same set.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local master gets a local one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def staged(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage is cut, and lost executors lose nothing.

    partitions deals the reread rows out again, where the table is small in bytes but costly to work on.
    """
    out = df.sparkSession.read.schema(df.schema).parquet(written(df, name))
    return out.repartition(partitions) if partitions else out


def written(df: DataFrame, name: str) -> str:
    """The path in the shared folder that df was written to as Parquet."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return path


def told_apart(docs: DataFrame, doc_id: str) -> tuple[DataFrame, str]:
    """docs and a column of whole numbers that tells its rows apart: doc_id if its ids are such, unique and not null.

    Else rows are numbered in the order of their ids, null last, in a column of a new name. docs is then written once, so
    that the numbers stay; rows of one id may be many, so a row's place breaks ties.
    """
    whole = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    if whole and docs.groupBy(doc_id).count().where(f"count > 1 OR `{doc_id}` IS NULL").isEmpty():
        return docs, doc_id
    name = "_row"
    while name in docs.columns:
        name += "_"
    placed = docs.withColumn(name, F.monotonically_increasing_id()).orderBy(F.col(doc_id).asc_nulls_last(), name)
    return staged(placed.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def whole_ids(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame | None]:
    """df with the ids of a column as whole numbers, and the table (n, name) of those numbers where ids are none themselves.

    Numbers follow the order of the ids; null stays null.
    """
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return df.withColumn(column, F.col(column).cast("long")), None
    names = df.select(F.col(column).alias("name")).where("name IS NOT NULL").distinct().orderBy("name")
    names = staged(names.withColumn("n", F.monotonically_increasing_id()), "names")
    return named(df, names.select(F.col("n").alias("name"), F.col("name").alias("n")), [column]), names


def named(df: DataFrame, names: DataFrame | None, columns: list[str]) -> DataFrame:
    """df with the names of the numbers in columns."""
    for c in columns if names is not None else ():
        told = names.select(F.col("n").alias("_n"), F.col("name").alias("_name"))
        rest = [F.col("_name").alias(c) if own == c else F.col(f"`{own}`") for own in df.columns]
        df = df.join(told, df[c] == told["_n"], "left").select(*rest)
    return df


def wide(spark: SparkSession) -> int:
    """Tasks for compute-heavy work on few bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(n))


def give_back() -> None:
    """Returns free memory of this process to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no malloc_trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(of: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """of, with free memory given back when a task ends: Python workers outlive their tasks and stages."""

    def run(batches):
        try:
            yield from of(batches)
        finally:
            give_back()

    return run


# ---- words and windows ------------------------------------------------------------------------

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Odd multipliers of the two window polynomials.
_Q = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words. Words of up to LONG bytes are kept, at most LIMIT of them, so that the bytes are bounded too."""

    LIMIT, LONG = 250_000, 48

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= self.LONG:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class Windows:
    """Hashes of all windows of n consecutive words, from prefix sums modulo 2**64."""

    def __init__(self, which: int = 0) -> None:
        self.q, self.inverse = _Q[which], pow(_Q[which], -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", self.q), ("down", self.inverse)):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a))

    def hashes(self, w: np.ndarray, n: int) -> np.ndarray:
        if len(w) < n:
            return np.empty(0, np.uint64)
        self._powers(len(w) + 1)
        s = np.zeros(len(w) + 1, np.uint64)
        np.cumsum(w * self.up[: len(w)], out=s[1:])
        return mixed((s[n:] - s[: len(w) - n + 1]) * self.down[: len(w) - n + 1])


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_chunks(texts: Iterable[bytes | None], hashes: WordHashes, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words per row, hashes of all words) for runs of rows with about `limit` words."""
    first, row, counts, words = 0, -1, [], []
    for row, text in enumerate(texts):
        own = text.split() if text else []
        counts.append(len(own))
        words += own
        if len(words) >= limit:
            yield first, np.array(counts, np.int64), hashes.of(words)
            first, counts, words = row + 1, [], []
    if counts:
        yield first, np.array(counts, np.int64), hashes.of(words)


def positions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, its place in its row)."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def shingles(counts: np.ndarray, w: np.ndarray, windows: Windows, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of n words; a row with 1 to n - 1 words has one shingle of all its words."""
    row, _ = positions(counts)
    if len(w) >= n:
        h = windows.hashes(w, n)
        inside = row[: len(h)] == row[n - 1 :]
        rows, hs = row[: len(h)][inside], h[inside]
    else:
        rows, hs = np.empty(0, np.int64), np.empty(0, np.uint64)
    starts = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.concatenate([windows.hashes(w[starts[r] : starts[r] + counts[r]], int(counts[r])) ^ np.uint64(int(counts[r])) for r in short])
        rows, hs = np.concatenate([rows, short]), np.concatenate([hs, extra])
    return rows, hs


# ---- groups and texts in transit ----------------------------------------------------------------


def whole_groups(batches: Iterable, keys: list[str], rows: int = 5_000) -> Iterator[tuple]:
    """(frame, first row of each group) for frames of whole groups, from batches in which the rows of a group stand together."""
    import pandas as pd

    held: list = []

    def bounds(pdf) -> np.ndarray:
        new = np.ones(len(pdf), bool)
        new[1:] = False
        for k in keys:
            v = pdf[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        for at in range(0, len(batch), rows):
            pdf = pd.concat([*held, batch.iloc[at : at + rows]], ignore_index=True) if held else batch.iloc[at : at + rows].reset_index(drop=True)
            first = bounds(pdf)
            cut = int(first[-1])
            if cut:
                yield pdf.iloc[:cut], first[:-1]
            held = [pdf.iloc[cut:]]
    if held and len(held[0]):
        pdf = held[0].reset_index(drop=True)
        yield pdf, bounds(pdf)


def compressed(df: DataFrame, text: str) -> DataFrame:
    """df with the text column as Zstandard frames, for shuffles whose own codec hardly compresses short texts."""
    import pyarrow as pa

    def of(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            at = batch.schema.names.index(text)
            packed = pa.array([None if t is None else pack(t) for t in batch.column(at).cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], packed, *batch.columns[at + 1 :]], names=batch.schema.names)

    return df.mapInArrow(tidy(of), ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in df.schema.fields))


def decompressor():
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return lambda z: None if z is None else unpack(z)


# ---- components -------------------------------------------------------------------------------


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its component) for links given as two arrays of ids."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            return ids, ids[label]
        label = low


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of the links (a, b).

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots by pointer jumping and
    contracts the links, so the number of rounds grows with the logarithm of the nodes. Counts alone come to the driver.
    """

    def forest(batches):
        import pandas as pd

        for pdf in batches:
            if len(pdf):
                v, root = local_roots(pdf["a"].to_numpy(), pdf["b"].to_numpy())
                yield pd.DataFrame({"a": v, "b": root})

    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    e = staged(e.mapInPandas(forest, "a long, b long").where("a <> b").distinct(), "edges")
    nodes = None
    while not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = staged(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("p")), "hooks")
        while True:
            q = up.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            nxt = staged(up.join(q, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")), "jumps")
            done = nxt.where("moved").isEmpty()
            up = nxt.select("v", "p")
            if done:
                break
        if nodes is None:
            nodes = up
        else:
            nodes = staged(nodes.join(up.select(F.col("v").alias("p"), F.col("p").alias("r")), "p", "left").select("v", F.coalesce("r", "p").alias("p")), "nodes")
        ra, rb = up.select(F.col("v").alias("a"), F.col("p").alias("ra")), up.select(F.col("v").alias("b"), F.col("p").alias("rb"))
        e = staged(e.join(ra, "a").join(rb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct(), "edges")
    if nodes is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.select(F.col("v").alias("node"), F.col("p").alias("component"))
