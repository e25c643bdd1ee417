"""Byte-level BPE by DuckDB recursive queries inside each partition.

A text is cut by the pattern; each new match that is no token itself becomes token-position rows. A recursive query
joins neighbouring rows with the merge table and contracts the leftmost pair of least rank of each word, until no word
has a pair left. The ids of a word are the ordered list of its last rows. Decoding joins the ids of every word, those that
are one token too, with the table of tokens, whose bytes are put together by an ordered aggregation.

Long words. One contraction a step makes the work on a word quadratic, so words of more than LONG bytes are encoded as
overlapping segments. A sequence of tokens is the encoding of its bytes if each two neighbours are the encoding of theirs;
so where two segments have a token at the same place, the one's tokens up to it and the other's from it on are exactly the
encoding of both. Where they have none, the word is tried with segments of twice the length, in the end whole.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tidy

#: Steps of one recursive query; words that need more go on in another query, so that its rows stay bounded.
STEPS = 48
#: Words, and bytes times steps, of one recursive query at most (one longer word alone goes alone).
WORDS, WORK = 40_000, 4_000_000
#: Longer words are encoded by segments of so many bytes, which begin every half segment.
LONG = 64
#: Texts, and bytes of texts beside at most one longer text, that are worked on at once.
TEXTS, STEP = 2048, 4 << 20

#: Rows keep the token after them and the token that both would make; only the rows beside a contraction look that up anew.
_RECURSION = f"""
WITH RECURSIVE s AS (
  SELECT 0 AS step, wid, pos, tok, nxt, m.merged FROM start LEFT JOIN merges m ON m.l = tok AND m.r = nxt
  UNION ALL
  SELECT c.step, c.wid, c.pos, c.tok, c.nxt, CASE WHEN c.fresh THEN m.merged ELSE c.merged END
  FROM (
    SELECT p.step + 1 AS step, p.wid, p.pos - (p.pos > b.pos)::INT AS pos, CASE WHEN p.pos = b.pos THEN b.tok ELSE p.tok END AS tok,
           CASE WHEN p.pos = b.pos THEN b.nxt WHEN p.pos = b.pos - 1 THEN b.tok ELSE p.nxt END AS nxt,
           p.merged, p.pos = b.pos OR p.pos = b.pos - 1 AS fresh
    FROM s p JOIN (
      SELECT a.wid, a.best >> 32 AS tok, a.best & 4294967295 AS pos, y.nxt
      FROM (SELECT wid, min(merged::BIGINT * 4294967296 + pos) AS best FROM s WHERE merged IS NOT NULL GROUP BY wid) a
      JOIN s y ON y.wid = a.wid AND y.pos = (a.best & 4294967295) + 1
    ) b ON b.wid = p.wid
    WHERE p.pos <> b.pos + 1 AND p.step < {STEPS}
  ) c LEFT JOIN merges m ON m.l = CASE WHEN c.fresh THEN c.tok END AND m.r = c.nxt
), last AS (SELECT wid, max(step) AS step FROM s GROUP BY wid)
SELECT s.wid, any_value(last.step) AS step, list(tok ORDER BY pos) AS ids
FROM s JOIN last ON last.wid = s.wid AND last.step = s.step
GROUP BY s.wid ORDER BY s.wid
"""
_DECODING = "SELECT string_agg(hex, '' ORDER BY pos) AS decoded FROM coded JOIN tokens ON tokens.id = coded.id GROUP BY wid ORDER BY wid"


def rank_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def joined(segments: list[tuple[int, bytes]], sizes: np.ndarray) -> bytes | None:
    """The ids of a word from (first byte, ids) of overlapping segments; sizes tells bytes of ids. None if two have no token in common."""
    out, at, begin, held = [], 0, segments[0][0], np.frombuffer(segments[0][1], "<u4")
    for begin2, ids in segments[1:]:
        after = np.frombuffer(ids, "<u4")
        ends, ends2 = begin + np.cumsum(sizes[held]), begin2 + np.cumsum(sizes[after])
        # the same token at the same place ends at the same byte
        _, i, j = np.intersect1d(ends, ends2, return_indices=True)
        same = np.flatnonzero((held[i] == after[j]) & (i >= at))
        if not len(same):
            return None
        i, j = int(i[same[0]]), int(j[same[0]])
        out.append(held[at : i + 1])
        begin, held, at = begin2, after, j + 1
    return np.concatenate([*out, held[at:]]).tobytes()


class Encoder:
    """Ids and decoded bytes of pattern matches; short matches are kept in two generations of a bounded size."""

    LIMIT = 200_000

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.sizes = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.sizes[list(self.ranks.values())] = [len(t) for t in self.ranks]
        merges = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        l, r, m = (pa.array(x, pa.int32()) for x in zip(*merges, strict=True))
        # Queries are so small that they need no folder to spill to.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self._table("merges", {"l": l, "r": r, "merged": m})
        self._table("tokens", {"id": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        #: Words that are one token: no more than there are tokens.
        self.one: dict[str, tuple[bytes, bytes]] = {}
        self.new: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def known(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit integers, decoded bytes) of each of these different words."""
        if len(self.new) >= self.LIMIT:
            self.old, self.new = self.new, {}
        one, new = self.one.get, self.new.get
        own = [one(w) or new(w) for w in words]
        gaps = []
        for k in [k for k, v in enumerate(own) if v is None]:
            got = self.old.get(words[k])
            if got is None:
                gaps.append(k)
            else:
                self.new[words[k]] = own[k] = got
        if gaps:
            ids = self._encoded([words[k].encode("utf-8", "surrogatepass") for k in gaps])
            for k, got in zip(gaps, zip(ids, self._decoded(ids), strict=True), strict=True):
                own[k] = got
                if len(got[0]) == 4:
                    self.one[words[k]] = got
                elif len(words[k]) <= LONG:
                    self.new[words[k]] = got
        return own

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        out: list = [None] * len(words)
        short, long = [], []
        for k, raw in enumerate(words):
            token = self.ranks.get(raw)
            if token is not None:
                out[k] = token.to_bytes(4, "little")
            else:
                (short if len(raw) <= LONG else long).append(k)
        for k, ids in zip(short, self._merged([words[k] for k in short]), strict=True):
            out[k] = ids
        size = LONG
        while long:
            cuts = [[(at, words[k][at : at + size]) for at in range(0, max(1, len(words[k]) - size // 2), size // 2)] for k in long]
            found = iter(self._merged([raw for own in cuts for _, raw in own]))
            for k, own in zip(long, cuts, strict=True):
                out[k] = joined([(at, next(found)) for at, _ in own], self.sizes)
            long = [k for k in long if out[k] is None]
            size *= 2
        return out

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of words by the recursive query, many words at a time."""
        out: list[bytes] = []
        first, work = 0, 0
        for k, raw in enumerate(words):
            mine = len(raw) * min(len(raw), STEPS)
            if k > first and (work + mine > WORK or k - first >= WORDS):
                out += self._contracted(words[first:k])
                first, work = k, 0
            work += mine
        return out + self._contracted(words[first:])

    def _contracted(self, words: list[bytes]) -> list[bytes]:
        out: list = [None] * len(words)
        wid = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
        tok = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        while len(wid):
            n = np.bincount(wid)
            n = n[n > 0]
            pos = (np.arange(len(wid)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
            nxt = np.append(tok[1:], np.int32(-1))
            nxt[np.cumsum(n) - 1] = -1
            self._table("start", {"wid": wid, "pos": pos, "tok": tok, "nxt": nxt})
            got = self.db.sql(_RECURSION).to_arrow_table()
            which, done, ids = got.column("wid").to_numpy(), got.column("step").to_numpy() < STEPS, got.column("ids").combine_chunks()
            flat, ends = ids.values.to_numpy().astype(np.int32), ids.offsets.to_numpy()
            raw, at = flat.astype("<u4").tobytes(), 4 * ends
            for k, a, b in zip(which[done].tolist(), at[:-1][done].tolist(), at[1:][done].tolist(), strict=True):
                out[k] = raw[a:b]
            n = np.diff(ends)
            more = np.repeat(~done, n)
            wid, tok = np.repeat(which, n)[more].astype(np.int32), flat[ends[0] : ends[-1]][more]
        return out

    def _decoded(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each word's ids, by the table of tokens; a bounded number of ids at a time."""
        out: list[bytes] = []
        size = np.array([len(i) // 4 for i in ids])
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // 400_000)) + 1
        for a, b in itertools.pairwise([0, *cuts.tolist(), len(ids)]):
            n = size[a:b]
            wid = np.repeat(np.arange(b - a, dtype=np.int32), n)
            pos = np.arange(len(wid)) - np.repeat(np.cumsum(n) - n, n)
            self._table("coded", {"wid": wid, "pos": pos, "id": np.frombuffer(b"".join(ids[a:b]), "<u4").astype(np.int32)})
            out += map(bytes.fromhex, self.db.sql(_DECODING).to_arrow_table().column("decoded").to_pylist())
        return out

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[memoryview, memoryview]]:
        """(ids as little-endian 32-bit integers, decoded bytes) of each text."""
        size = np.array([len(t or "") for t in texts])
        cuts = np.flatnonzero(np.diff((np.cumsum(size) - 1) // STEP)) + 1
        for first, end in itertools.pairwise([0, *cuts.tolist(), len(texts)]):
            split = [self.split(t) if t else [] for t in texts[first:end]]
            stops = np.cumsum([len(s) for s in split])
            words = pa.array(list(itertools.chain.from_iterable(split)), pa.large_string()).dictionary_encode()
            known = self.known(words.dictionary.to_pylist())
            codes = words.indices.to_numpy().astype(np.int64)
            (ids, id_ends), (raw, raw_ends) = (_gathered([k[i] for k in known], codes, kind) for i, kind in ((0, np.uint32), (1, np.uint8)))
            at = [0, *stops.tolist()]
            for a, b in itertools.pairwise(at):
                yield memoryview(ids[id_ends[a] : id_ends[b]]).cast("B"), memoryview(raw[raw_ends[a] : raw_ends[b]])


def _gathered(parts: list[bytes], codes: np.ndarray, kind: type, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The parts at these places one after another, and where each begins (and the last ends).

    About `step` items are put together at a time, so that the places they come from take bounded memory beside the result.
    """
    pool = np.frombuffer(b"".join(parts), kind)
    size = np.array([len(p) for p in parts], np.int64) // np.dtype(kind).itemsize
    begin = np.cumsum(size) - size
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size[codes])])
    out = np.empty(ends[-1], kind)
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1], step)))
    for a, b in itertools.pairwise([*cuts.tolist(), len(codes)]):
        first, n = begin[codes[a:b]] - ends[a:b], size[codes[a:b]]
        out[ends[a] : ends[b]] = pool[np.repeat(first, n) + np.arange(ends[a], ends[b])]
    return out, ends


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", doc_id: str = "doc_id", keep: bool = True) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if kept, ids (little-endian bytes) and decoded (bytes).

    Null text counts as empty and has no ids. Each match of the pattern is encoded by itself, without special tokens,
    as the rank file says; the decoded bytes are put together from the tokens of the ids. Rows stand for themselves,
    whatever their ids. Only the id and text columns are read.
    """
    import public_tokenizers

    key = path or rank_path(), pattern or public_tokenizers.PATTERN

    def of(batches):
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(*key)
        encoder = _ENCODERS[key]
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found = list(encoder.encoded(part.column("_text").to_pylist()))
                arrays = [part.column("_id"), pa.array([len(i) // 4 for i, _ in found], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i, _ in found]), pa.array([hashlib.sha256(d).hexdigest() for _, d in found])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    arrays += [pa.array([i for i, _ in found], pa.binary()), pa.array([d for _, d in found], pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    src = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return src.mapInArrow(tidy(of), f"doc_id {src.schema['_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded binary" * keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), keep=False)
