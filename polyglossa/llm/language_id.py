"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are runs of three and four bytes inside a word (with its bounds) of the lower-cased text whose other
characters are blanked. A text is the mean of their embeddings; training is by mini-batches in the driver on a bounded
sample of labelled rows. For prediction the embedding and the softmax layer are multiplied out to one table of logits
a subword, which gives the same mean. A temperature and a rejection level are calibrated on rows kept from training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, table, tidy

#: Most labelled rows that a model is fitted on: those with the smallest hash of their id.
TRAIN_ROWS = 4_000
#: Hash buckets (a power of 2), dimensions, passes, rows of a step, learning rate (Adagrad's).
BUCKETS, DIM, EPOCHS, STEP, RATE = 1 << 15, 16, 8, 32, 0.3
#: Fewest steps, so that small samples are learned as well.
LEAST_STEPS = 400
#: Share of the sample kept for calibration, and the accuracy that accepted rows of it should have.
KEPT_BACK, ACCEPTED_ACCURACY = 5, 0.99
UNKNOWN = "und"
#: Characters that are worked on at once; a longer text is taken in pieces.
PIECE = 500_000
_LETTER = re.compile(r"[^\W\d_]")

#: Bytes that are no letters become blanks; bytes of longer characters stay.
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def subwords(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, row of every subword)."""
    parts = [b" " + (t or "").lower().encode("utf-8", "surrogatepass").translate(_BLANK) + b" " for t in texts]
    size = np.array([len(p) for p in parts])
    b = np.frombuffer(b"".join(parts) + b"   ", np.uint8)
    row = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    n = len(row)
    b0, b1, b2, b3 = (b[i : i + n].astype(np.uint32) for i in range(4))
    code = b0 | b1 << 8 | b2 << 16
    # A subword neither crosses a blank nor ends in the next row; a word's bounds may be its ends.
    last = np.repeat(np.cumsum(size), size)
    at = np.arange(n)
    three = (b1 != 32) & (at + 3 <= last)
    four = three & (b2 != 32) & (at + 4 <= last)
    hashed = lambda x: (x * np.uint32(2654435761)) >> np.uint32(32 - (BUCKETS.bit_length() - 1))
    ids = np.concatenate([hashed(code[three]), hashed((code[four] ^ np.uint32(0x9E3779B9)) * np.uint32(0x85EBCA6B) + b3[four])])
    return ids.astype(np.int32), np.concatenate([row[three], row[four]])


def pieces(text: str | None) -> Iterator[str]:
    """A text in pieces of at most PIECE characters, cut at blanks where there are some."""
    text, at = text or "", 0
    while len(text) - at > PIECE:
        cut = text.rfind(" ", at + 1, at + PIECE)
        cut = cut if cut > 0 else at + PIECE
        yield text[at:cut]
        at = cut
    yield text[at:]


def blocks(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(row of each piece, pieces) with about PIECE characters a block."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for part in pieces(text):
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if parts:
        yield rows, parts


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of the text's subwords in each): at most BUCKETS of them, however long the text is."""
    n = np.zeros(BUCKETS, np.int64)
    for part in pieces(text):
        n += np.bincount(subwords([part])[0], minlength=BUCKETS)
    there = np.flatnonzero(n)
    return there.astype(np.int32), (n[there] / max(n.sum(), 1)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Languages, the logits of each bucket and the bias, the temperature and the score below which a row is rejected."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """Softmax rows, from pieces of texts in blocks of a bounded number of characters."""
        sums, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for rows, parts in blocks(texts):
            ids, at = subwords(parts)
            row = np.asarray(rows)[at]
            n += np.bincount(row, minlength=len(texts))
            for c in range(len(self.languages)):
                sums[:, c] += np.bincount(row, self.logits[:, c][ids], len(texts))
        return self.softmax(sums / np.maximum(n, 1)[:, None] + self.bias)

    def softmax(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(self.languages) else z
        return z / z.sum(axis=1, keepdims=True) if len(self.languages) else z

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected): `und`, 0 and rejected where there is no letter or nothing was learned."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        p = self.probabilities(texts)
        best = p.argmax(axis=1)
        empty = np.array([not t or not _LETTER.search(t) for t in texts], bool)
        score = np.where(empty, 0.0, p[np.arange(len(texts)), best]) if len(texts) else np.zeros(0)
        return [UNKNOWN if e else self.languages[b] for e, b in zip(empty, best, strict=True)], score, empty | (score < self.reject_below)


def train(texts: list[str], langs: list[str], seed: int = 11) -> Model:
    return train_rows([features(t) for t in texts], langs, seed)


def train_rows(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], seed: int = 11) -> Model:
    """Mini-batch gradient descent on the softmax loss of the mean embedding of rows of features; every fifth row calibrates."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    y = np.array([languages.index(v) for v in langs])
    rng = np.random.default_rng(seed)
    kept = np.arange(len(y)) % KEPT_BACK == KEPT_BACK - 1
    fit = np.flatnonzero(~kept) if (~kept).any() else np.arange(len(y))
    e = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, c = rng.normal(0, 0.1, (DIM, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    steps = max(LEAST_STEPS, EPOCHS * len(fit) // STEP)
    seen = [np.full(v.shape, 1e-8, np.float32) for v in (e, w, c)]

    def move(v: np.ndarray, sums: np.ndarray, grad: np.ndarray, rate: float) -> None:
        sums += grad * grad
        v -= np.float32(rate) * grad / np.sqrt(sums)

    for s in range(steps):
        own = rng.choice(fit, min(STEP, len(fit)), replace=False)
        rate = RATE * (1 - s / steps)
        u, n = np.concatenate([rows[i][0] for i in own]), np.concatenate([rows[i][1] for i in own])
        at = np.repeat(np.arange(len(own)), [len(rows[i][0]) for i in own])
        x = np.stack([np.bincount(at, n * e[u, k], len(own)) for k in range(DIM)], axis=1).astype(np.float32)
        z = x @ w + c
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(own)), y[own]] -= 1
        p = (p / len(own)).astype(np.float32)
        back = p @ w.T
        move(w, seen[1], x.T @ p, rate)
        move(c, seen[2], p.sum(axis=0), 0.1 * rate)
        there, which = np.unique(u, return_inverse=True)
        grad = np.stack([np.bincount(which, n * back[at, k], len(there)) for k in range(DIM)], axis=1).astype(np.float32)
        part = seen[0][there] + grad * grad
        seen[0][there] = part
        e[there] -= np.float32(rate) * grad / np.sqrt(part)
    model = Model(languages, e @ w, c)
    check = np.flatnonzero(kept)
    if not len(check):
        return model
    means = np.stack([rows[i][1].astype(float) @ model.logits[rows[i][0]] for i in check])
    raw = np.log(np.maximum(model.softmax(means + model.bias), 1e-30))

    def softmax(t):
        z = np.exp(raw / t - (raw / t).max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    best = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(np.maximum(softmax(t)[np.arange(len(check)), y[check]], 1e-12)).mean())
    p = softmax(best)
    score, right = p.max(axis=1), p.argmax(axis=1) == y[check]
    order = np.argsort(-score)
    accurate = np.flatnonzero(np.cumsum(right[order]) >= ACCEPTED_ACCURACY * np.arange(1, len(order) + 1))
    level = float(score[order][accurate[-1]]) if len(accurate) else 1.0
    return Model(languages, model.logits, model.bias, float(best), level if len(accurate) < len(order) else 0.0)


def fit(docs: DataFrame, known: Column, rows: int = TRAIN_ROWS) -> Model:
    """A model from text and lang of the docs for which known holds; the features of at most `rows` of them come to the driver.

    Rows that share an id count once. Features travel as packed bytes, which the driver holds without an object a number.
    """
    some = docs.where(known & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    ids = some.groupBy("doc_id").agg(F.min("lang").alias("lang")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    picked = docs.where("text IS NOT NULL").select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]).dropDuplicates(["doc_id"])

    def told(batches):
        for pdf in batches:
            found = [features(t) for t in pdf["text"]]
            yield pdf[["doc_id", "lang"]].assign(buckets=[u.tobytes() for u, _ in found], shares=[s.tobytes() for _, s in found])

    kinds = dict(docs.dtypes)
    seen = picked.mapInPandas(tidy(told), f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, buckets binary, shares binary").collect()
    seen = sorted(seen, key=lambda r: r["doc_id"])
    return train_rows([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in seen], [r["lang"] for r in seen])


def language_id(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, lang_score and lang_rejected.

    lang_pred is a learned language, or `und` with score 0 where the text is null or has no letter. A score below the
    calibrated level marks the row as rejected, whatever lang_pred says. Equal texts get equal answers. Columns of docs
    with the names that are added are replaced; all others are carried along. Very long texts are taken in pieces; a
    subword across a cut inside a word is not seen.
    """
    at = "_told"
    while at in docs.columns:
        at += "_"

    @F.pandas_udf("lang string, score double, rejected boolean")
    def told(texts: pd.Series) -> pd.DataFrame:
        lang, score, rejected = model.predict(texts.tolist())
        return pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})

    out = docs.withColumn(at, told(F.col(text)))
    return out.withColumns({"lang_pred": F.col(at)["lang"], "lang_score": F.col(at)["score"], "lang_rejected": F.col(at)["rejected"]}).drop(at)


def held_out() -> Column:
    """Whether a row is kept from learning; a null id is not."""
    return F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, ~held_out())
    out = language_id(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
