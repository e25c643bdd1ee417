"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digit substitutions to one Latin letter per class
(l, 1 and i are one class), and turns everything that is not a letter into one space; terms and exception phrases are
folded alike and match whole words only, but for stems (ending in *), which match where a word begins so. A term may ask
for repetition (ending in #2, say): it then matches only in texts that hold it so often and at least at a rate per word, as
some stems are rare in clean texts and stand again and again in toxic ones. A hit inside an exception phrase does not
count. Hits are weighted, and a logistic curve over presence, weight and weight per word gives a score from 0 to 1.

Null and empty texts have no hits and get the score of a text without hits. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, table, tidy

#: Most labelled rows that a model is fitted on; the rows with the smallest hash of their id.
TRAIN_ROWS = 8_000
#: Lengths of the stems that are tried: so many first letters of a longer word.
STEMS = (4, 5, 6, 7)
#: Repetitions that a term may ask for, and the least share of a text's words that they must be.
REPEATS, RATE = (2, 3, 4), 0.005
#: Most terms that are tried, and most that are kept.
CANDIDATES, TERMS = 2_000, 200
#: Ridge of the slopes: presence, weight, weight per word.
RIDGE = (0.01, 0.1, 1.0)
#: Terms that are tried whatever the labelled rows hold.
SEEDS = (
    "idiot moron imbecile stupid dumb loser scum trash garbage filth vermin worthless pathetic disgusting clown jerk "
    "creep freak pig rat scumbag dumbass bastard bitch asshole shithead retard cretin lowlife degenerate subhuman"
).split()
#: Phrases in which a term is not meant as an insult.
EXCEPTIONS = "trash can|trash bin|class clown|clown fish|pond scum|guinea pig|lab rat|garbage collection|garbage collector|garbage truck|pathetic fallacy".split("|")

# Letters that look like a Latin letter, and digits and signs written for one.
_ALIKE = {
    "a": "аαàáâãäå4@", "b": "вβ8", "c": "сçϲ", "d": "ԁ", "e": "еεèéêëё3", "h": "һн", "i": "іιìíîïl1ӏ", "j": "јϳ", "k": "кκ", "m": "мμ", "n": "ñ",
    "o": "оοσòóôõöø0", "p": "рρ", "q": "ԛ", "s": "ѕ5$", "t": "тτ7", "u": "υùúûü", "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уγýÿ", "z": "ᴢ",
}
_FOLD = str.maketrans({c: to for to, cs in _ALIKE.items() for c in cs} | {chr(0xFF41 + i): chr(97 + i) if i != 11 else "i" for i in range(26)})
_NO_LETTER = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    return f" {_NO_LETTER.sub(' ', (text or '').lower().translate(_FOLD)).strip()} "


def _forms(term: str, count: int, words: int) -> list[str]:
    """The term with every repetition that so many hits among so many words reach."""
    return [term, *(f"{term}#{k}" for k in REPEATS if count >= k and count >= RATE * words)]


@dataclass(frozen=True)
class Model:
    """Folded terms with weights, folded exception phrases, and the logistic curve's coefficients."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float, float] = (-3.0, 5.0, 0.0, 0.0)
    automaton: list = field(default_factory=list, compare=False, repr=False)

    def _machine(self):
        if not self.automaton:
            import ahocorasick

            a = ahocorasick.Automaton()
            for t in {t.split("#")[0] for t in self.weights}:
                own = f" {t[:-1]}" if t.endswith("*") else f" {t} "
                a.add_word(own, (len(own), t, True))
            for t in self.exceptions:
                a.add_word(f" {t} ", (len(t) + 2, t, False))
            if len(a):
                a.make_automaton()
            self.automaton.append(a)
        return self.automaton[0]

    def __getstate__(self):
        return {**self.__dict__, "automaton": []}

    def found(self, folded: str) -> tuple[list[tuple[int, int, str]], dict[str, list[str]]]:
        """(start, end, term without repetition) of every hit outside exception phrases, and the forms that the text reaches of each."""
        a = self._machine()
        if not len(a):
            return [], {}
        found, safe = [], []
        for end, (n, term, bad) in a.iter(folded):
            (found if bad else safe).append((end - n + 2, end, term))
        if safe:
            found = [x for x in found if not any(s <= x[0] <= e for s, e, _ in safe)]
        words = folded.count(" ") - 1
        return found, {t: [f for f in _forms(t, n, words) if f in self.weights] for t, n in Counter(t for _, _, t in found).items()}

    def hits(self, folded: str) -> list[tuple[int, int, str]]:
        """(start, end, term) of every hit in the folded text; each word counts once for a term, in its form of most weight."""
        found, forms = self.found(folded)
        best = {t: max(own, key=lambda f: (self.weights[f], f)) for t, own in forms.items() if own}
        return [(s, e, best[t]) for s, e, t in found if t in best]

    def features(self, folded: str) -> tuple[float, float, float]:
        hits = self.hits(folded)
        if not hits:
            return 0.0, 0.0, 0.0
        weight = sum(self.weights[t] for _, _, t in hits)
        return 1.0, math.log1p(weight), 100.0 * weight / (folded.count(" ") - 1)

    def score(self, text: str | None) -> float:
        x = self.features(fold(text))
        z = self.curve[0] + sum(c * v for c, v in zip(self.curve[1:], x, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def default_model() -> Model:
    return Model({fold(t).strip(): 1.0 for t in SEEDS}, tuple(fold(t).strip() for t in EXCEPTIONS))


def _fitted_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Newton's method for a logistic curve with a small ridge; slopes stay at 0 or above."""
    b = np.zeros(x.shape[1] + 1)
    design = np.hstack([np.ones((len(x), 1)), x])
    ridge = np.diag([1e-6, *RIDGE])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        grad = design.T @ (y - p) - ridge @ b
        hess = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + ridge
        step = np.linalg.solve(hess, grad)
        b = b + step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        b[1:] = np.maximum(b[1:], 0)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


def _terms_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and clean rows of the partition hold each word and each stem, and hold it so often."""
    bad, good = Counter(), Counter()
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
            words = fold(text).split()
            seen = Counter(words)
            for w, n in list(seen.items()):
                for k in STEMS:
                    if len(w) > k:
                        seen[w[:k] + "*"] += n
            (bad if toxic else good).update(f for t, n in seen.items() for f in _forms(t, n, len(words)))
    terms = list(bad.keys() | good.keys())
    for at in range(0, len(terms), 50_000):
        some = terms[at : at + 50_000]
        yield pd.DataFrame({"term": some, "b": [bad[t] for t in some], "g": [good[t] for t in some]})


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, rows: int = TRAIN_ROWS) -> Model:
    """A model from the labels (doc_id, toxic) of docs (doc_id, text).

    train is a condition on labels. At most `rows` labelled rows are used. Copies of a text count once. Without rows
    of both labels the default model results.
    """
    some = labels.where(train) if train is not None else labels
    some = some.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    rows_df = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic", F.xxhash64("text").alias("row"))
    rows_df = rows_df.dropDuplicates(["row"]).persist()
    try:
        totals = {r["toxic"]: r["n"] for r in rows_df.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        bad, good = totals.get(1, 0), totals.get(0, 0)
        base = default_model()
        if not bad or not good:
            return base
        odds = F.log((F.col("b") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("g") + 0.5) / F.lit(good + 1.0))
        counts = rows_df.mapInPandas(tidy(_terms_of), "term string, b long, g long").groupBy("term").agg(F.sum("b").alias("b"), F.sum("g").alias("g"))
        seeds = list(base.weights)
        top = counts.where((F.col("b") >= 3) & (F.length("term") > 2)).withColumn("odds", odds).where("odds > 1.5")
        top = top.orderBy(F.desc(F.col("odds") * F.sqrt("b")), "term").limit(CANDIDATES)
        tried = {r["term"]: (r["b"], r["g"], r["odds"]) for r in [*top.collect(), *counts.where(F.col("term").isin(seeds)).withColumn("odds", odds).collect()]}
        trial = Model({t: 1.0 for t in tried}, ())

        def found(batches):
            for pdf in batches:
                yield pd.DataFrame({"toxic": pdf["toxic"], "terms": [sorted(f for own in trial.found(fold(x))[1].values() for f in own) for x in pdf["text"]]})

        seen = rows_df.mapInPandas(tidy(found), "toxic int, terms array<string>").collect()
        kept = _cover(seen, tried)
        weights = {t: float(max(0.1, tried[t][2])) for t in kept} | {t: 1.0 for t in seeds if t not in tried}
        model = Model(weights, base.exceptions)
        exceptions = _learned_exceptions(rows_df, model)
        model = Model(weights, (*base.exceptions, *exceptions))

        def measured(batches):
            for pdf in batches:
                x = [model.features(fold(t)) for t in pdf["text"]]
                yield pd.DataFrame({"toxic": pdf["toxic"], "a": [v[0] for v in x], "b": [v[1] for v in x], "c": [v[2] for v in x]})

        sample = rows_df.mapInPandas(tidy(measured), "toxic int, a double, b double, c double").toPandas()
        return Model(weights, model.exceptions, _fitted_curve(sample[["a", "b", "c"]].to_numpy(), sample["toxic"].to_numpy(float)))
    finally:
        rows_df.unpersist()


def _cover(seen: list, tried: dict[str, tuple]) -> list[str]:
    """Terms in the order in which each explains most toxic rows that none before it explains, less the clean rows it hits."""
    at: dict[str, tuple[set, set]] = {t: (set(), set()) for t in tried}
    for i, r in enumerate(seen):
        for t in r["terms"]:
            at[t][0 if r["toxic"] else 1].add(i)
    kept, done, hurt = [], set(), set()
    least = max(5, 0.005 * sum(r["toxic"] for r in seen))
    while len(kept) < TERMS:
        gain, _, _, _, best = max(((len(b - done) - 2 * len(g - hurt), "#" not in t, "*" not in t, len(t), t) for t, (b, g) in at.items() if t not in kept), default=(0, 0, 0, 0, ""))
        if gain < least:
            break
        kept.append(best)
        done |= at[best][0]
        hurt |= at[best][1]
    # Seeds that stand only in toxic rows and often count too, though others explain those rows.
    return kept + [t for t in default_model().weights if t in at and t not in kept and len(at[t][0]) > 4 * len(at[t][1])]


def _learned_exceptions(rows: DataFrame, model: Model) -> list[str]:
    """Two-word phrases with a term that stand in three clean rows or more, and in at most a tenth as many toxic ones."""

    def phrases(batches):
        for pdf in batches:
            out = []
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                folded, own = fold(text), set()
                for s, e, _ in model.hits(folded):
                    word = folded[s : folded.index(" ", s)]
                    before, after = folded[max(0, s - 60) : s].split()[-1:], folded[s + len(word) : s + len(word) + 60].split()[:1]
                    own |= {f"{w} {word}" for w in before} | {f"{word} {w}" for w in after}
                out += [(p, toxic) for p in own]
            yield pd.DataFrame(out, columns=["phrase", "toxic"])

    found = rows.mapInPandas(tidy(phrases), "phrase string, toxic int").groupBy("phrase").agg(F.sum("toxic").alias("b"), F.sum(1 - F.col("toxic")).alias("g"))
    return [r["phrase"] for r in found.where("g >= 3 AND b * 10 <= g").orderBy(F.desc("g"), "phrase").limit(TERMS).collect()]


def score(model: Model, text: str = "text") -> Column:
    """The score of a text column."""

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return scored(F.col(text))


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with toxic_score and toxic_predicted (1 from 0.5). Columns of docs with these names are replaced; others are carried along."""
    return docs.withColumn("toxic_score", score(model, text)).withColumn("toxic_predicted", (F.col("toxic_score") >= 0.5).cast("int"))


def held_out() -> Column:
    """Whether a row is kept from learning; a null id is not (and has no label)."""
    return F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return fit(docs, table(spark, sf_dir, "labels"), ~held_out())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, fitted(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_predicted").alias("predicted"))
