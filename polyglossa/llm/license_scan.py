"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Words are lower-cased runs of letters and digits, shingles five of them (a template of fewer words is one shingle of its
own length). A text holds a template of k shingles if some stretch of k shingle positions holds at least the threshold's
share of them; of templates with fewer than WHOLE shingles it holds all, since one word tells their licenses apart.

Templates are dealt into classes of similar length. A class has windows that begin every `step` positions and are so long
that any stretch of the class lies whole in one of them. Of every window ROWS minima are taken for each band; a window
retrieves the templates with which it agrees in all minima of a band. A window around a stretch that just holds a template
has a known Jaccard similarity with it, and a class has as many bands as retrieve it with the chance asked for. Minima of
windows are put together from those of steps, so that overlapping windows cost no more than others. Retrieved templates
are verified exactly in the window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, Windows, mixed, table, tidy, word_chunks
from .license_texts import TEMPLATES

SHINGLE, THRESHOLD, PROBABILITY = 5, 0.8, 0.9999
#: Minima of a band.
ROWS = 2
#: Templates with fewer shingles must stand in a text whole.
WHOLE = 10
_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS)


def templates_from(folder: str) -> dict[str, str]:
    """Templates from the text files of a folder, by name, read on the driver."""
    return {p.stem: p.read_text("utf-8", "replace") for p in sorted(Path(folder).iterdir()) if p.is_file()}


def share_of(shingles: int, threshold: float) -> Fraction:
    """The share of a template of so many different shingles that a stretch must hold."""
    return Fraction(1) if shingles < WHOLE else Fraction(str(threshold))


def bands_for(template: int, window: int, threshold: float, probability: float) -> int:
    """Bands that retrieve a template of so many shingles from a window of so many positions that just holds it."""
    shared = math.ceil(share_of(template, threshold) * template)
    similar = shared / (window + template - shared)
    return 1 if similar >= 1 else math.ceil(math.log(1 - probability) / math.log(1 - similar**ROWS))


class _Class:
    """Templates of n-word shingles of similar number, with their windows and band keys."""

    def __init__(self, n: int, members: list[tuple[str, int, np.ndarray]], threshold: float, probability: float) -> None:
        self.n, self.members = n, members
        least, most = min(len(h) for *_, h in members), max(k for _, k, _ in members)
        self.step = 1 << max(0, (most // 8).bit_length() - 1)
        self.steps = -(-(most + self.step - 1) // self.step)
        self.bands = bands_for(least, self.steps * self.step, threshold, probability)
        self.keys: list[dict[int, list[int]]] = []
        self.flags = np.zeros((self.bands, 1 << 12), bool)

    def index(self, odd: np.ndarray) -> None:
        """Enters the band keys of the templates."""
        self.keys = [{} for _ in range(self.bands)]
        for t, (_, _, h) in enumerate(self.members):
            low = [_permuted(h, o).min() for o in odd[: self.bands * ROWS]]
            for b in range(self.bands):
                key = int(_band([np.array([v]) for v in low[b * ROWS : (b + 1) * ROWS]])[0])
                self.keys[b].setdefault(key, []).append(t)
                self.flags[b, key & 0xFFF] = True


def _permuted(h: np.ndarray, odd: np.uint32) -> np.ndarray:
    x = h.astype(np.uint32) * odd
    return x ^ (x >> np.uint32(15))


def _band(minima: list[np.ndarray]) -> np.ndarray:
    """One key for the minima of a band."""
    key = np.zeros(len(minima[0]), np.uint32)
    for m in minima:
        key = (key ^ m) * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(16)
    return key


class Scanner:
    """Templates in classes. Without retrieval (for tests) every template is verified everywhere."""

    def __init__(self, templates: dict[str, str], threshold: float = THRESHOLD, shingle: int = SHINGLE, probability: float = PROBABILITY, retrieve: bool = True) -> None:
        self.hashes, self.windows, self.retrieve = WordHashes(), Windows(), retrieve
        self.threshold = threshold
        rows: dict[tuple[int, int], list] = {}
        for name, text in templates.items():
            own = words_of(text).split()
            if not own:
                raise ValueError(f"template {name} has no words")
            n = min(shingle, len(own))
            h = np.unique(self.windows.hashes(self.hashes.of(own), n))
            # classes of a ratio of about 1.1; stretches are as long as the template with its repeats
            k = len(own) - n + 1
            rows.setdefault((n, k if k < 12 else round(math.log(k, 1.1)) + 1000), []).append((name, k, h))
        self.classes = [_Class(n, own, threshold, probability) for (n, _), own in sorted(rows.items(), key=lambda r: r[0])]
        most = max((c.bands for c in self.classes), default=0)
        self.odd = np.random.default_rng(4_242).integers(1, 2**31, most * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        for c in self.classes:
            c.index(self.odd)

    def _retrieved(self, n: int, h: np.ndarray, classes: list[_Class]) -> Iterator[tuple[_Class, int, int]]:
        """(class, template, window) of every agreement in a band, for shingles in the order of their positions."""
        x = h.astype(np.uint32)
        widths = sorted({c.step for c in classes})
        for b in range(max(c.bands for c in classes)):
            own = [c for c in classes if b < c.bands]
            # minima of steps of every width, the wider ones from the narrower
            lows: dict[int, list[np.ndarray]] = {w: [] for w in widths}
            for o in self.odd[b * ROWS : (b + 1) * ROWS]:
                low, width = _permuted(x, o), 1
                for w in range(widths[-1].bit_length()):
                    if width in lows:
                        lows[width].append(low)
                    if w + 1 < widths[-1].bit_length():
                        whole = len(low) // 2 * 2
                        low = np.concatenate([np.minimum(low[:whole:2], low[1:whole:2]), low[whole:]])
                        width *= 2
            for c in own:
                minima = []
                for low in lows[c.step]:
                    over, span = low, 1
                    while span < c.steps:  # windows of `steps` steps by doubling; the last ones are shorter
                        jump = min(span, c.steps - span)
                        over = np.concatenate([np.minimum(over[:-jump], over[jump:]), over[-jump:]]) if len(over) > jump else np.minimum.accumulate(over[::-1])[::-1]
                        span += jump
                    minima.append(over)
                key = _band(minima)
                for at in np.flatnonzero(c.flags[b][key & np.uint32(0xFFF)]).tolist():
                    for t in c.keys[b].get(int(key[at]), ()):
                        yield c, t, at

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, str, float, int]]:
        """(row, template, greatest containment of a stretch, first word of the first stretch that holds the template)."""
        for first, counts, w in word_chunks(texts, self.hashes):
            ends = np.cumsum(counts)
            row = np.repeat(np.arange(len(counts)), counts)
            for n in sorted({c.n for c in self.classes}):
                if len(w) < n:
                    continue
                h, own = self.windows.hashes(w, n), [c for c in self.classes if c.n == n]
                inside = row[: len(h)] == row[n - 1 :]
                # A shingle across two rows is none; a hash that no template has takes its place.
                h = np.where(inside, h, mixed(np.arange(len(h), dtype=np.uint64) + np.uint64(1 << 40)))
                found: dict[tuple[int, int], set[tuple[int, int]]] = {}
                if self.retrieve:
                    for c, t, at in self._retrieved(n, h, own):
                        lo = at * c.step
                        hi = min(lo + c.steps * c.step, len(h))
                        for r in range(row[lo], row[hi - 1] + 1):
                            found.setdefault((own.index(c), t), set()).add((int(r), lo))
                else:
                    found = {(i, t): {(r, -1) for r in range(len(counts)) if counts[r] >= n} for i, c in enumerate(own) for t in range(len(c.members))}
                best: dict[tuple[int, str], list] = {}
                for (i, t), where in found.items():
                    c = own[i]
                    name, k, shingles = c.members[t]
                    for r, lo in where:
                        begin = ends[r] - counts[r]
                        a, b = (max(lo, begin), min(lo + c.steps * c.step, ends[r] - n + 1)) if lo >= 0 else (begin, ends[r] - n + 1)
                        share, at = _held(h[a:b], shingles, k, share_of(len(shingles), self.threshold))
                        if at is not None:
                            got = best.setdefault((r, name), [share, a - begin + at])
                            got[0], got[1] = max(got[0], share), min(got[1], a - begin + at)
                for (r, name), (share, at) in best.items():
                    yield first + r, name, share, int(at)


def _held(h: np.ndarray, shingles: np.ndarray, k: int, ratio: Fraction) -> tuple[float, int | None]:
    """(greatest containment, first place that reaches the ratio) over stretches of k positions that begin with a shingle of the template."""
    at = np.searchsorted(shingles, h).clip(0, len(shingles) - 1)
    pos = np.flatnonzero(shingles[at] == h)
    if len(pos) * ratio.denominator < ratio.numerator * len(shingles):
        return 0.0, None
    which, best, place = at[pos], 0, None
    seen = np.zeros(len(shingles), np.int64)
    distinct, end = 0, 0
    for i, p in enumerate(pos.tolist()):
        while end < len(pos) and pos[end] < p + k:
            distinct += seen[which[end]] == 0
            seen[which[end]] += 1
            end += 1
        best = max(best, distinct)
        if place is None and distinct * ratio.denominator >= ratio.numerator * len(shingles):
            place = p
        seen[which[i]] -= 1
        distinct -= seen[which[i]] == 0
    return best / len(shingles), place


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs and template that it holds: doc_id, license, containment and first_word.

    containment is the greatest share of the template's shingles in one stretch of its length, first_word the place of the
    first stretch that holds enough of them (counted in words from 0). Null, empty and short texts hold nothing; every row
    is scanned by itself, whatever its id. A text may hold several templates, of one license too. Only the id and text
    columns are read.
    """
    templates = TEMPLATES if templates is None else templates

    def of(batches):
        scanner = Scanner(templates, threshold)
        for pdf in batches:
            rows = list(scanner.matches([words_of(t) for t in pdf["_text"]]))
            if rows:
                yield pd.DataFrame({"doc_id": pdf["_id"].iloc[[r for r, *_ in rows]].to_numpy(), "license": pd.Series([n for _, n, *_ in rows], dtype=object), "containment": [s for _, _, s, _ in rows], "first_word": [a for *_, a in rows]})

    src = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    return src.mapInPandas(tidy(of), f"doc_id {src.schema['_id'].dataType.simpleString()}, license string, containment double, first_word long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


_QUOTED = ", ".join("('{}', '{}')".format(n, words_of(t).decode().replace("'", "''")) for n, t in TEMPLATES.items())
ORACLE = rf"""
WITH given(license, text) AS (VALUES {_QUOTED}),
t AS (SELECT license, list_filter(string_split(text, ' '), lambda x: x <> '') AS l FROM given),
u AS (SELECT license, l, least(5, len(l)) AS n, len(l) - least(5, len(l)) + 1 AS k FROM t),
ts AS (SELECT DISTINCT license, n, k, array_to_string(l[i:i + n - 1], ' ') AS s FROM u, unnest(range(1, k + 1)) AS r(i)),
size AS (SELECT license, count(*) AS total FROM ts GROUP BY license),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS l FROM documents),
h AS (SELECT doc_id, ts.license, p::BIGINT AS p, ts.s, ts.k FROM d, unnest(range(1, len(l) + 1)) AS r(p), (SELECT DISTINCT n FROM ts) AS m, ts
  WHERE p + m.n - 1 <= len(l) AND ts.n = m.n AND ts.s = array_to_string(l[p:p + m.n - 1], ' ')),
c AS (SELECT a.doc_id, a.license, a.p, count(DISTINCT b.s) AS held FROM (SELECT DISTINCT doc_id, license, p FROM h) a JOIN h b ON a.doc_id = b.doc_id AND a.license = b.license AND b.p >= a.p AND b.p < a.p + b.k GROUP BY ALL)
SELECT doc_id, license, max(held) / max(total)::DOUBLE AS containment, min(p) - 1 AS first_word FROM c JOIN size USING (license) WHERE held * 10 >= total * CASE WHEN total < {WHOLE} THEN 10 ELSE 8 END GROUP BY ALL
"""
