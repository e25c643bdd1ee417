"""Rules for recognised text as column expressions: page and line cleaning, look-alike repair, review reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import CYRILLIC, LINE_BREAK, WS, bound, trim_ws

# The 23 Latin letters that look Cyrillic, and the letters that they stand for.
LATIN_ALIKE = "ABCEHKMOPTXYacehkmoptxy"
CYRILLIC_ALIKE = "АВСЕНКМОРТХУасенкмортху"
#: What the page border leaves at a line's edge.
DEBRIS = " \t|`~#_"
#: Names of the review reasons, in their order.
REASONS = ("latin_letters_remain", "ocr_symbols_remain", "missing_space_after_sentence", "hyphenated_word_requires_photo_check")


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{letters}]+", ""))


def _one_blank(text: Column) -> Column:
    """Runs of blanks and tabs as one blank; single blanks are not touched."""
    return F.regexp_replace(text, "(?: [ \\t]|\\t)[ \\t]*", " ")


def dehyphenate(text: Column, letters: str = CYRILLIC) -> Column:
    """Joins words that a line break split; other hyphens stay."""
    # the hyphen first, so that what stands before it is looked at only there
    return F.regexp_replace(text, f"-(?<=[{letters}]-)[ \\t]*\\n[ \\t]*(?=[{letters}])", "")


def keep_line(line: Column, letters: str = CYRILLIC, all_letters: str = "A-Za-zА-Яа-яЁё") -> Column:
    """Whether a line (edges stripped) has enough letters of the book's alphabet to be prose."""

    def judged(n: Column) -> Column:
        own, every = n["own"], n["every"]
        decoration = (own < 3) & ((line == "") | ~line.rlike(f"[{letters}]{{2}}"))
        foreign = (every > 0) & (own / F.when(every > 0, every) < 0.35)
        return ~decoration & ~F.coalesce(foreign, F.lit(False))

    return bound(F.struct(_count(line, letters).alias("own"), _count(line, all_letters).alias("every")), judged)


def clean_page(text: Column, letters: str = CYRILLIC, all_letters: str = "A-Za-zА-Яа-яЁё") -> Column:
    """A recognised page with its prose lines alone; blank lines do not survive."""
    plain = F.replace(F.replace(text, F.lit("\ufeff"), F.lit("")), F.lit("\r\n"), F.lit("\n"))
    lines = F.transform(F.split(plain, "\n", -1), lambda x: F.btrim(x, F.lit(DEBRIS)))
    body = F.array_join(F.filter(lines, lambda x: keep_line(x, letters, all_letters)), "\n")
    body = _one_blank(dehyphenate(body, letters))
    body = F.regexp_replace(F.regexp_replace(body, " +\\n *|\\n +", "\n"), "\\n{3,}", "\n\n")
    return F.concat(trim_ws(body), F.lit("\n"))


def repair_lookalikes(line: Column) -> Column:
    """Words written wholly in Latin look-alikes become Cyrillic; all others stay as they are."""
    letter = "[A-Za-zА-Яа-яЁё]"

    def repaired(x: Column) -> Column:
        runs = F.regexp_extract_all(x, F.lit("([A-Za-zА-Яа-яЁё]+|[^A-Za-zА-Яа-яЁё]+)"), F.lit(1))
        words = F.array_join(F.transform(runs, lambda v: F.when(v.rlike(f"^[{LATIN_ALIKE}]+$"), F.translate(v, LATIN_ALIKE, CYRILLIC_ALIKE)).otherwise(v)), "")
        # lines without such a word are not taken apart
        return F.when(x.rlike(f"[{LATIN_ALIKE}](?<!{letter}.)[{LATIN_ALIKE}]*+(?!{letter})"), words).otherwise(x)

    return bound(line, repaired)


def clean_line(raw: Column) -> Column:
    """A line made ready for review."""
    line = F.translate(F.translate(raw, "|©", ""), "®", " ")
    line = F.regexp_replace(line, f"['`\u2018\u2019](?<=[{CYRILLIC}].)(?=[{CYRILLIC}])", " ")
    line = trim_ws(_one_blank(repair_lookalikes(line)))
    return F.btrim(line, F.lit("".join(c for c in WS if c not in "\x1c\x1d\x1e\x1f") + DEBRIS))


def review_reasons(line: Column, letters: str = CYRILLIC, capitals: str = "А-ЯЁ", foreign: str = "A-Za-z") -> Column:
    """Why a cleaned line should be compared with the photograph, in a fixed order; empty if it need not."""
    tests = (f"[{foreign}]", r"[#$%^&*_+=<>|]", f"[.!?…][{capitals}]")
    hyphenated = line.contains("-") & line.rlike(f"(?U)\\b[{letters}]+-[{letters}]+\\b")
    return F.array_compact(F.array(*(F.when(bad, F.lit(name)) for bad, name in zip((*map(line.rlike, tests), hyphenated), REASONS, strict=True))))


def lines(text: Column) -> Column:
    """Lines as Python's splitlines() has them: no empty one after a final break."""
    return bound(F.split(text, LINE_BREAK, -1), lambda found: F.when(F.element_at(found, -1) == "", F.slice(found, 1, F.size(found) - 1)).otherwise(found))
