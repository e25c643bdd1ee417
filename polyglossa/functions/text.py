"""Text rules as column expressions: cleaning, paragraphs, rendering, names and languages. No Python runs on rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the cleaning rules must recognise.
FOOTNOTE = r"(?U)\s*\[\d{1,3}\]"
NON_STORY = r"(?iu)^(?:read comments|discord|ps(?U:\s)*[:：])"
EDITOR_NOTE = r"(?iuU)(?:прим\.\s*ред\.|примечани[ея]\s+переводчика|translator'?s\s+note)"
EMPTY_DIALOGUE = ("…", "...", "«…»", '"…"', '"..."')
LINE_BREAK = "\\r\\n|[\\n\\x0B\\f\\r\\x1C-\\x1E\\x85\\u2028\\u2029]"
#: White space as Python's strip() sees it.
WS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
CYRILLIC = "А-Яа-яЁё"


def trim_ws(c: Column) -> Column:
    """Strips all Unicode white space, not blanks alone."""
    return F.btrim(c, F.lit(WS))


def bound(c: Column, of: Callable[[Column], Column]) -> Column:
    """of(c), with c worked out once for all its uses, which would repeat the expression that makes it."""
    return F.get(F.transform(F.array(c), of), 0)


def _parts(c: Column, pattern: str) -> Column:
    return F.split(c, pattern, -1)


def joined(parts: Column, by: str) -> Column:
    return F.array_join(parts, by)


def clean_story(text: Column, separator: str = r"(?U)\n\s*\n", between: str = "\n\n", dropped: Sequence[str] = ()) -> Column:
    """Story text without footnote marks, empty dialogue, reader notes and blocks that match `dropped` patterns.

    Blocks are what `separator` parts; their lines are trimmed and blank ones go. A final newline stands if any block does.
    """

    def block(b: Column) -> Column:
        lines = F.filter(F.transform(_parts(b, LINE_BREAK), trim_ws), lambda x: x != "")
        return trim_ws(joined(lines, "\n"))

    def keep(b: Column) -> Column:
        bad = b.isin(*EMPTY_DIALOGUE) | b.rlike(NON_STORY) | b.rlike(EDITOR_NOTE)
        for pattern in dropped:
            bad = bad | b.rlike(pattern)
        return (b != "") & ~bad

    blocks = F.filter(F.transform(_parts(F.regexp_replace(text, FOOTNOTE, ""), separator), block), keep)
    return bound(blocks, lambda bs: F.concat(joined(bs, between), F.when(F.size(bs) > 0, "\n").otherwise("")))


def paragraphs(text: Column, separator: str = "\n\n") -> Column:
    """Trimmed paragraphs; blank ones and blocks that begin with a heading mark before trimming are left out."""
    quoted = "\\Q" + separator + "\\E"
    kept = F.filter(_parts(text, quoted), lambda p: (trim_ws(p) != "") & ~p.startswith("# "))
    return F.transform(kept, trim_ws)


def first_paragraphs(text: Column, n: int, separator: str = "\n\n") -> Column:
    """The first n cleaned paragraphs, less a heading line at the start."""
    cleaned = clean_story(text) if separator == "\n\n" else clean_story(text, "\\Q" + separator + "\\E", separator)
    body = F.when(cleaned.startswith("# "), F.regexp_replace(cleaned, r"\A[^\n]*\n?", "")).otherwise(cleaned)
    found = F.filter(F.transform(_parts(body, "\\Q" + separator + "\\E"), trim_ws), lambda p: p != "")
    return joined(F.slice(found, 1, n), separator)


def numbered(items: Column, start: Column | int = 1) -> Column:
    """Lines "i: text" that count from start."""
    first = F.lit(start) if isinstance(start, int) else start
    return joined(F.transform(items, lambda x, i: F.concat((i + first).cast("string"), F.lit(": "), x)), "\n")


def window_size(counts: Column, longest: Column) -> Column:
    """5 paragraphs a request where a side has 80 or more or one of 1200 characters, else 8."""
    return F.when((counts >= 80) | (longest >= 1200), 5).otherwise(8)


def texts_by_number(items: Column, numbers: Column, by: str = "\n\n") -> Column:
    """The paragraphs with these 1-based numbers, in the order given; numbers out of range are passed over."""
    valid = F.filter(F.coalesce(numbers, F.array().cast("array<int>")), lambda n: (n >= 1) & (n <= F.size(items)))
    return joined(F.transform(valid, lambda n: F.element_at(items, n.cast("int"))), by)


def detect_language(text: Column) -> Column:
    """zh if any Han character, else ru if any of the 32 plain Cyrillic letters, else en."""
    return F.when(text.rlike("[\u4e00-\u9fff]"), "zh").when(text.rlike("[А-Яа-я]"), "ru").otherwise("en")


def safe_filename(title: Column) -> Column:
    replaced = F.regexp_replace(title, r'[<>:"/\\|?*\x00-\x1F]', "_")
    name = F.substring(F.regexp_replace(replaced, "^[ .]+|[ .]+$", ""), 1, 100)
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("untitled"))


def normalized_href(base: Column, href: Column) -> Column:
    """href without fragment, below the folder of base; dots and escapes stay."""
    return F.concat(F.regexp_replace(base, "[^/]*$", ""), F.substring_index(href, "#", 1))


def chapter_number(first_line: Column, stem: Column) -> Column:
    """The number of an English chapter heading, else the first number of the file's stem, else null."""
    heading = F.nullif(F.regexp_extract(first_line, r"(?iuU)^#\s*Chapter\s+(\d+)\s*:", 1), F.lit(""))
    name = F.nullif(F.regexp_extract(stem, r"(?i)(?:ch_)?0*(\d+)", 1), F.lit(""))
    return F.coalesce(heading, name).cast("int")


def drop_leading_lines(text: Column, title: Column, name: Column) -> Column:
    """The text from the first line that is neither blank nor the title nor the name."""
    lines = _parts(text, "\n")
    skipped = F.transform(lines, lambda x: (trim_ws(x) == "") | (trim_ws(x) == title) | (trim_ws(x) == name))
    first = F.array_position(skipped, False).cast("int")
    return F.when(first > 0, joined(F.slice(lines, first, F.size(lines)), "\n")).otherwise("")


def glossary_lines(entries: Column) -> Column:
    """Lines "zh | en | ru" of an array of structs, in its order."""
    return joined(F.transform(entries, lambda e: F.concat_ws(" | ", e["zh"], e["en"], e["ru"])), "\n")
