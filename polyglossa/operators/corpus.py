"""Paragraph, chapter and window tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import chapter_number, paragraphs, window_size
from ..shared import staged


def explode_paragraphs(docs: DataFrame, text: str = "text", separator: str = "\n\n") -> DataFrame:
    """One row per paragraph: the columns of docs but the text, p (from 1) and paragraph."""
    keep = [c for c in docs.columns if c != text]
    return docs.select(*keep, F.posexplode(paragraphs(F.col(text), separator)).alias("p", "paragraph")).withColumn("p", F.col("p") + 1)


def numbered_chapters(files: DataFrame) -> DataFrame:
    """(source, chapter, file) of files (source, file, body) that bear a number; of equal numbers the greatest name stays."""
    first = F.regexp_extract("body", r"\A([^\r\n]*)", 1)
    stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[^.]*$", "")
    found = files.select("source", "file", chapter_number(first, stem).alias("chapter")).where("chapter IS NOT NULL")
    return found.groupBy("source", "chapter").agg(F.max("file").alias("file"))


def match_chapters(zh: DataFrame, en: DataFrame, ru: DataFrame) -> DataFrame:
    """Chapters that all three sources have: chapter, status, sources, training_weight and notes."""
    side = lambda df, name: df.select("chapter", F.col("file").alias(name))
    both = side(zh, "zh").join(side(en, "en"), "chapter").join(side(ru, "ru"), "chapter")
    return both.select(
        "chapter",
        F.lit("needs_review").alias("status"),
        F.create_map(*(x for n in ("zh", "en", "ru") for x in (F.lit(n), F.col(n)))).alias("sources"),
        F.create_map(F.lit("zh"), F.lit(1.0), F.lit("en"), F.lit(1.0), F.lit("ru"), F.lit(0.35)).alias("training_weight"),
        F.lit("matched by chapter number; paragraphs are not aligned").alias("notes"),
    )


def match_by_rank(sides: list[DataFrame], names: list[str], group: list[str], order: list[str], limit: int | None = None) -> DataFrame:
    """The i-th row of every side beside each other, within `group`; what a shorter side lacks is left out.

    Each side is (group..., order..., value). The ranks run within a group, so no task orders a whole table.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    out = None
    for df, name in zip(sides, names, strict=True):
        own = df.withColumn("rank", F.row_number().over(w)).select(*group, "rank", F.col("value").alias(name))
        own = own.where(F.col("rank") <= limit) if limit is not None else own
        out = own if out is None else out.join(own, [*group, "rank"])
    return out


def windows(rows: DataFrame, group: list[str], position: str, size: Column | int) -> DataFrame:
    """rows with window (from 0) and offset (first position of the window): fixed runs of `size` positions."""
    n = F.lit(size) if isinstance(size, int) else size
    w = F.floor((F.col(position) - 1) / n).cast("int")
    return rows.withColumn("window", w).withColumn("offset", (w * n + 1).cast("int"))


def request_window_size(paragraph_rows: DataFrame, group: list[str], side: list[str]) -> DataFrame:
    """(group, window_size) from the largest paragraph count of a side and the longest paragraph."""
    per = paragraph_rows.groupBy(*group, *side).agg(F.count("*").alias("n"), F.max(F.length("paragraph")).alias("longest"))
    return per.groupBy(*group).agg(F.max("n").alias("n"), F.max("longest").alias("longest")).select(*group, window_size(F.col("n"), F.col("longest")).alias("window_size"))


def ordered_join(rows: DataFrame, group: list[str], position: str, text: str, by: str = "\n") -> DataFrame:
    """(group, text): texts of a group in the order of their position, joined."""
    return rows.groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, text))), lambda s: s[text]), by).alias(text))


def lookup_texts(numbers: DataFrame, paragraph_rows: DataFrame, key: list[str], array: str, by: str = "\n\n") -> DataFrame:
    """numbers with <array>_text: its paragraphs in the order given; numbers without a paragraph add nothing."""
    at = numbers.withColumn("_row", F.monotonically_increasing_id()) if "_row" not in numbers.columns else numbers
    found = at.select("_row", *key, F.posexplode(array).alias("_i", "p")).join(paragraph_rows.select(*key, "p", "paragraph"), [*key, "p"])
    text = found.groupBy("_row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "paragraph"))), lambda s: s["paragraph"]), by).alias(f"{array}_text"))
    return at.join(text, "_row", "left").withColumn(f"{array}_text", F.coalesce(f"{array}_text", F.lit(""))).drop("_row")


def page_range(pages: DataFrame, first: str, last: str, stem: str = "stem") -> DataFrame:
    """Pages from first to last; an error at run time if either is missing."""
    chosen = pages.where(F.col(stem).between(first, last))
    ends = chosen.agg(F.min(stem).alias("lo"), F.max(stem).alias("hi"))
    ok = ends.select(F.when((F.col("lo") == first) & (F.col("hi") == last), True).otherwise(F.raise_error(F.lit(f"the pages {first}..{last} are not complete")).cast("boolean")).alias("_complete"))
    return chosen.join(F.broadcast(ok), F.col("_complete")).drop("_complete")


def running_totals(rows: DataFrame, group: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """rows with the sums of values over the rows before each, within `group` and in `order`, which tells rows apart.

    No task holds a group: rows are dealt by ranges of their order, each range adds up its own, and the sums of whole
    ranges, one row a group and range, are added up apart. The dealt rows are written once, so that ranges stay as they are.
    """
    keys, own = [*group, *order], {name: f"_own_{name}" for name in values}
    dealt = rows.withColumns({own[n]: v.cast("long") for n, v in values.items()}).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    dealt = staged(dealt)
    before = lambda partition, by: Window.partitionBy(*partition).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*group, "_range").agg(*(F.sum(c).alias(c) for c in own.values()))
    sums = sums.select(*group, "_range", *(F.coalesce(F.sum(c).over(before(group, ["_range"])), F.lit(0)).alias(f"{c}_before") for c in own.values()))
    near = dealt.withColumns({n: F.coalesce(F.sum(c).over(before(["_range", *group], order)), F.lit(0)) for n, c in own.items()})
    match = F.lit(True)
    for c in (*group, "_range"):
        match = match & near[c].eqNullSafe(sums[c])
    out = near.join(sums, match, "left").select(*(near[c] for c in near.columns if c not in (*values, "_range")), *((near[n] + sums[f"{own[n]}_before"]).alias(n) for n in values))
    return out.drop(*own.values())


def draft_lines(page_lines: DataFrame, chapter: str = "chapter", page: str = "page", line: str = "line") -> DataFrame:
    """page_lines with draft_line: line numbers of the assembled chapter (title, blank, pages parted by a blank line).

    Lines are numbered within their page; what stands before a page comes from the running totals of pages, so the
    lines of a chapter never meet in one task.
    """
    pages = page_lines.groupBy(chapter, page).agg(F.count("*").alias("_n"))
    pages = running_totals(pages, [chapter], [page], {"_lines": F.col("_n"), "_pages": F.lit(1)})
    told = pages.select(F.col(chapter).alias("_chapter"), F.col(page).alias("_page"), (F.col("_lines") + F.col("_pages") + 2).alias("_before"))
    at = page_lines.withColumn("_k", F.row_number().over(Window.partitionBy(chapter, page).orderBy(line)))
    out = at.join(told, at[chapter].eqNullSafe(told["_chapter"]) & at[page].eqNullSafe(told["_page"]))
    return out.withColumn("draft_line", (F.col("_before") + F.col("_k")).cast("int")).drop("_chapter", "_page", "_before", "_k")


def running_header(line: Column, terms: list[str], letters: str = "А-Яа-яЁё") -> Column:
    """Whether the line's letters, lower-cased and put together, hold one of the terms."""
    bare = F.lower(F.regexp_replace(line, f"[^{letters}]", ""))
    out = F.lit(False)
    for t in terms:
        out = out | bare.contains(t)
    return out


def assemble_chapter(pages: DataFrame, first: str, last: str, title: str, header_terms: list[str], first_page_terms: list[str]) -> DataFrame:
    """Lines (draft_line, ocr_page, ocr_page_line, text) of a chapter from recognised pages (page, stem, body)."""
    chosen = page_range(pages, first, last)
    body = chosen.select("page", "stem", F.posexplode(F.split("body", r"\R", -1)).alias("i", "text"))
    bad = running_header(F.col("text"), header_terms) | ((F.col("stem") == first) & running_header(F.col("text"), first_page_terms))
    kept = body.where(~bad)
    # Blank lines at a page's ends are not written.
    whole = Window.partitionBy("page")
    solid = F.when(F.trim("text") != "", F.col("i"))
    kept = kept.withColumns({"lo": F.min(solid).over(whole), "hi": F.max(solid).over(whole)}).where("i BETWEEN lo AND hi").withColumn("chapter", F.lit(title))
    kept = kept.withColumn("line", F.row_number().over(Window.partitionBy("page").orderBy("i")))
    return draft_lines(kept).select("draft_line", F.col("page").alias("ocr_page"), F.col("line").alias("ocr_page_line"), "text")
