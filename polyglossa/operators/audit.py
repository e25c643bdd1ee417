"""Audits: fixed windows of units or paragraphs become requests, replies become findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .corpus import windows

WINDOW = 5
SIDES = ("zh", "en", "ru")
UNITS_TASK = 'Audit the Russian translation of these fixed units. Reply with JSON {"findings":[{"unit","type","severity","reason"}]}.\n\n'
PARAGRAPHS_TASK = 'Audit the Russian translation. Reply with JSON {"findings":[{"zh","en","ru","type","severity","reason"}]}.\n\n'


def unit_texts(units: DataFrame, paragraph_rows: DataFrame) -> DataFrame:
    """units (chapter, unit, zh, en, ru) with the text of each side: one equi-join looks up the numbers of all sides."""
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("lang"), F.col(s).cast("array<bigint>").alias("numbers")) for s in SIDES)))
    numbers = units.select("chapter", "unit", sides.alias("s")).select("chapter", "unit", "s.lang", F.posexplode("s.numbers").alias("i", "p"))
    found = numbers.join(paragraph_rows.select("chapter", "lang", "p", "paragraph"), ["chapter", "lang", "p"])

    def text(side: str):
        own = F.array_sort(F.collect_list(F.when(F.col("lang") == side, F.struct("i", "paragraph"))))
        return F.array_join(F.transform(own, lambda s: s["paragraph"]), "\n\n").alias(f"{side}_text")

    out = units.join(found.groupBy("chapter", "unit").agg(*map(text, SIDES)), ["chapter", "unit"], "left")
    return out.withColumns({f"{s}_text": F.coalesce(f"{s}_text", F.lit("")) for s in SIDES})


def unit_requests(texts: DataFrame, size: int = WINDOW) -> DataFrame:
    """(chapter, window, units, prompt): `size` units a request, in their order."""
    numbers = lambda c: F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]"))
    block = F.concat(F.lit("UNIT "), F.col("unit"), F.lit(" (zh "), numbers("zh"), F.lit("; en "), numbers("en"), F.lit("; ru "), numbers("ru"), F.lit(")\nZH: "), F.col("zh_text"), F.lit("\nEN: "), F.col("en_text"), F.lit("\nRU: "), F.col("ru_text"))
    at = windows(texts, ["chapter"], "unit", size).withColumn("block", block)
    ordered = F.array_sort(F.collect_list(F.struct("unit", "block")))
    return at.groupBy("chapter", "window").agg(F.count("*").alias("units"), F.concat(F.lit(UNITS_TASK), F.array_join(F.transform(ordered, lambda s: s["block"]), "\n\n")).alias("prompt"))


def paragraph_requests(paragraph_rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """(chapter, window, offset, prompt): windows of the longest side; a side that has ended gives no lines."""
    at = windows(paragraph_rows, ["chapter"], "p", size).withColumn("line", F.concat(F.col("p").cast("string"), F.lit(": "), F.col("paragraph")))

    def side(name: str):
        own = F.array_sort(F.collect_list(F.when(F.col("lang") == name, F.struct("p", "line"))))
        return F.array_join(F.transform(own, lambda s: s["line"]), "\n")

    prompt = F.concat(F.lit(PARAGRAPHS_TASK), F.lit("Chinese:\n"), side("zh"), F.lit("\n\nEnglish:\n"), side("en"), F.lit("\n\nRussian:\n"), side("ru"))
    return at.groupBy("chapter", "window", "offset").agg(prompt.alias("prompt"))


def route(early: DataFrame, late: DataFrame, last_early: int = 5) -> DataFrame:
    """Alignments of chapters up to last_early from one source, of later ones from another."""
    return early.where(F.col("chapter") <= last_early).unionByName(late.where(F.col("chapter") > last_early))


def missing_chapters(wanted: DataFrame, present: DataFrame) -> DataFrame:
    return wanted.join(present.select("chapter").distinct(), "chapter", "left_anti")


def flatten_window_units(llm_windows: DataFrame) -> DataFrame:
    """Units of window alignments: (chapter, window, unit, zh, en, ru), units from 1 in each window, numbers made global."""
    rows = llm_windows.select("chapter", "window", "offset", F.posexplode("alignment").alias("i", "a"))
    shifted = lambda c: F.transform(F.col(f"a.{c}"), lambda n: (n + F.col("offset") - 1).cast("int")).alias(c)
    return rows.select("chapter", "window", (F.col("i") + 1).alias("unit"), shifted("zh"), shifted("en"), shifted("ru"))
