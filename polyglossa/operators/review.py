"""Review queues over findings and OCR candidates; decisions are appended, the latest one counts."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ocr import clean_line, dehyphenate, lines, review_reasons
from ..functions.text import bound

FINAL = ("approved", "rejected")
#: Most terms of a glossary, which goes to every task.
TERMS = 200_000
#: Up to so many terms are looked for by column expressions, without Python.
FEW = 64
OCR_FINAL = ("approved", "manual_fix", "leave_as_is")


CANDIDATES_TASK = "Check these recognised lines. Reply with JSON {\"items\":[{\"id\",\"verdict\",\"suggested_russian\",\"reason_ru\"}]}.\n"
CONTEXT_HEADS = ("Findings like these were right:\n", "Findings like these were wrong, do not report such:\n")
#: Marks of footnotes, and the end of a text that ends a sentence: a closing sign, then closing quotes and brackets.
FOOTNOTE, SENTENCE_END = r"\[\d{1,3}\]", r"[.!?…][»”’\"')\]]*\s*$"


def latest_decisions(decisions: DataFrame, key: list[str], at: str = "at") -> DataFrame:
    """The last decision of each key. A max over (time, decision, comment) combines map-side and needs no ordering."""
    others = [c for c in decisions.columns if c not in {*key, at}]
    return decisions.groupBy(*key).agg(F.max(F.struct(at, *others)).alias("_d")).select(*key, f"_d.{at}", *(f"_d.{c}" for c in others))


def pending(findings: DataFrame, decisions: DataFrame, key: list[str], final: tuple[str, ...] = FINAL) -> DataFrame:
    """Findings without a final decision."""
    done = latest_decisions(decisions, key).where(F.col("decision").isin(*final)).select(*key)
    return findings.join(done, key, "left_anti")


def valid_ocr_decisions(decisions: DataFrame) -> DataFrame:
    """Decisions of the three kinds; a manual fix needs a replacement text."""
    return decisions.where(F.col("decision").isin(*OCR_FINAL) & ((F.col("decision") != "manual_fix") | (F.trim("replacement") != "")))


def findings_with_units(findings: DataFrame, units: DataFrame, key: list[str]) -> DataFrame:
    """Findings with the first unit of their number, or none."""
    others = [c for c in units.columns if c not in {*key, "unit", "seq"}]
    first = units.groupBy(*key, "unit").agg(F.min(F.struct("seq", *others)).alias("_u"))
    return findings.join(first, [*key, "unit"], "left").select(*findings.columns, *(F.col(f"_u.{c}").alias(c) for c in others))


def ocr_candidates(drafts: DataFrame, line_map: DataFrame | None = None) -> DataFrame:
    """Lines that need a look: chapter, id, line, raw, cleaned, reasons, and the page line of the optional map."""
    # a line is cleaned and judged inside the array: the filter on columns of a later select would repeat both
    judged = lambda raw: bound(clean_line(raw), lambda c: F.struct(raw.alias("raw"), c.alias("cleaned"), review_reasons(c).alias("reasons")))
    rows = drafts.select("chapter", F.posexplode(F.transform(lines(F.col("body")), judged)).alias("line", "_line")).where(F.size("_line.reasons") > 0)
    rows = rows.select("chapter", (F.col("line") + 1).alias("line"), "_line.raw", "_line.cleaned", "_line.reasons")
    rows = rows.withColumn("id", F.row_number().over(Window.partitionBy("chapter").orderBy("line")))
    if line_map is None:
        return rows
    return rows.join(line_map.select("chapter", F.col("draft_line").alias("line"), "ocr_page", "ocr_page_line"), ["chapter", "line"], "left")


def cleaned_drafts(drafts: DataFrame) -> DataFrame:
    """Drafts with the text made ready for review and the number of lines that have text."""
    each = F.filter(F.transform(lines(F.col("body")), clean_line), lambda x: x != "")
    return drafts.withColumn("lines", F.size(each)).withColumn("body", F.concat(F.trim(dehyphenate(F.array_join(each, "\n"))), F.lit("\n")))


def candidate_requests(candidates: DataFrame, size: int = 7, english: DataFrame | None = None) -> DataFrame:
    """(chapter, batch, prompt): `size` candidates a request, by their ids.

    With english (chapter, english) the chapter's English text follows as context, once a request.
    """
    row = F.concat(F.col("id").cast("string"), F.lit(": "), F.col("cleaned"), F.lit(" ["), F.array_join("reasons", ","), F.lit("]"))
    at = candidates.withColumn("batch", F.floor((F.col("id") - 1) / size).cast("int")).withColumn("row", row)
    asked = at.groupBy("chapter", "batch").agg(F.concat(F.lit(CANDIDATES_TASK), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "row"))), lambda s: s["row"]), "\n")).alias("prompt"))
    if english is None:
        return asked
    both = asked.join(english.select("chapter", "english"), "chapter", "left")
    return both.select("chapter", "batch", F.concat("prompt", F.coalesce(F.concat(F.lit("\n\nEnglish chapter, for the meaning only:\n"), "english"), F.lit(""))).alias("prompt"))


def candidate_errors(replies: DataFrame) -> DataFrame:
    """(chapter, batch, error) of the requests whose reply has no list of items; what went wrong last, where there is no reply."""
    listed = F.try_variant_get(F.try_parse_json("reply"), "$.items", "array<variant>").isNotNull()
    why = F.when(F.col("reply").isNull(), F.coalesce(F.try_element_at("failures", F.lit(-1)), F.lit("no reply"))).otherwise("the reply has no list of items")
    return replies.where(F.col("reply").isNull() | ~F.coalesce(listed, F.lit(False))).select("chapter", "batch", why.alias("error"))


def candidate_reviews(candidates: DataFrame, replies: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Review items beside their candidates, with the latest decision; candidates without an item stay."""
    items = replies.select("chapter", F.explode(F.from_json("reply", "struct<items:array<struct<id:int,verdict:string,suggested_russian:string,reason_ru:string>>>")["items"]).alias("i")).select("chapter", "i.*")
    out = candidates.join(items, ["chapter", "id"], "left")
    return out if decisions is None else out.join(latest_decisions(decisions, ["chapter", "id"]), ["chapter", "id"], "left")


def pages_with_photos(pages: DataFrame, photos: DataFrame) -> DataFrame:
    """Pages with the first photo (by path) of the same stem, if any."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return pages.join(photos.select(stem.alias("stem"), "path").groupBy("stem").agg(F.min("path").alias("photo")), "stem", "left")


#: The automaton of the glossary that a worker used last.
_LAST: dict = {}


def _machine(name: str, terms: list[dict]):
    """An automaton of the terms, built once a worker and glossary."""
    if name not in _LAST:
        import ahocorasick

        machine = ahocorasick.Automaton()
        by: dict[str, list[int]] = {}
        for i, t in enumerate(terms):
            by.setdefault(t["en"], []).append(i)
        for term, which in by.items():
            machine.add_word(term, which)
        machine.make_automaton()
        _LAST.clear()
        _LAST[name] = machine
    return _LAST[name]


def glossary_violations(units: DataFrame, glossary: DataFrame) -> DataFrame:
    """Units whose source has a glossary term and whose Russian text lacks its translation, with the glossary's columns.

    Terms may stand anywhere in a text, inside words too. A few terms are looked for one by one, so that no text leaves
    the JVM; an automaton of many finds them in one pass over a text. A glossary of more than TERMS rows is an error.
    """
    terms = glossary.where(F.col("en") != "").dropDuplicates().limit(TERMS + 1).collect()
    if len(terms) > TERMS:
        raise ValueError(f"a glossary has at most {TERMS} terms")
    own, added = units.columns, [f for f in glossary.schema.fields]
    if 0 < len(terms) <= FEW:
        lacks = lambda t: F.contains("en_text", F.lit(t["en"])) & ~F.contains("ru_text", F.lit(t["ru"]).cast("string"))
        found = (F.when(lacks(t), F.struct(*(F.lit(t[f.name]).cast(f.dataType).alias(f.name) for f in added))) for t in terms)
        return units.select(*own, F.inline(F.array_compact(F.array(*found))))
    told = units.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, [t.asDict() for t in terms]))

    def of(batches):
        name, terms = told.value
        machine = _machine(name, terms)
        for pdf in batches:
            hits = []
            for k, (source, russian) in enumerate(zip(pdf["en_text"], pdf["ru_text"], strict=True)):
                if terms and source is not None and russian is not None:
                    found = {i for _, which in machine.iter(source) for i in which}
                    hits += [(k, i) for i in sorted(found) if terms[i]["ru"] is not None and terms[i]["ru"] not in russian]
            # a text stands once for each hit, so that hits leave some at a time
            for at in range(0, len(hits), 256):
                some = hits[at : at + 256]
                out = pdf[own].iloc[[k for k, _ in some]].reset_index(drop=True)
                yield out.assign(**{f.name: pd.Series([terms[i][f.name] for _, i in some], dtype=object) for f in added})

    fields = [*units.schema.fields, *added]
    return units.mapInPandas(of, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))


def duplicate_terms(glossary: DataFrame) -> DataFrame:
    """Chinese terms with more than one Russian form."""
    return glossary.groupBy("zh").agg(F.array_sort(F.collect_set("ru")).alias("forms")).where(F.size("forms") > 1)


def few_shot(decisions: DataFrame, findings: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """The latest n decided findings of each type and decision, as examples for further prompts."""
    both = latest_decisions(decisions, key).where(F.col("decision").isin(*FINAL)).join(findings, key)
    w = Window.partitionBy("type", "decision").orderBy(F.desc("at"), *key)
    return both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def decision_context(decisions: DataFrame, findings: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """(context): one text for the next audit's prompts, from the latest n findings of each type that were approved and rejected.

    Approved ones are examples of what to report, rejected ones of what not to; deferred ones are left out. The text has
    2 * n lines a type, whatever the number of decisions.
    """
    chosen = few_shot(decisions, findings, key, n)
    line = F.concat(F.lit("- "), F.col("type"), F.lit(": "), F.coalesce("reason", F.lit("")))
    rows = chosen.groupBy("decision").agg(F.array_sort(F.collect_list(F.struct("type", "rank", line.alias("line")))).alias("rows"))
    told = F.when(F.col("decision") == "approved", CONTEXT_HEADS[0]).otherwise(CONTEXT_HEADS[1])
    parts = rows.select("decision", F.concat(told, F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("part"))
    return parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("decision", "part"))), lambda s: s["part"]), "\n\n").alias("context"))


def with_context(requests: DataFrame, context: DataFrame) -> DataFrame:
    """requests whose prompt begins with the context, one row that every request gets."""
    one = context.select(F.coalesce(F.max("context"), F.lit("")).alias("_context"))
    return requests.crossJoin(F.broadcast(one)).withColumn("prompt", F.concat(F.when(F.col("_context") != "", F.concat("_context", F.lit("\n\n"))).otherwise(""), "prompt")).drop("_context")


def admission(chapters: DataFrame, glossary: DataFrame) -> DataFrame:
    """(chapter, reasons, terms, admitted) of chapters (chapter, en_text, ru_text): whether a translation may enter the corpus.

    Reasons: no_chapter, no_source, empty, footnotes (marks such as [1]), truncated (the last line does not end a
    sentence or a quotation), quotes (guillemets that do not match), names (glossary terms of the source without their
    translation, listed in terms). A chapter without reasons is admitted.
    """
    own = chapters.select("chapter", "en_text", "ru_text")
    russian = F.coalesce(F.col("ru_text"), F.lit(""))
    blank = F.trim(F.regexp_replace(russian, r"\s+", " ")) == ""
    count = lambda c: F.length(russian) - F.length(F.replace(russian, F.lit(c)))
    faults = {
        "no_chapter": F.col("chapter").isNull(),
        "no_source": F.coalesce(F.trim("en_text"), F.lit("")) == "",
        "empty": blank,
        "footnotes": russian.rlike(FOOTNOTE),
        "truncated": ~blank & ~russian.rlike(SENTENCE_END),
        "quotes": count("«") != count("»"),
    }
    plain = own.select("chapter", F.array_compact(F.array(*(F.when(bad, name) for name, bad in faults.items()))).alias("reasons"))
    missing = glossary_violations(own.select("chapter", "en_text", "ru_text"), glossary).where("chapter IS NOT NULL").groupBy("chapter").agg(F.array_sort(F.collect_set("en")).alias("terms"))
    out = plain.join(missing, "chapter", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    out = out.withColumn("reasons", F.when(F.size("terms") > 0, F.array_append("reasons", "names")).otherwise(F.col("reasons")))
    return out.withColumn("admitted", F.size("reasons") == 0)
