"""Requests to a language model: windows become prompts, replies are kept by key, checked and flattened.

A responder is any function list[str] -> list[str]. replies.py stores replies, so that nothing is asked again that is stored.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_story, first_paragraphs
from .corpus import request_window_size, windows

Responder = Callable[[list[str]], list[str]]
ATTEMPTS, SLOW_SECONDS = 3, 120.0


def http_responder(model: str, url: str = "http://127.0.0.1:11434/api/chat", temperature: float = 0.0, context: int = 4096, timeout: int = 120, json_mode: bool = False, max_predict: int = 1024) -> Responder:
    """Asks a local chat service, one message a request."""

    def ask(prompts: list[str]) -> list[str]:
        from urllib.request import Request, urlopen

        out = []
        for prompt in prompts:
            body = {"model": model, "stream": False, "think": False, "messages": [{"role": "user", "content": prompt}], "options": {"temperature": temperature, "num_ctx": context, "num_predict": max_predict}}
            if json_mode:
                body["format"] = "json"
            with urlopen(Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"}), timeout=timeout) as r:
                out.append(json.load(r)["message"]["content"])
        return out

    return ask


def service_health(url: str = "http://127.0.0.1:11434/api/tags") -> dict:
    """The models of a local chat service, or the error that it gives."""
    from urllib.request import urlopen

    try:
        with urlopen(url, timeout=5) as r:
            return {"models": [m.get("name") for m in json.load(r).get("models", [])]}
    except (OSError, ValueError) as error:
        return {"error": str(error)}


class Asked(NamedTuple):
    """What came of a request: a reply or none, why each attempt failed, and the time of the last one."""

    reply: str | None
    failures: list[str]
    duration_s: float
    slow: bool


def asker(responder: Responder, accept: Callable[[str], bool] | None = None, attempts: int = ATTEMPTS, slow: float = SLOW_SECONDS, health: Callable[[], dict] | None = None) -> Callable[..., Asked]:
    """A function that asks one prompt up to `attempts` times; a check of the reply may be given with the prompt."""

    def ask(prompt: str, check: Callable[[str], bool] | None = None) -> Asked:
        failures, reply, took = [], None, 0.0
        while reply is None and len(failures) < attempts:
            began = time.monotonic()
            try:
                got = responder([prompt])[0]
                if not all(fine(got) for fine in (accept, check) if fine is not None):
                    raise ValueError("the reply does not pass the check")
                reply = got
            except Exception as error:  # noqa: BLE001  any failure of the service is recorded, not raised
                told = f" ({json.dumps(health())})" if health else ""
                failures.append(f"{type(error).__name__}: {error}{told}")
            took = time.monotonic() - began
        return Asked(reply, failures, took, took >= slow)

    return ask


def respond(requests: DataFrame, responder: Responder, accept: Callable[[str], bool] | None = None, attempts: int = ATTEMPTS, slow: float = SLOW_SECONDS, health: Callable[[], dict] | None = None, check: Callable[[str, dict], bool] | None = None, batch: int = 1) -> DataFrame:
    """requests (with prompt) with reply, failures, duration_s and slow; reply is null after `attempts` failures.

    duration_s is the time of the last attempt. Where health is given, what it tells after a failure stands beside it.
    check gets a reply and the row of its request. With batch above 1 so many prompts go to the responder in one call;
    those without a fine reply are then asked alone, with all their attempts.
    """
    ask = asker(responder, accept, attempts, slow, health)

    def fine(reply: str, row: dict) -> bool:
        return (accept is None or accept(reply)) and (check is None or check(reply, row))

    def together(rows: list[dict]) -> list[Asked | None]:
        began = time.monotonic()
        try:
            replies = responder([r["prompt"] for r in rows])
            took = (time.monotonic() - began) / len(rows)
            return [Asked(got, [], took, took >= slow) if fine(got, r) else None for got, r in zip(replies, rows, strict=True)]
        except Exception:  # noqa: BLE001  each is asked alone then, and its failures recorded
            return [None] * len(rows)

    def of(batches):
        for pdf in batches:
            rows, told = pdf.to_dict("records"), []
            for at in range(0, len(rows), batch):
                some = rows[at : at + batch]
                known = together(some) if batch > 1 else [None] * len(some)
                told += [k or ask(r["prompt"], (lambda reply, r=r: check(reply, r)) if check else None) for k, r in zip(known, some, strict=True)]
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(told, columns=Asked._fields)], axis=1)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    return requests.mapInPandas(of, f"{fields}, reply string, failures array<string>, duration_s double, slow boolean")


WINDOWS_TASK = 'Align these paragraphs by meaning, without changing them. Reply with JSON {"alignments":[{"zh":[],"en":[],"ru":[],"note":""}]}; an empty side is an omission.\n\n'
LANGUAGES = (("zh", "Chinese"), ("en", "English"), ("ru", "Russian"))


def is_json(reply: str) -> bool:
    json.loads(reply)
    return True


def window_requests(paragraph_rows: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """(chapter, window, offset, window_size, zh_count, en_count, ru_count, prompt): fixed windows of the longest side.

    A chapter's windows have 5 or 8 paragraphs, by its longest side and paragraph; chapters outside first..last, and those
    that lack a language, are left out. Paragraphs are numbered from 1 in each window; a side that has ended gives no lines.
    """
    rows = paragraph_rows.where((F.col("chapter") >= first) if first is not None else F.lit(True)).where((F.col("chapter") <= last) if last is not None else F.lit(True))
    counts = rows.groupBy("chapter").agg(*(F.count_if(F.col("lang") == n).alias(f"{n}_count") for n, _ in LANGUAGES)).where(" AND ".join(f"{n}_count > 0" for n, _ in LANGUAGES))
    sized = rows.join(request_window_size(rows, ["chapter"], ["lang"]).join(counts, "chapter"), "chapter")
    at = windows(sized, ["chapter"], "p", F.col("window_size")).withColumn("line", F.concat((F.col("p") - F.col("offset") + 1).cast("string"), F.lit(": "), F.col("paragraph")))

    def side(name: str, told: str) -> list[Column]:
        own = F.array_sort(F.collect_list(F.when(F.col("lang") == name, F.struct("p", "line"))))
        return [F.lit(f"{told} paragraphs:\n"), F.array_join(F.transform(own, lambda x: x["line"]), "\n"), F.lit("\n\n")]

    prompt = F.concat(F.lit(WINDOWS_TASK), *(c for n, told in LANGUAGES for c in side(n, told)))
    return at.groupBy("chapter", "window", "offset", "window_size", *(f"{n}_count" for n, _ in LANGUAGES)).agg(prompt.alias("prompt"))


def window_alignments(replies: DataFrame) -> DataFrame:
    """(chapter, window, offset, alignment) from the replies to window_requests; numbers are those of the prompt."""
    kind = "struct<zh:array<int>,en:array<int>,ru:array<int>,note:string>"
    rows = F.transform(reply_rows(F.col("reply")), lambda v: F.try_variant_get(v, "$", kind))
    return replies.select("chapter", "window", "offset", rows.alias("alignment"))


def window_report(replies: DataFrame) -> DataFrame:
    """One row a chapter: its status, windows, window size, paragraphs of each side, failed attempts and slow windows.

    A chapter with a window that has no reply asks for a review, from the first such window on.
    """
    lost = F.min(F.when(F.col("reply").isNull(), F.col("window")))
    told = [F.first("window_size").alias("window_size"), *(F.first(f"{n}_count").alias(f"{n}_count") for n, _ in LANGUAGES)]
    out = replies.groupBy("chapter").agg(F.count("*").alias("windows"), *told, F.sum(F.size("failures")).alias("failed_attempts"), F.count_if("slow").alias("slow_windows"), lost.alias("first_failed_window"))
    return out.withColumn("status", F.when(F.col("first_failed_window").isNull(), "assisted_needs_review").otherwise("review_required"))


def stop_on_failure(replies: DataFrame) -> DataFrame:
    """replies, with an error at run time on the first request that has none."""
    message = F.concat(F.lit("review required: "), F.coalesce(F.array_join("failures", "; "), F.lit("no reply")))
    return replies.withColumn("reply", F.when(F.col("reply").isNull(), F.raise_error(message).cast("string")).otherwise(F.col("reply")))


def reply_rows(reply: Column, name: str = "alignments") -> Column:
    """The rows of a JSON reply as an array of variants: a list, the list under `name`, or an object's member objects."""
    v = F.try_parse_json(reply)
    listed = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, f"$.{name}", "array<variant>"))
    members = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    return F.coalesce(listed, members)


def _side_faults(rows: Column, name: str, limit: Column, most: int) -> list[tuple[Column, str]]:
    """What may be wrong with one language of a reply's rows."""
    numbers = F.transform(rows, lambda r: r[name])
    flat = F.flatten(F.transform(numbers, lambda n: F.coalesce(n, F.array().cast("array<int>"))))
    explained = lambda r: F.coalesce(F.ltrim(r["note"]).startswith("unmatched:"), F.lit(False))
    return [
        (F.exists(numbers, lambda n: n.isNull() | (F.size(n) > most)), "numbers"),
        (F.exists(flat, lambda v: v.isNull() | (v < 1) | (v > limit)), "range"),
        (F.exists(rows, lambda r: (F.size(r[name]) == 0) & ~explained(r)), "unexplained empty side"),
        ((F.size(flat) == 0) | (F.array_max(flat) != F.size(flat)) | (F.size(F.array_distinct(flat)) != F.size(flat)), "prefix"),
    ]


def check_alignment(reply: Column, limits: dict[str, int | Column], most: int = 3) -> Column:
    """Whether a reply covers a prefix of every language exactly once, as struct<ok, reason>.

    Each row has at most `most` paragraph numbers a language, within 1..limit; an empty side needs a note that begins
    with "unmatched:". A language without any number makes the reply invalid.
    """
    schema = "struct<alignments:array<struct<" + ",".join(f"{n}:array<int>" for n in limits) + ",note:string>>>"
    rows = F.from_json(reply, schema)["alignments"]
    wrong = F.when(rows.isNull() | (F.size(rows) == 0), "no alignments")
    for name, limit in limits.items():
        for bad, why in _side_faults(rows, name, F.col(limit) if isinstance(limit, str) else F.lit(limit) if isinstance(limit, int) else limit, most):
            wrong = F.coalesce(wrong, F.when(bad, f"{name}: {why}"))
    return F.struct(wrong.isNull().alias("ok"), wrong.alias("reason"))


def findings(replies: DataFrame, key: list[str]) -> DataFrame:
    """One row per finding of each reply; a failed request gives one finding that asks for review."""
    schema = "struct<findings:array<struct<unit:int,zh:array<int>,en:array<int>,ru:array<int>,type:string,severity:string,reason:string>>>"
    told = F.from_json("reply", schema)["findings"]
    broken = F.col("reply").isNull() | F.try_parse_json("reply").isNull()
    failed = F.from_json(F.lit('{"findings":[{"type":"review_required","severity":"high","reason":"the request failed"}]}'), schema)["findings"]
    return replies.select(*key, F.explode(F.when(broken, failed).otherwise(told)).alias("f")).select(*key, "f.*")


def translation_requests(zh: Column, en: Column, glossary: Column, n: int) -> Column:
    """A prompt for a sample: glossary lines and the first n paragraphs of both sides."""
    return F.concat(F.lit("Translate into Russian, faithful to the Chinese text.\nGlossary:\n"), glossary, F.lit("\nChinese:\n"), first_paragraphs(zh, n), F.lit("\nEnglish:\n"), first_paragraphs(en, n))


def translations(replies: DataFrame) -> DataFrame:
    return replies.withColumn("translation", clean_story(F.col("reply")))


def boundary_verdicts(gates: DataFrame, replies: DataFrame, chapter: str = "chapter") -> DataFrame:
    """A verdict a gate: not_needed, the reply's status, or uncertain where there is no JSON object."""
    told = F.from_json("reply", "struct<status:string,reason_ru:string>")
    both = gates.join(replies.select(chapter, "reply"), chapter, "left")
    asked = F.col("status") == "review_required"
    return both.select(chapter, F.col("first_suspect_group").alias("boundary_group"), F.when(~asked, "not_needed").otherwise(F.coalesce(told["status"], F.lit("uncertain"))).alias("verdict"), F.when(asked, told["reason_ru"]).alias("reason"))
