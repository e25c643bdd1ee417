"""Replies that outlast failures: a store of what was asked, queues that stop at a failure, and chapters walked block by block.

A store is a folder of Parquet that only grows: one row for each time a request was asked. A request is known by the digest of
its key, its model and its prompt, so a changed prompt is a new request. Only rows with a reply count as answered; what
failed is asked again by the next run. Every row is written before anything reads it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .requests import ATTEMPTS, Asked, Responder, asker, respond

_TOLD = "reply string, failures array<string>, duration_s double, slow boolean"
_STORED = f"request string, {_TOLD}, asked_at timestamp"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a store; a folder that is missing or empty has none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def request_digest(key: list[str], model: str = "") -> Column:
    return F.sha2(F.to_json(F.struct(*(F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(key)), F.lit(model).alias("model"), F.col("prompt").alias("prompt"))), 256)


def _last(rows: DataFrame) -> DataFrame:
    """The row that counts of each request: the last one with a reply, else the last one."""
    told = F.struct("reply", "failures", "duration_s", "slow")
    return rows.groupBy("request").agg(F.max_by(told, F.struct(F.col("reply").isNotNull(), "asked_at")).alias("_told")).select("request", "_told.*")


def stored_replies(requests: DataFrame, responder: Responder, path: str, key: list[str], model: str = "", in_flight: int | None = None, **options) -> DataFrame:
    """requests (with prompt) with reply, failures, duration_s and slow, after those without a stored reply have been asked.

    in_flight bounds the tasks that ask at the same time. options are those of respond.
    """
    spark = requests.sparkSession
    asked = requests.withColumn("request", request_digest(key, model))
    todo = asked.join(stored(spark, path, _STORED).where("reply IS NOT NULL").select("request"), "request", "left_anti").select("request", "prompt").dropDuplicates(["request"])
    if in_flight:
        todo = todo.repartition(in_flight)
    respond(todo, responder, **options).drop("prompt").withColumn("asked_at", F.current_timestamp()).write.mode("append").parquet(path)
    return asked.join(_last(stored(spark, path, _STORED)), "request", "left").select(*requests.columns, "reply", "failures", "duration_s", "slow")


def queued_replies(requests: DataFrame, responder: Responder, path: str, key: list[str], job: str, order: list[str], model: str = "", **options) -> DataFrame:
    """stored_replies for queues: the requests of a job are asked in their order, and none after one that failed.

    state is done, failed or held (not asked, as an earlier one of its job failed). The next run asks the failed one
    again and goes on from there. Jobs are asked side by side; a job is one after the other by its nature.
    """
    spark, ask = requests.sparkSession, asker(responder, **options)

    def of(batches):
        current, stopped = object(), False
        for pdf in batches:
            out = []
            for request, own, prompt, known in zip(pdf["request"], pdf["_job"], pdf["prompt"], pdf["known"], strict=True):
                if own != current:
                    current, stopped = own, False
                if known or stopped:
                    continue
                told = ask(prompt)
                stopped = told.reply is None
                out.append((request, *told))
            yield pd.DataFrame(out, columns=["request", *Asked._fields])

    asked = requests.withColumn("request", request_digest(key, model))
    known = stored(spark, path, _STORED).where("reply IS NOT NULL").select("request").distinct().withColumn("known", F.lit(True))
    queue = asked.join(known, "request", "left").select("request", F.coalesce(F.col(job).cast("string"), F.lit("")).alias("_job"), *(F.col(c).alias(f"_at{i}") for i, c in enumerate(order)), "prompt", F.coalesce("known", F.lit(False)).alias("known"))
    queue = queue.repartition("_job").sortWithinPartitions("_job", *(f"_at{i}" for i in range(len(order))))
    told = queue.select("request", "_job", "prompt", "known").mapInPandas(of, f"request string, {_TOLD}")
    told.withColumn("asked_at", F.current_timestamp()).write.mode("append").parquet(path)
    out = asked.join(_last(stored(spark, path, _STORED)), "request", "left").select(*requests.columns, "reply", "failures", "duration_s", "slow")
    # a request behind a failed one may have failed in a run before; it is held all the same
    lost = F.min(F.when(F.col("reply").isNull(), F.struct(*order))).over(Window.partitionBy(job))
    return out.withColumn("_lost", lost).withColumn("state", F.when(F.col("reply").isNotNull(), "done").when(F.struct(*order) == F.col("_lost"), "failed").otherwise("held")).drop("_lost")


def queue_report(queued: DataFrame, job: str) -> DataFrame:
    """(job, done, held, failed_attempts, status): complete, or review_required where a request of the job failed."""
    failed = F.count_if(F.col("state") == "failed")
    return queued.groupBy(job).agg(
        F.count_if(F.col("state") == "done").alias("done"),
        F.count_if(F.col("state") == "held").alias("held"),
        F.coalesce(F.sum(F.when(F.col("state") == "failed", F.size("failures"))), F.lit(0)).alias("failed_attempts"),
        F.when(failed > 0, "review_required").otherwise("complete").alias("status"),
    )


def gated_stream(requests: DataFrame, responder: Responder, pause_ms: int | None = None, **options) -> DataFrame:
    """(job, seq, state, reply, failures) for a stream of (job, seq, prompt): states done, failed and held, as updates.

    A job asks its requests by seq. After one has failed its attempts the job stops: it and all later ones wait in the
    job's state, unasked, until a row of the job without prompt tells it to go on, or pause_ms have passed. One job's
    requests are asked one after the other; a task works on many jobs. A pause makes Spark start batches without data as
    well; a run that is to end by itself turns those off (spark.sql.streaming.noDataMicroBatches.enabled).
    """
    ask = asker(responder, **options)
    columns = ["job", "seq", "state", "reply", "failures"]

    def of(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stopped, seqs, prompts = state.get if state.exists else (False, [], [])
        rows = [r for pdf in batches for r in zip(pdf["seq"], pdf["prompt"], strict=True)]
        new = [(int(seq), prompt) for seq, prompt in rows if isinstance(prompt, str)]
        resumed = len(new) < len(rows) or state.hasTimedOut
        waiting, out = list(zip(seqs, prompts, strict=True)), []
        if stopped and not resumed:
            waiting += new
            out = [(key[0], seq, "held", None, []) for seq, _ in sorted(new)]
        else:
            waiting, stopped = sorted(waiting + new), False
            while waiting and not stopped:
                told = ask(waiting[0][1])
                stopped = told.reply is None
                out.append((key[0], waiting[0][0], "failed" if stopped else "done", told.reply, list(told.failures)))
                if not stopped:
                    waiting.pop(0)
            out += [(key[0], seq, "held", None, []) for seq, _ in waiting[1:]]
        if stopped:
            state.update((True, [int(seq) for seq, _ in waiting], [prompt for _, prompt in waiting]))
            if pause_ms is not None:
                state.setTimeoutDuration(pause_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=columns)

    timeout = GroupStateTimeout.NoTimeout if pause_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    told = "job string, seq long, state string, reply string, failures array<string>"
    return requests.select("job", "seq", "prompt").groupBy("job").applyInPandasWithState(of, told, "stopped boolean, seqs array<long>, prompts array<string>", "update", timeout)


LANGS = ("zh", "en", "ru")
CURSORS = [f"c_{n}" for n in LANGS]
_GROUPS = "struct<alignments:array<struct<zh:array<int>,en:array<int>,ru:array<int>,note:string>>>"
_BLOCKS = f"chapter_key string, text long, model string, {', '.join(f'c_{n} long' for n in LANGS)}, {_TOLD}, asked_at timestamp, run string"
TASK = 'Align the next paragraphs of a chapter. Reply with JSON {"alignments":[{"zh":[],"en":[],"ru":[],"note":""}]}.\n'


def covers(reply: str, have: dict[str, int]) -> bool:
    """Whether a reply covers a prefix of every language exactly once, by groups of at most three paragraphs a side."""
    rows = json.loads(reply)["alignments"]
    for r in rows:
        if any(len(r[n]) > 3 for n in LANGS) or (not all(r[n] for n in LANGS) and not str(r.get("note") or "").strip().startswith("unmatched:")):
            return False
    for n in LANGS:
        seen = sorted(v for r in rows for v in r[n])
        if not seen or len(seen) > have[n] or seen != list(range(1, len(seen) + 1)):
            return False
    return bool(rows)


def _blocks_told(spark: SparkSession, path: str, chapters: DataFrame, model: str) -> DataFrame:
    """(chapter_key, c_*, rows) of the stored replies that count: of equal cursors the first one, for unchanged chapters."""
    rows = stored(spark, path, _BLOCKS).where((F.col("model") == model) & F.col("reply").isNotNull())
    rows = rows.join(chapters.select("chapter_key", "text"), ["chapter_key", "text"], "left_semi")
    first = rows.groupBy("chapter_key", *(f"c_{n}" for n in LANGS)).agg(F.min_by("reply", F.struct("asked_at", "run")).alias("reply"))
    return first.withColumn("rows", F.from_json("reply", _GROUPS)["alignments"])


def sequential_alignment(paragraph_rows: DataFrame, responder: Responder, path: str, size: int = 8, attempts: int = ATTEMPTS, model: str = "") -> DataFrame:
    """Groups (chapter, g, zh, en, ru) of global paragraph numbers from replies about the next `size` paragraphs of each side.

    A chapter's cursors are the sums of what its stored replies consumed, so a run that was cut off goes on where it was,
    and asks nothing twice but the blocks in flight. Each round asks the next block of all chapters side by side and
    writes the replies under path; rounds end when no chapter has a block to ask. A block whose attempts fail, by an error
    or by a reply that does not cover a prefix of every side, ends its chapter for this run; so does a side that is used up
    before the others. Such chapters have a row with g 0 beside their groups. Changed texts and models start anew.
    """
    spark, run = paragraph_rows.sparkSession, uuid.uuid4().hex
    kind = dict(paragraph_rows.dtypes)["chapter"]
    place = Window.partitionBy("chapter_key", "lang").orderBy("p")
    texts = paragraph_rows.select(F.col("chapter").cast("string").alias("chapter_key"), "chapter", "lang", "p", "paragraph").where(F.col("lang").isin(*LANGS))
    texts = texts.withColumn("place", F.row_number().over(place))
    chapters = texts.groupBy("chapter_key").agg(F.first("chapter").alias("chapter"), F.bit_xor(F.xxhash64("lang", "place", "paragraph")).alias("text"), *(F.count_if(F.col("lang") == n).alias(f"n_{n}") for n in LANGS))
    have = lambda row: {n: int(row[f"n_{n}"]) for n in LANGS}
    while True:
        consumed = _blocks_told(spark, path, chapters, model).select("chapter_key", *(F.array_max(F.flatten(F.col(f"rows.{n}"))).alias(f"m_{n}") for n in LANGS))
        sums = consumed.groupBy("chapter_key").agg(*(F.sum(f"m_{n}").alias(f"c_{n}") for n in LANGS))
        at = chapters.join(sums, "chapter_key", "left").select("chapter_key", "chapter", "text", *(f"n_{n}" for n in LANGS), *(F.coalesce(f"c_{n}", F.lit(0)).cast("long").alias(f"c_{n}") for n in LANGS))
        failed = stored(spark, path, _BLOCKS).where((F.col("run") == run) & F.col("reply").isNull()).select("chapter_key").distinct()
        open_ = at.where(" AND ".join(f"c_{n} < n_{n}" for n in LANGS)).join(failed, "chapter_key", "left_anti")
        if open_.isEmpty():
            break
        cursor = F.coalesce(*(F.when(F.col("lang") == n, F.col(f"c_{n}")) for n in LANGS))
        near = open_.join(texts.select("chapter_key", "lang", "place", "paragraph"), "chapter_key").where((F.col("place") > cursor) & (F.col("place") <= cursor + size))
        line = F.concat((F.col("place") - cursor).cast("string"), F.lit(": "), F.coalesce("paragraph", F.lit("")))
        sides = [F.array_sort(F.collect_list(F.when(F.col("lang") == n, F.struct("place", line.alias("line"))))) for n in LANGS]
        body = F.concat_ws("\n", *(F.concat(F.lit(f"{n}:\n"), F.array_join(F.transform(s, lambda x: x["line"]), "\n")) for n, s in zip(LANGS, sides, strict=True)))
        asked = near.groupBy("chapter_key", "text", *CURSORS).agg(F.concat(F.lit(TASK), body).alias("prompt"), *(F.count_if(F.col("lang") == n).alias(f"n_{n}") for n in LANGS))
        told = respond(asked, responder, attempts=attempts, check=lambda reply, row: covers(reply, have(row)))
        told = told.withColumns({"asked_at": F.current_timestamp(), "run": F.lit(run), "model": F.lit(model)})
        told.select("chapter_key", "text", "model", *CURSORS, "reply", "failures", "duration_s", "slow", "asked_at", "run").write.mode("append").parquet(path)
    rows = _blocks_told(spark, path, chapters, model).select("chapter_key", *CURSORS, F.posexplode("rows").alias("i", "r"))
    number = F.row_number().over(Window.partitionBy("chapter_key").orderBy(F.expr(" + ".join(CURSORS)), "i"))
    shifted = lambda n: F.transform(F.col("r")[n], lambda v: (v + F.col(f"c_{n}")).cast("int"))
    sides = [shifted(n).alias(n) for n in LANGS]
    groups = rows.select("chapter_key", number.alias("g"), *sides).join(chapters.select("chapter_key", "chapter"), "chapter_key").select("chapter", "g", *LANGS)
    none = [F.array().cast("array<int>").alias(n) for n in LANGS]
    ended = at.where(" OR ".join(f"c_{n} < n_{n}" for n in LANGS)).select("chapter", F.lit(0).alias("g"), *none)
    return groups.unionByName(ended).withColumn("chapter", F.col("chapter").cast(kind))

