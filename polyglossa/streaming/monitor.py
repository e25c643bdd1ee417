"""Progress monitoring, deduplicated page streams, failure gates and live review queues as Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PROGRESS = "job string, at timestamp, seq long, status string, value double"


def progress_stream(spark: SparkSession, path: str, schema: str = PROGRESS, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def latest_state(rows: DataFrame, job: str = "job", order: str = "seq") -> DataFrame:
    """The last row of each job (update mode); the state is one row a job."""
    others = [c for c in rows.columns if c not in {job, order}]
    return rows.groupBy(job).agg(F.max(F.struct(order, *others)).alias("_r")).select(job, "_r.*")


def windowed_counts(rows: DataFrame, at: str, by: str, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows and values per event-time window; windows close when the watermark has passed."""
    return rows.withWatermark(at, late).groupBy(F.window(at, every), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")


def new_pages(rows: DataFrame, at: str = "at", late: str = "7 days") -> DataFrame:
    """Each url once within the watermark."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(["url"])


def failure_gate(rows: DataFrame, failures: int = 3) -> DataFrame:
    """(job, failed, stopped): a job stops once it has failed so often in a row. rows: job, seq, ok."""

    def of(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failed, stopped = state.get if state.exists else (0, False)
        for ok in pd.concat(list(batches)).sort_values("seq")["ok"]:
            failed = 0 if ok else failed + 1
            stopped = stopped or failed >= failures
        state.update((int(failed), bool(stopped)))
        yield pd.DataFrame({"job": [key[0]], "failed": [int(failed)], "stopped": [bool(stopped)]})

    return rows.select("job", "seq", "ok").groupBy("job").applyInPandasWithState(of, "job string, failed int, stopped boolean", "failed int, stopped boolean", "update", GroupStateTimeout.NoTimeout)


def pending_stream(findings: DataFrame, decided: DataFrame, key: list[str]) -> DataFrame:
    """New findings without a stored final decision."""
    return findings.join(decided.select(*key), key, "left_anti")


def run_once(rows: DataFrame, checkpoint: str, mode: str, sink) -> None:
    """Works off what there is; sink(batch, id) gets each micro-batch."""
    rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
