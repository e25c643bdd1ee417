"""Exact dedup by whitespace-free text, with frequent digests split off (DataFrame functions only).

A Misra-Gries sketch over all digests names candidates for frequent ones. Their exact counts and winners are
aggregated map-side, which leaves at most TRACKED rows, and are broadcast: rows of a verified digest are answered where
they stand. Only the rest is dealt out by digest, and none of its digests holds more than about 2 rows / TRACKED rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, staged, table, told_apart

#: Counters of the sketch and so the most rows that are broadcast (each under 200 bytes).
TRACKED = 2000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "")


def frequent(df: DataFrame, column: str, tracked: int = TRACKED) -> DataFrame:
    """Candidates for frequent values of a string column, at most tracked / 2.

    The sketch keeps 4 * tracked slots, of which three quarters are used before it is cut; every value that stands in more
    than rows / (tracked / 2) rows is among them, and so is what is broadcast of a bounded size. A value that is missed is
    dealt out like any other.
    """
    return df.agg(F.expr(f"approx_top_k({column}, {tracked // 2}, {4 * tracked})").alias("top")).select(F.explode("top.item").alias(column)).where(F.col(column).isNotNull())


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tracked: int = TRACKED) -> DataFrame:
    """One row per row of docs: its id, keep_id, group_size, kept and text_sha256.

    Null text counts as empty, and all empty texts are one group. The longest original text stays, then the smallest id
    (null last), then one of the identical rows, so that each group keeps exactly one row. An empty table gives no rows.
    Only the id and text columns are read; other columns and their names do not matter.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"),
        F.sha2(normalised(F.col(text)), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("uid"),
    )
    rows = staged(rows, "digests").withColumn("rank", F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    hot = rows.join(F.broadcast(frequent(rows, "text_sha256", tracked)), "text_sha256", "left_semi")
    winners = hot.groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.min("rank").alias("best")).where("group_size > 1")
    rest = Window.partitionBy("text_sha256")
    told = rows.join(F.broadcast(winners), "text_sha256", "left")
    split = told.where("best IS NOT NULL").unionByName(
        told.where("best IS NULL").withColumn("group_size", F.count("*").over(rest)).withColumn("best", F.min("rank").over(rest))
    )
    return split.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.uid")).alias("kept"), "text_sha256")


def dedup_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with their own columns: one of each group, also where ids are null or repeated."""
    rows, key = told_apart(docs, doc_id)
    gone = exact_dedup(rows, text, key).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    left = rows.join(gone, rows[key] == gone["_gone"], "left_anti")
    return left if key == doc_id else left.drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
