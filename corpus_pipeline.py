"""A corpus pipeline of five stages; each takes its predecessor's rows as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polyglossa.llm import exact_dedup, jaccard_join, packing, substring_dedup, toxicity
from polyglossa.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model does not reject. The model learns from the labelled rows of docs that are not held out."""
    model = toxicity.fitted(spark, docs, sf_dir)
    return docs.where(toxicity.score(model) < 0.5).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity of word shingles."""
    return jaccard_join.dedup_rows(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the words that repeated windows cover."""
    return substring_dedup.dedup_text(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

#: Hash retrieval, learned weights and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs, f"stage-{name}")
    return docs
