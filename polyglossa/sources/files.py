"""Chapter folders, manifests, images and reports as DataFrames, and their sinks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_story, safe_filename
from ..operators.corpus import running_totals
from ..shared import spread

IMAGES = r"(?i)\.(jpe?g|png|tiff?|webp)$"


def text_files(spark: SparkSession, path: str, source: str, lang: str = "") -> DataFrame:
    """*.txt of a folder: source, lang, file, body and rank by name. Names alone are sorted, by ranges; bodies join their ranks."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt").select(F.lit(source).alias("source"), F.lit(lang).alias("lang"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    ranks = running_totals(listed.select(F.url_decode("file").alias("file")), [], ["file"], {"rank": F.lit(1)}).withColumn("rank", (F.col("rank") + 1).cast("int"))
    return rows.join(ranks, "file").select("source", "lang", "file", "body", "rank")


def import_text(spark: SparkSession, path: str, out: str, language: str, label: str) -> DataFrame:
    """Cleans every text of a folder, writes one row a chapter and returns the manifest; an empty folder is an error."""
    rows = text_files(spark, path, label, language)
    if rows.isEmpty():
        raise ValueError(f"no text files in {path}")
    rows.withColumn("body", clean_story(F.col("body"))).write.mode("overwrite").parquet(out)
    entry = F.struct(F.col("file").alias("source_file"), F.col("file").alias("corpus_file"))
    return rows.groupBy(F.col("lang").alias("language"), F.col("source").alias("source_label")).agg(F.count("*").alias("chapter_count"), F.array_sort(F.collect_list(entry)).alias("chapters"))


def images(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """Images of a folder by suffix, in the order of their names; without content no bytes are read. None at all is an error."""
    rows = spark.read.format("binaryFile").load(path).where(F.col("path").rlike(IMAGES))
    names = rows.select("path", "modificationTime", "length")
    if names.isEmpty():
        raise ValueError(f"no images in {path}")
    return (rows if content else names).orderBy("path")


def recent_files(spark: SparkSession, path: str, n: int = 12) -> DataFrame:
    """The n files changed last, outside history and version folders."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")
    return rows.where(~F.col("path").rlike(r"/(history|\.git)/")).orderBy(F.desc("modificationTime"), "path").limit(n)


def progress_files(spark: SparkSession, path: str) -> DataFrame:
    """Valid progress reports below a folder, newest first: job, at and report (a variant)."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="progress.json").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at"), F.try_parse_json("value").alias("report"))
    return rows.where(F.col("report").isNotNull() & ~F.col("path").contains("/history/")).withColumn("job", F.regexp_replace("path", "/[^/]*$", "")).orderBy(F.desc("at"), "path")


def json_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def write_texts(rows: DataFrame, path: str) -> None:
    """One text file a row of (file, value) under path, named as the row says and ended by a newline; file may have folders of its own.

    Tasks write the texts under their names, each first beside its place and then moved there, so that a task that runs
    twice does no harm and no reader sees half a file; nothing comes to the driver. Files of equal names replace one
    another; other files under path stay. The path's file system is one that Arrow knows.
    """

    def of(batches):
        from pyarrow import fs

        here = re.match("(?:file:)?(/.*)", path)
        files, top = (fs.LocalFileSystem(), re.sub("^/+", "/", here[1])) if here else fs.FileSystem.from_uri(path)
        made = set()
        for batch in batches:
            for file, value in zip(batch["file"].to_pylist(), batch["value"].to_pylist(), strict=True):
                folder, _, name = f"{top.rstrip('/')}/{file}".rpartition("/")
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                # readers pass over names that begin with an underscore
                beside = f"{folder}/_{uuid.uuid4().hex}"
                with files.open_output_stream(beside) as out:
                    out.write((value or "").removesuffix("\n").encode() + b"\n")
                # the checksum that Hadoop keeps beside a file that it wrote is not the new one's
                if here and files.get_file_info(f"{folder}/.{name}.crc").type != fs.FileType.NotFound:
                    files.delete_file(f"{folder}/.{name}.crc")
                files.move(beside, f"{folder}/{name}")
            yield batch.slice(0, 0).select(["file"])

    spread(rows.select("file", "value"), "file").mapInArrow(of, "file string").write.format("noop").mode("overwrite").save()


def write_chapters(chapters: DataFrame, path: str) -> None:
    """Text files named by number and safe title, NNNN_title.txt: "# title", a blank line, the body."""
    name = F.concat(F.lpad(F.col("chapter").cast("string"), 4, "0"), F.lit("_"), safe_filename(F.col("title")), F.lit(".txt"))
    write_texts(chapters.select(name.alias("file"), F.concat(F.lit("# "), F.col("title"), F.lit("\n\n"), F.col("body")).alias("value")), path)


def write_report(report: DataFrame, path: str, indent: bool = False) -> None:
    """A report as JSON lines, or with `indent` each row as an indented document."""
    if indent:
        report = report.select(F.to_json(F.struct(*report.columns), {"pretty": "true"}).alias("value"))
        report.write.mode("overwrite").option("lineSep", "\n").text(path)
    else:
        report.write.mode("overwrite").json(path)


def append_progress(rows: DataFrame, path: str) -> None:
    """Progress is appended; readers take the last row of a job."""
    rows.write.mode("append").json(path)


def batch_sink(path: str, form: str = "json") -> Callable[[DataFrame, int], None]:
    """A sink for foreachBatch that keeps each batch in a folder of its own: a batch that is replayed replaces itself."""
    return lambda rows, batch: rows.write.mode("overwrite").format(form).save(f"{path}/batch={batch}")


def latest_progress(rows: DataFrame, job: str = "job", seq: str = "seq") -> DataFrame:
    others = [c for c in rows.columns if c not in {job, seq}]
    return rows.groupBy(job).agg(F.max(F.struct(seq, *others)).alias("_r")).select(job, "_r.*")
