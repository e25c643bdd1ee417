"""E-book archives: table of contents and chapter texts, one archive a task row."""

from __future__ import annotations

import io
import zipfile
from pathlib import PurePosixPath
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_leading_lines, safe_filename, trim_ws
from ..functions.web import html_text


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def contents(data: bytes) -> list[tuple[int, str, str, str]]:
    """(order, title, href, markup) of the navigation points that have a title and a target, nested ones included."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        container = ElementTree.fromstring(z.read("META-INF/container.xml"))
        package = next((e.get("full-path") for e in container.iter() if _local(e.tag) == "rootfile"), None)
        if not package:
            return []
        items = ElementTree.fromstring(z.read(package)).iter()
        ncx = next((e.get("href") for e in items if _local(e.tag) == "item" and e.get("media-type") == "application/x-dtbncx+xml"), None)
        if not ncx:
            return []
        base = str(PurePosixPath(package).parent / ncx)
        out = []
        for point in ElementTree.fromstring(z.read(base)).iter():
            if _local(point.tag) != "navPoint":
                continue
            title = next(((e.text or "").strip() for e in point.iter() if _local(e.tag) == "text"), "")
            src = next((e.get("src") or "" for e in point.iter() if _local(e.tag) == "content"), "")
            if title and src:
                href = str(PurePosixPath(base).parent / src.split("#")[0])
                name = href if href in z.NameToInfo else unquote(href)
                out.append((len(out) + 1, title, href, z.read(name).decode("utf-8", "replace") if name in z.NameToInfo else ""))
        return out


def chapters_of(archives: DataFrame) -> DataFrame:
    """path, order, title, href and markup of every chapter of archives (path, content)."""

    def of(batches):
        for pdf in batches:
            rows = [(p, *c) for p, d in zip(pdf["path"], pdf["content"], strict=True) for c in contents(d)]
            yield pd.DataFrame(rows, columns=["path", "order", "title", "href", "markup"])

    return archives.select("path", "content").mapInPandas(of, "path string, order int, title string, href string, markup string")


def epub_chapters(spark: SparkSession, path: str) -> DataFrame:
    """The chapters of the archives under path."""
    return chapters_of(spark.read.format("binaryFile").load(path))


def extract(chapters: DataFrame, count: int, start: int = 1) -> DataFrame:
    """Chapters start .. start + count - 1 of each archive as text: order, title, file and body with its heading."""
    own = chapters.where(F.col("order").between(start, start + count - 1)).withColumn("text", html_text(F.col("markup")))
    name = F.regexp_replace(F.element_at(F.split("href", "/"), -1), r"\.[^.]*$", "")
    body = drop_leading_lines(F.col("text"), F.col("title"), name)
    file = F.concat(F.lpad(F.col("order").cast("string"), 4, "0"), F.lit("_"), safe_filename(F.col("title")), F.lit(".txt"))
    return own.select("path", "order", "title", "href", file.alias("file"), F.concat(F.lit("# "), F.col("title"), F.lit("\n\n"), trim_ws(body), F.lit("\n")).alias("body"))


def manifest(extracted: DataFrame, language: str, start: int = 1) -> DataFrame:
    entry = F.struct("order", "title", "href")
    return extracted.groupBy(F.col("path").alias("source_epub")).agg(F.lit(language).alias("language"), F.lit(start).alias("toc_start"), F.count("*").cast("int").alias("chapter_count"), F.array_sort(F.collect_list(entry)).alias("chapters"))
