"""Recognition of page images and text embedding through injectable functions."""

from __future__ import annotations

import shutil
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import images
from ..functions.ocr import clean_page


def find_executable(explicit: str | None, name: str = "tesseract", fixed: tuple[str, ...] = ()) -> str:
    """The explicit path, else the one on PATH, else a fixed one that exists."""
    for found in (explicit, shutil.which(name), *fixed):
        if found and Path(found).exists():
            return found
    raise FileNotFoundError(f"{name} was not found")


def tesseract(executable: str, languages: str = "rus+eng", mode: int = 6) -> Callable[[bytes], str]:
    def recognise(image: bytes) -> str:
        import subprocess

        return subprocess.run([executable, "stdin", "stdout", "-l", languages, "--psm", str(mode)], input=image, capture_output=True, check=True).stdout.decode("utf-8", "replace")

    return recognise


Decoder = Callable[[bytes], np.ndarray]


def page_boxes(pages: DataFrame, decode: Decoder = images.read_png) -> DataFrame:
    """(path, page_width, page_height, x, y, w, h): the boxes of what is printed on pages (path, content).

    Letters that stand near are one box. A page without any has one row whose box is null; a null content has none.
    """

    def of(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                gray = decode(bytes(content))
                found = images.joined_boxes(gray).tolist() or [[None] * 4]
                rows += [(path, gray.shape[1], gray.shape[0], *box) for box in found]
            out = pd.DataFrame(rows, columns=["path", "page_width", "page_height", "x", "y", "w", "h"])
            yield out.astype({c: "Int32" for c in out.columns[1:]})

    return pages.select("path", "content").where("content IS NOT NULL").mapInPandas(of, "path string, page_width int, page_height int, x int, y int, w int, h int")


def text_regions(boxes: DataFrame) -> DataFrame:
    """(path, lines, top, bottom): the rows of a page from its first to its last line of print.

    Pages with fewer than three lines, or with lines over less than a share of their height, are kept whole.
    """
    line = images.is_line(*(F.col(c) for c in ("x", "y", "w", "h", "page_width", "page_height")))
    own = lambda c: F.when(line, c)
    found = boxes.groupBy("path").agg(F.first("page_height").alias("height"), F.count_if(line).alias("lines"), F.min(own(F.col("y"))).alias("lo"), F.max(own(F.col("y") + F.col("h"))).alias("hi"))
    top = F.greatest(F.col("lo") - F.bround(F.col("height") * images.PAD_TOP).cast("int"), F.lit(0))
    bottom = F.least(F.col("hi") + F.bround(F.col("height") * images.PAD_BOTTOM).cast("int"), F.col("height"))
    enough = (F.col("lines") >= images.LEAST_LINES) & (bottom - top >= F.col("height") * images.LEAST_HEIGHT)
    return found.select("path", "lines", F.when(enough, top).otherwise(0).alias("top"), F.when(enough, bottom).otherwise(F.col("height")).alias("bottom"))


def prepared_png(content: bytes) -> bytes:
    """A PNG prepared for recognition; other formats, for which there is no decoder here, stay as they are."""
    return images.write_png(images.prepared(images.read_png(content))) if content[:4] == b"\x89PNG" else content


def recognised_pages(pages: DataFrame, recogniser: Callable[[bytes], str], prepare: Callable[[bytes], bytes] | None = prepared_png) -> DataFrame:
    """(stem, page, body) of images (path, content): prepared (unless prepare is None), recognised and cleaned."""

    def of(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "body": [recogniser(prepare(bytes(c)) if prepare else bytes(c)) for c in pdf["content"]]})

    rows = pages.select("path", "content").mapInPandas(of, "path string, body string")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return rows.select(stem.alias("stem"), F.concat(stem, F.lit(".txt")).alias("page"), clean_page(F.col("body")).alias("body"))


def hashing_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A deterministic stand-in for a sentence encoder: signed hashed words."""
    from zlib import crc32

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = crc32(w.encode())
                out[i, h % dim] += 1 if h & 0x10000 else -1
        return out

    return encode


def embedded(text: Column, encoder: Callable[[list[str]], np.ndarray]) -> Column:
    """Unit vectors of texts, encoded a batch at a time."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def of(texts: pd.Series) -> pd.Series:
        x = np.asarray(encoder(texts.fillna("").tolist()), float)
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return pd.Series(list((x / np.where(n > 0, n, 1)).astype(np.float32)))

    return of(text)
