"""Incremental crawl of chapter pages through an injectable fetcher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..functions.web import CONTAINER, next_link, next_url, story_container, story_text

LEAST_CHARS, LEAST_DELAY = 500, 2.0


#: What a request says of the reader; a crawl may be given other headers.
HEADERS = {"User-Agent": "Mozilla/5.0 (compatible; polyglossa)", "Accept-Language": "ru,en;q=0.8"}


def download(url: str, headers: dict[str, str] = HEADERS, timeout: int = 30) -> str:
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers=headers), timeout=timeout) as reply:
        charset = reply.headers.get_content_charset() or "utf-8"
        return reply.read().decode(charset, "replace")


def stories(pages: DataFrame, container: str = CONTAINER) -> DataFrame:
    """pages (url, html) with story and next_url."""
    return pages.withColumn("story", story_text(story_container(F.col("html"), container))).withColumn("next_url", next_url(F.col("html"), F.col("url")))


def _checked(count: int, delay: float) -> None:
    for wrong, why in ((count < 1, "a crawl has at least one chapter (count)"), (delay < LEAST_DELAY, f"a crawl waits at least {LEAST_DELAY} seconds between pages (delay)")):
        if wrong:
            raise ValueError(why)


STORED = "url string, story string, next_url string, fetched_at timestamp"


def _age() -> Column:
    """When a page was fetched; those stored before there were fetch times count as the oldest."""
    return F.coalesce("fetched_at", F.timestamp_seconds(F.lit(0)))


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every stored fetch; a folder that is missing or empty has none."""
    try:
        return spark.read.schema(STORED).parquet(path)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], STORED)


def latest_pages(rows: DataFrame) -> DataFrame:
    """(url, story, next_url): the last fetch of each url."""
    return rows.groupBy("url").agg(F.max_by(F.struct("story", "next_url"), _age()).alias("_r")).select("url", "_r.*")


def stored_page(spark: SparkSession, path: str, url: str):
    """The last stored row of a url, or None: one row comes to the driver, however many are stored."""
    return stored_pages(spark, path).where(F.col("url") == url).orderBy(_age().desc()).first()


def crawl(spark: SparkSession, url: str, count: int, path: str, fetch: Callable[[str], str] = download, delay: float = 3.0, container: str = CONTAINER, refresh: bool = False) -> DataFrame:
    """Follows next links from url for `count` chapters, appends what is new under path and returns all of it, each url as fetched last.

    A chain of links is sequential by nature; a page is fetched unless its row is stored, with refresh in any case. Short
    stories stop the crawl.
    """
    _checked(count, delay)
    fetched = 0
    for left in range(count - 1, -1, -1):
        row = None if refresh else stored_page(spark, path, url)
        if row is None:
            if fetched:
                time.sleep(delay)
            page = spark.createDataFrame([(url, fetch(url))], "url string, html string")
            row, fetched = stories(page, container).select("url", "story", "next_url").first(), fetched + 1
            if len(row["story"] or "") < LEAST_CHARS:
                raise ValueError(f"{url} has no story of at least {LEAST_CHARS} characters")
            spark.createDataFrame([row], "url string, story string, next_url string").withColumn("fetched_at", F.current_timestamp()).write.mode("append").parquet(path)
        url = row["next_url"]
        if left and not url:
            raise ValueError(f"{row['url']} leads to no further page")
    return latest_pages(stored_pages(spark, path))


def chapter_stream(fetch: Callable[[str], str] = download, delay: float = 3.0, batch: int = 1) -> type[DataSource]:
    """A source of a stream of pages (url, html), to be registered with spark.dataSource.

    Option url is the first page, count how many pages there are at most. The offset is the next url and the number of
    pages so far, so a query that starts again from its checkpoint goes on behind the last page that it has committed.
    `batch` pages are fetched at a time, with a pause of `delay` seconds before each page but the first; a page without
    a next link ends the stream.
    """
    _checked(batch, delay)

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, url: str, count: int) -> None:
            _checked(count, delay)
            self.url, self.count = url, count

        def initialOffset(self) -> dict:  # noqa: N802
            return {"url": self.url, "n": 0}

        def _pages(self, start: dict, most: int) -> tuple[list[tuple[str, str]], dict]:
            rows, url, n = [], start["url"], int(start["n"])
            while url and n < self.count and len(rows) < most:
                if n:
                    time.sleep(delay)
                html = fetch(url)
                rows.append((url, html))
                url, n = next_link(html, url), n + 1
            return rows, {"url": url or "", "n": n}

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            rows, end = self._pages(start, batch)
            return iter(rows), end

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
            # only for a batch that was planned but not committed when the query stopped
            return iter(self._pages(start, int(end["n"]) - int(start["n"]))[0])

    class ChapterPages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "chapter_pages"

        def schema(self) -> str:
            return "url string, html string"

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
            return Reader(self.options["url"], int(self.options.get("count", "1000000")))

    return ChapterPages
