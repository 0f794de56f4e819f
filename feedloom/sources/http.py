"""Feeds over HTTP as a Spark data source, and delivery of a report over HTTP.

The source has one partition for each feed. A feed that cannot be fetched is a row with its error, so that one
broken feed does not fail the others.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Tries, first pause and its growth, seconds of patience, and the name that servers see.
TRIES, PAUSE, GROWTH, TIMEOUT, AGENT = 3, 1.0, 2.0, 30.0, "Mozilla/5.0 (compatible; feedloom)"
SCHEMA = "name string, url string, status int, content_type string, content_encoding string, content binary, tries int, error string"


class _Feed(InputPartition):
    def __init__(self, name: str, url: str):
        super().__init__(name)
        self.name, self.url = name, url


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.feeds = json.loads(options["feeds"])
        self.tries, self.pause, self.timeout = int(options.get("tries", TRIES)), float(options.get("pause", PAUSE)), float(options.get("timeout", TIMEOUT))

    def partitions(self) -> list[InputPartition]:
        return [_Feed(name, url) for name, url in self.feeds.items()]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        name, url, pause, error, status = partition.name, partition.url, self.pause, "", None
        for n in range(1, self.tries + 1):
            try:
                request = urllib.request.Request(url, headers={"User-Agent": AGENT, "Accept-Encoding": "gzip, deflate"})
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    yield name, url, r.status, r.headers.get("Content-Type") or "", (r.headers.get("Content-Encoding") or "").lower(), r.read(), n, None
                return
            except urllib.error.HTTPError as e:
                error, status = f"HTTP {e.code}", e.code
                if 400 <= e.code < 500 and e.code != 429:
                    break
            except (OSError, ValueError) as e:
                error, status = str(e) or type(e).__name__, None
            if n < self.tries:
                time.sleep(pause)
                pause *= GROWTH
        yield name, url, status, "", "", None, n, error


class FeedSource(DataSource):
    """spark.read.format("feeds").option("feeds", json of {name: url}); options tries, pause and timeout."""

    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_feeds(spark: SparkSession, feeds: dict[str, str], **options) -> DataFrame:
    """Rows of SCHEMA, one for each feed. The order of the result is not that of the feeds."""
    spark.dataSource.register(FeedSource)
    return spark.read.format("feeds").options(feeds=json.dumps(feeds), **{k: str(v) for k, v in options.items()}).load()


def http_deliver(url: str, token: str, title: str, timeout: float = TIMEOUT) -> Callable[[str], tuple[bool, str]]:
    """A delivery that posts a report as JSON. It succeeded if the answer's own code says 200, whatever the HTTP status."""

    def deliver(markdown: str) -> tuple[bool, str]:
        if not token.strip():
            return False, "no token"
        body = json.dumps({"token": token, "title": title, "content": markdown, "template": "markdown"}, ensure_ascii=False)
        request = urllib.request.Request(url, body.encode(), {"Content-Type": "application/json"}, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=timeout) as r:
                answer = json.loads(r.read())
        except (OSError, ValueError) as e:
            return False, str(e) or type(e).__name__
        if not isinstance(answer, dict) or answer.get("code") != 200:
            return False, f"answer {str(answer)[:200]}"
        return True, str(answer.get("data", ""))

    return deliver
