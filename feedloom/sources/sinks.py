"""Writers of state, logs, reports and pages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_state(state: DataFrame, path: str) -> None:
    """A new version of the store, partitioned by day so that windows and retention prune files."""
    state.repartition("run_date").write.mode("overwrite").partitionBy("run_date").parquet(path)


def write_mirror(state: DataFrame, path: str) -> None:
    state.select("url", F.date_format("run_date", "yyyy-MM-dd").alias("date"), "title").coalesce(1).write.mode("overwrite").json(path)


def write_legacy(rows: DataFrame, path: str) -> None:
    """The mirror as it stands without a store: (url, date, title)."""
    rows.select("url", "date", "title").coalesce(1).write.mode("overwrite").json(path)


def append_record(spark: SparkSession, record: dict, path: str) -> None:
    """A run record as a JSON file of its own in the log folder, which sources.feeds.run_logs() reads."""
    spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string").coalesce(1).write.mode("append").text(path)


def write_outbox(report: DataFrame, path: str) -> None:
    """Reports (date, markdown) that could not be delivered, by date."""
    report.select("date", F.col("markdown").alias("value")).write.mode("append").partitionBy("date").text(path)


def append_inbox(pages: DataFrame, path: str) -> None:
    pages.withColumn("received_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).write.mode("append").json(path)


def write_pages(pages: DataFrame, path: str, kind: str = "json") -> None:
    """Page records as JSON, or with kind md or txt the Markdown of each as a file of its own partition by url."""
    if kind == "json":
        pages.write.mode("overwrite").json(path)
    else:
        pages.select("url", F.col("markdown").alias("value")).where("value is not null").write.mode("overwrite").partitionBy("url").option("lineSep", "\n").text(path)


def write_report(text: str, spark: SparkSession, path: str) -> None:
    """A weekly report, Markdown or JSON, as one text file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
