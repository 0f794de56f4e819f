"""SparkSession factory: UTC, adaptive execution, Arrow for the few Python stages."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "feedloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
