"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "siftwell", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",  # documents can be long
        "spark.ui.enabled": "false",
    }
    for k, v in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()
