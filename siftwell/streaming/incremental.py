"""Stage 1 over a landing folder, and exact document deduplication within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.config import Stage1Config
from siftwell.plans.pipeline import Models, stage1


def read_landing(spark: SparkSession, path: str, schema, format: str = "parquet") -> DataFrame:
    return spark.readStream.format(format).schema(schema).load(path)


def clean_stream(stream: DataFrame, config: Stage1Config = Stage1Config(), models: Models = Models()) -> DataFrame:
    """Stage 1 holds no state, so the batch plan serves a stream as well."""
    return stage1(stream, config, models)


def drop_copies(stream: DataFrame, time: str, late: str = "1 day", column: str = "text") -> DataFrame:
    """The first of equal texts that arrive within the watermark."""
    return stream.withColumn("_h", F.sha2(F.col(column), 256)).withWatermark(time, late).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def start(stream: DataFrame, out: str, checkpoint: str, once: bool = True):
    w = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()
