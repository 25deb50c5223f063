"""Text sources and sinks: path lists, JSON lines, labelled lines, one document a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions import text as T

RECORD = "text string, lang string, confidence double, url string, pii_counts struct<email: int, phone_numbers: int, ip_address: int>"


def path_list(spark: SparkSession, index: str, count: int, prefix: str = "", seed: int = 2025) -> DataFrame:
    """(path): ``count`` entries of an index, in an order that the seed fixes."""
    paths = spark.read.text(index).where(F.trim("value") != "").select(F.trim("value").alias("p"))
    return paths.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), "p"), 256)).limit(count).select(F.concat(F.lit(prefix), "p").alias("path"))


def pii_total() -> Column:
    """What was masked in all."""
    c = F.col("pii_counts")
    return F.coalesce(c["email"], F.lit(0)) + F.coalesce(c["phone_numbers"], F.lit(0)) + F.coalesce(c["ip_address"], F.lit(0))


def record(df: DataFrame) -> DataFrame:
    """Documents in the shape of the JSON lines, with the total of what was masked."""
    return df.select("text", "lang", F.round("confidence", 4).alias("confidence"), "url", "pii_counts", pii_total().alias("pii_total"))


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    record(df).drop("pii_total").write.mode(mode).json(path, compression="none")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Records with ``_corrupt`` for lines that are none."""
    return spark.read.schema(RECORD + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def labelled_line(label: Column, text: Column, max_len: int = 10_000) -> Column:
    """``__label__x`` and the text on one line."""
    return F.concat_ws(" ", F.concat(F.lit("__label__"), label), T.truncate(T.flatten(text), max_len))


def positive_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(value) of good examples from JSON lines with a text, and the lines that could not be read."""
    parsed = F.from_json("value", "text string, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    raw = spark.read.text(path).select(parsed.alias("r")).select("r.*")
    good = raw.where(F.col("_corrupt").isNull() & F.col("text").isNotNull())
    return good.select(F.concat(F.lit("__label__good "), T.collapse(F.col("text"))).alias("value")), raw.where(F.col("_corrupt").isNotNull()).select("_corrupt")


def one_line(c: Column) -> Column:
    """A document on one line."""
    return T.collapse(c)


def write_lines(df: DataFrame, path: str, column: str = "text", compression: str = "gzip") -> None:
    df.where(F.col(column).isNotNull()).select(one_line(F.col(column)).alias("value")).write.mode("overwrite").text(path, compression=compression)


def read_label(c: Column) -> Column:
    """The label without its prefix."""
    return F.regexp_replace(c, "^__label__", "")
