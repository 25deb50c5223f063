"""Token streams: offsets, packed binary files, training windows and batches."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftwell.functions.bpe import EOS, TOKENIZERS, VOCABULARY, token_ids
from siftwell.plans.lineage import cut
from siftwell.sources.files import open_file

TABLE = "_offsets"  # folder of the table of parts beside the packed files


def token_stream(df: DataFrame, key: str = "doc_id", column: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, eos: int | None = EOS) -> DataFrame:
    """(key, ids): token ids of each line of a document set, with a line feed and an end mark; null texts are left out."""
    f = token_ids(folder, vocabulary, eos)
    return df.where(F.col(column).isNotNull()).select(key, f(F.concat(F.col(column), F.lit("\n"))).alias("ids"))


def offsets(df: DataFrame, length: str, key: str = "doc_id") -> DataFrame:
    """(key, length, start): running totals in the order of the key, without one task that sorts everything.

    Keys and lengths are spread over ranges of about as many rows each, whatever
    the keys are; the totals of the ranges come first, and running sums stay
    inside a range.  The ranges are kept, so that a task that runs again finds
    the same ones.
    """
    d = cut(df.select(key, length).repartitionByRange(key).withColumn("_b", F.spark_partition_id()))
    per = d.groupBy("_b").agg(F.sum(length).alias("_n"))  # a row per range
    before = F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    per = per.select("_b", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(length).over(W.partitionBy("_b").orderBy(key).rowsBetween(W.unboundedPreceding, -1))
    return d.withColumn("_in", F.coalesce(inside, F.lit(0))).join(F.broadcast(per), "_b").select(key, F.col(length), (F.col("_before") + F.col("_in")).cast("bigint").alias("start"))


def windows(placed: DataFrame, length: str, context: int, key: str = "doc_id") -> DataFrame:
    """(window_id, key, from_pos, to_pos): which part of a document fills which consecutive window of the stream.

    The last window may be short; documents without tokens fill none.
    """
    first = F.floor(F.col("start") / context)
    last = F.floor((F.col("start") + F.col(length) - 1) / context)
    w = placed.where(F.col(length) > 0).select(key, "start", F.col(length).alias("_n"), F.explode(F.sequence(first, last)).alias("window_id"))
    a = F.greatest(F.col("window_id") * context - F.col("start"), F.lit(0))
    b = F.least((F.col("window_id") + 1) * context - F.col("start"), F.col("_n"))
    return w.select(F.col("window_id").cast("bigint").alias("window_id"), key, a.cast("bigint").alias("from_pos"), b.cast("bigint").alias("to_pos"))


def write_packed(stream: DataFrame, path: str, key: str = "doc_id", vocabulary_size: int = 50257) -> DataFrame:
    """Flat files of little-endian unsigned 16-bit ids, one per range of keys, and their table (part, file, tokens, start).

    ``path`` is a folder that all executors share (any file system that pyarrow
    opens by its address).  Each write names its files anew and the table, which
    is written last, says which count; files of earlier writes are read no more.
    Parts in the order of the table are the stream in the order of the keys.
    """
    if vocabulary_size > 65536:
        raise ValueError("ids of this vocabulary do not fit in 16 bits")
    run_id = uuid.uuid4().hex[:12]

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        name, n = f"part-{run_id}-{context.partitionId():06d}-{context.attemptNumber()}.bin", 0
        with open_file(f"{path.rstrip('/')}/{name}", write=True) as f:
            for pdf in batches:
                for ids in pdf["ids"]:
                    f.write(np.asarray(ids, dtype="<u2").tobytes())
                    n += len(ids)
        yield pd.DataFrame({"part": [context.partitionId()], "file": [name], "tokens": [n]})

    spark = stream.sparkSession
    ordered = stream.repartitionByRange(key).sortWithinPartitions(key)
    parts = cut(ordered.mapInPandas(run, "part int, file string, tokens long"))
    before = F.sum("tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # a row per file
    table = parts.where("tokens > 0").withColumn("start", F.coalesce(before, F.lit(0)))
    table.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{TABLE}")
    return packed_parts(spark, path)


def packed_parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, file, tokens, start) of packed files."""
    return spark.read.parquet(f"{path.rstrip('/')}/{TABLE}")


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """(part, start, ids) of packed files; in the order of ``part`` they are the stream."""

    def run(batches):
        for pdf in batches:
            for part, file, start in zip(pdf["part"], pdf["file"], pdf["start"]):
                with open_file(f"{path.rstrip('/')}/{file}") as f:
                    yield pd.DataFrame({"part": [part], "start": [start], "ids": [np.frombuffer(f.read(), dtype="<u2").astype("int32")]})

    return packed_parts(spark, path).repartition("part").mapInPandas(run, "part int, start long, ids array<int>")


def random_batches(spark: SparkSession, path: str, batches: int, size: int, context: int, seed: int) -> DataFrame:
    """(batch, row, start, x, y): windows at seeded random starts of the packed stream; y is x one position on.

    Starts are drawn by row; each window reads its own bytes, which may lie in
    several files.  The table of files is what every task holds.
    """
    table = [(r["start"], r["tokens"], r["file"]) for r in packed_parts(spark, path).orderBy("part").collect()]  # a row per file
    total = sum(n for _, n, _ in table)
    if total <= context:
        raise ValueError("the stream is shorter than a window")
    begins = np.array([s for s, _, _ in table])

    def cut_out(start: int) -> np.ndarray:
        out, at, left = [], start, context + 1
        i = int(np.searchsorted(begins, start, "right")) - 1
        while left:
            s, n, file = table[i]
            take = min(left, s + n - at)
            with open_file(f"{path.rstrip('/')}/{file}", at=2 * (at - s)) as f:
                out.append(np.frombuffer(f.read(2 * take), dtype="<u2"))
            at, left, i = at + take, left - take, i + 1
        return np.concatenate(out).astype("int64")

    def run(frames):
        for pdf in frames:
            w = [cut_out(s) for s in pdf["start"]]
            yield pdf.assign(x=[a[:-1] for a in w], y=[a[1:] for a in w])

    rows = spark.range(batches * size).select((F.col("id") / size).cast("int").alias("batch"), (F.col("id") % size).cast("int").alias("row"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(total - context)).alias("start"))
    return rows.mapInPandas(run, "batch int, row int, start long, x array<bigint>, y array<bigint>")


def batch(ids, size: int, context: int, seed: int):
    """(x, y) arrays of ``size`` windows at seeded random starts of a stream in memory; y is x one position on."""
    ids = np.asarray(ids)
    if len(ids) <= context:
        raise ValueError("the stream is shorter than a window")
    starts = np.random.default_rng(seed).integers(0, len(ids) - context, size)
    return np.stack([ids[s : s + context] for s in starts]).astype("int64"), np.stack([ids[s + 1 : s + 1 + context] for s in starts]).astype("int64")
