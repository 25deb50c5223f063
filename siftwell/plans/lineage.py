"""Cutting lineage so that a lost executor costs no more than its own part."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the cluster names; only on a single machine is one made where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siftwell-"))


def cut(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared checkpoint folder."""
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)
