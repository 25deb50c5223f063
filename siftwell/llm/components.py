"""Consolidating pairwise matches into groups by random graph contraction.

Each round gives every vertex a fresh random rank (a hash with the number of
the round); a vertex hooks to the neighbour of the smallest rank, itself
included.  Edges are relabelled and deduplicated, which shrinks the graph by a
constant factor each round in expectation; when no edge is left, the rounds'
mappings are expanded backwards.  A vertex with a third of all edges is only
ever aggregated with partial sums and joined against one row, never collected.

Null ends are dropped, loops and repeated edges mean nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.plans.lineage import cut

MAX_ROUNDS = 60


def groups(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(vertex, label) for every vertex of an edge that is no loop; equal labels mean linked."""
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    e = cut(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    total = None
    for r in range(MAX_ROUNDS):
        if e.isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.xxhash64(F.lit(r), c)
        near = both.groupBy("u").agg(F.min(F.struct(rank(F.col("v")).alias("k"), F.col("v").alias("to"))).alias("m"))
        own = F.struct(rank(F.col("u")).alias("k"), F.col("u").alias("to"))
        step = cut(near.select("u", F.least(F.col("m"), own)["to"].alias("to")))
        a = step.select("u", F.col("to").alias("a"))
        b = step.select(F.col("u").alias("v"), F.col("to").alias("b"))
        moved = e.join(a, "u").join(b, "v").where("a <> b")
        e = cut(moved.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
        if total is None:
            total = step.select(F.col("u").alias("vertex"), F.col("to").alias("label"))
        else:
            later = step.select(F.col("u").alias("label"), F.col("to").alias("next"))
            total = cut(total.join(later, "label", "left").select("vertex", F.coalesce("next", "label").alias("label")))
    else:
        raise RuntimeError("the graph did not contract")
    if total is None:
        return e.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    return total


def file_name(path):
    """Column: what is after the last slash, trimmed and lower-cased."""
    return F.lower(F.regexp_replace(F.substring_index(path, "/", -1), r"^\s+|\s+$", ""))


def band_edges(bands: DataFrame) -> DataFrame:
    """Links of each file to the smallest file of each band it shares with another."""
    numbers = F.regexp_replace("band", r"[\s\[\]]+", "")
    rows = bands.select("band_no", numbers.alias("b"), file_name(F.col("doc")).alias("file")).where("file is not null and file <> '' and b is not null and b <> ''")
    hubs = rows.groupBy("band_no", "b").agg(F.min("file").alias("hub"), F.max("file").alias("last")).where("hub < last").select("band_no", "b", "hub")
    return rows.join(hubs, ["band_no", "b"]).where("file <> hub").select(F.col("hub").alias("src"), F.col("file").alias("dst"))


def file_groups(bands: DataFrame) -> DataFrame:
    """(path, group_path) of each file that shares a band: its group by its smallest file name."""
    g = groups(band_edges(bands))
    names = g.groupBy("label").agg(F.min("vertex").alias("group_path"))
    return g.join(names, "label").select(F.col("vertex").alias("path"), "group_path")


def every_file(bands: DataFrame, signature: DataFrame) -> DataFrame:
    """(path, group_path) of every file of both tables; a file linked to none is its own group."""
    names = signature.select(file_name(F.col("path")).alias("path")).union(bands.select(file_name(F.col("doc")))).where("path is not null and path <> ''").distinct()
    return names.join(file_groups(bands), "path", "left").select("path", F.coalesce("group_path", "path").alias("group_path"))
