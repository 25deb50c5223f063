"""Filling windows of fixed capacity by minimum bin slack.

Documents are spread by hash over blocks of bounded size, and every block fills
its windows one after another: the largest length left opens a window, and a
subset-sum program over the multiset of lengths left, one bit per reachable
fill, finds the lengths that bring it closest to the capacity; the counts taken
of each length are read back from the program's stages.

A document longer than the capacity fills windows of its own and leaves its
remainder as an item; documents without tokens (null or empty texts) lie in a
window of their block.  Ties go to the smaller doc_id.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.bpe import TOKENIZERS, VOCABULARY, token_counts

CAPACITY = 2048
BLOCK = 4096  # documents of a block, on average
TASKS = 20_000


def best_fill(room: int, counts: dict[int, int], lengths: list[int]) -> list[tuple[int, int]]:
    """(length, copies) of the multiset whose sum comes closest below ``room``; lengths descend."""
    reach, mask = 1, (1 << (room + 1)) - 1
    stages: list[tuple[int, int, int]] = []
    goal = 1 << room
    for n in lengths:
        if n > room:
            continue
        left, k = counts[n], 1
        while left > 0:
            take = min(k, left)
            if n * take > room:
                take = room // n
                if not take:
                    break
                left = take
            grown = (reach | reach << (n * take)) & mask
            if grown != reach:
                stages.append((n, take, reach))
                reach = grown
            left -= take
            k *= 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for n, take, before in reversed(stages):
        if not (before >> at) & 1:
            taken[n] += take
            at -= n * take
    return list(taken.items())


def pack(lengths: list[int], capacity: int) -> list[int]:
    """Window of each item (lengths between 1 and capacity), by minimum bin slack."""
    items: dict[int, list[int]] = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        items[lengths[i]].append(i)
    counts = {n: len(x) for n, x in items.items()}
    order = sorted(counts, reverse=True)
    window = [0] * len(lengths)
    w = 0
    while order:
        first = order[0]
        counts[first] -= 1
        window[items[first].pop()] = w
        if not counts[first]:
            order.pop(0)
        gone = False
        for n, k in best_fill(capacity - first, counts, order) if capacity > first else ():
            for _ in range(k):
                window[items[n].pop()] = w
            counts[n] -= k
            gone |= not counts[n]
        if gone:
            order = [n for n in order if counts[n]]
        w += 1
    return window


def _fill(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        docs, pieces, sizes, windows = [], [], [], []
        small: list[tuple[int, int, int]] = []
        empty: list[int] = []
        w = 0
        for d, n in zip(pdf["doc_id"], pdf["n_tokens"]):
            if not n:
                empty.append(d)
                continue
            full, rest = divmod(int(n), capacity)
            for p in range(full if n > capacity else 0):
                docs.append(d), pieces.append(p), sizes.append(capacity), windows.append(w)
                w += 1
            if n <= capacity:
                small.append((d, 0, int(n)))
            elif rest:
                small.append((d, full, rest))
        for (d, p, n), x in zip(small, pack([n for _, _, n in small], capacity)):
            docs.append(d), pieces.append(p), sizes.append(n), windows.append(w + x)
        for d in empty:
            docs.append(d), pieces.append(0), sizes.append(0), windows.append(0)
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame({"doc_id": pd.Series(docs, dtype="int64"), "piece": pd.Series(pieces, dtype="int32"), "n_tokens": pd.Series(sizes, dtype="int64"), "block": pd.Series([block] * len(docs), dtype="int64"), "window": pd.Series(windows, dtype="int64")})

    return run


def windows(documents: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row per document (per piece, where it exceeds the capacity): its tokens, block and window in the block; rows without a doc_id are left out."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    documents = documents.where(F.col("doc_id").isNotNull())
    blocks = max(1, math.ceil(documents.count() / block))
    sized = documents.select("doc_id", token_counts(folder, vocabulary)("text").alias("n_tokens"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    # As many tasks as there are blocks, up to TASKS: left to itself, the plan puts small rows of all blocks into one.
    return sized.repartition(min(blocks, TASKS), "block").groupBy("block").applyInPandas(_fill(capacity), "doc_id long, piece int, n_tokens long, block long, window long")


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Windows, tokens, and the share of unused space."""
    per = packed.groupBy("block", "window").agg(F.sum("n_tokens").alias("n"))
    return per.agg(F.count("*").alias("windows"), F.sum("n").alias("tokens"), F.max("n").alias("fullest"), F.round(1 - F.sum("n") / (F.count("*") * capacity), 6).alias("unused_share"))
