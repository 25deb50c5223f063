"""Mixing sources to target weights by soft membership.

A document with a source belongs to that domain; for one without, a naive Bayes
classifier fitted on the labelled table gives posteriors over the domains, in
multiples of 1 / PARTS.  Rates of documents are fitted by projected-gradient
least squares, so that the expected tokens of each domain match its target:
every step is one Spark aggregation of the expected totals, and what reaches the
driver is one number per domain or pair of domains.  Documents without a source
start at nothing and fill what a domain's own documents cannot give at their
caps; those of equal posterior have the same rate and are summed beforehand, and
the sums stay distributed.  The documents with a source give the rest of each
target.  Rates become whole copies by systematic selection in the order of
length, over the sum of the rates: the tokens chosen follow the rates closely,
and rates too small for a copy each add up to copies.

The size of the mix is a parameter; by default it is the largest at which the
shares that sources cannot reach by themselves add up to at most SHORTFALL, so
that one small source does not shrink the mix.  Sources without documents or
targets get nothing, and the others share what is left; a target that is null or
negative counts as 0, a null max_repeats as 1.
"""

from __future__ import annotations

import re
import warnings
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftwell.functions.bpe import TOKENIZERS, VOCABULARY, token_counts
from siftwell.plans.lineage import cut

SAMPLE = 2000  # labelled documents the classifier is fitted on, about, chosen by hash
BUCKETS = 1 << 12
PARTS = 64  # posteriors are multiples of 1 / PARTS
STEPS = 40
CLOSE = 1e-4  # expected shares are fitted to this
RIDGES = [0.1**i for i in range(6)] + [CLOSE / PARTS]  # the last one costs a share less than CLOSE unless every document that could help is at its bound
SHORTFALL = 0.02

TOKEN = re.compile(r"[^\W\d_]+")


def features(text: str) -> np.ndarray:
    x = np.zeros(BUCKETS, np.float32)
    for w in set(TOKEN.findall(text.lower())):
        x[zlib.crc32(w.encode()) % BUCKETS] += 1
    return x


def fit_classifier(rows: DataFrame, domains: list[str]) -> dict:
    """Naive Bayes over hashed words: log priors and log likelihoods, from counts per domain summed in Spark."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for pdf in batches:
            for d, text in zip(pdf["source"], pdf["text"]):
                sums[d] = sums.get(d, 0) + features(text)
                docs[d] = docs.get(d, 0) + 1
        out = [(d, -1, float(docs[d])) for d in sums] + [(d, int(b), float(x[b])) for d, x in sums.items() for b in np.flatnonzero(x)]
        yield pd.DataFrame(out, columns=["source", "bucket", "n"])

    counted = rows.select("source", "text").mapInPandas(run, "source string, bucket int, n double").groupBy("source", "bucket").agg(F.sum("n").alias("n"))
    counts = np.ones((len(domains), BUCKETS), np.float32)
    prior = np.ones(len(domains), np.float32)
    index = {d: i for i, d in enumerate(domains)}
    for r in counted.collect():  # a number per domain and bucket
        if r["bucket"] < 0:
            prior[index[r["source"]]] += r["n"]
        else:
            counts[index[r["source"]], r["bucket"]] += r["n"]
    return {"like": np.log(counts / counts.sum(1, keepdims=True)), "prior": np.log(prior / prior.sum())}


def parts_of(p: np.ndarray, parts: int = PARTS) -> list[int]:
    """Posteriors as whole parts that add up, by largest remainders."""
    raw = p * parts
    out = np.floor(raw + 1e-9).astype(int)
    for i in np.argsort(-(raw - out), kind="stable")[: parts - int(out.sum())]:
        out[i] += 1
    return [int(x) for x in out]


def posteriors(model: dict):
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            s = model["prior"].astype(float)
            if t:
                x = features(t)
                s = s + (model["like"] @ x) / max(np.sqrt(x.sum()), 1)
            p = np.exp(s - s.max())
            out.append(parts_of(p / p.sum()))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "array<int>")


def dot(numbers: Column, parts: Column) -> Column:
    return F.aggregate(F.zip_with(numbers, parts, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x) / PARTS


def rate_after(steps: list[list[float]], first: Column, cap: Column, parts: Column) -> Column:
    """Column: the rate after the steps, each a vector over the domains by which rates go down; never below 0 or above the cap."""
    if not steps:
        return first
    vectors = F.array(*[F.array(*[F.lit(float(x)) for x in v]) for v in steps])
    return F.aggregate(vectors, first, lambda r, v: F.greatest(F.lit(0.0), F.least(cap, r - dot(v, parts))))


def fit_rates(cells: DataFrame, target: list[float], size: float, steps: int = STEPS, low: list[float] | None = None) -> list[list[float]]:
    """One vector v for rate_after() over (parts, tokens, cap, first), by projected gradients.

    An expected share misses by what it lies above its target or below ``low``
    (the target too, unless given).  A document's rate is what it starts at less
    its membership times v, projected onto its bounds, and the squares of all
    misses and, by a ridge, of all moves weighted by tokens are least where
    ridge * v is the miss.  Every step moves v down the gradient of the convex
    dual, scaled by the token-weighted membership matrix of what lies within its
    bounds, and shorter until the dual falls; ridges are lowered one by one.
    """
    n = len(target)
    high, low = np.array(target, float), np.array(target if low is None else low, float)
    p = [F.get("parts", F.lit(i)) / PARTS for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]

    def at(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected shares, membership matrix and the cells' part of the dual."""
        raw = F.col("first") - dot(F.array(*[F.lit(float(x)) for x in v]), F.col("parts"))
        w, r, x, within = F.col("tokens") / size, F.col("rate"), F.col("raw"), F.col("within")
        moved = cells.select("parts", "tokens", "cap", raw.alias("raw"))
        moved = moved.select("parts", "tokens", "raw", F.greatest(F.lit(0.0), F.least("cap", "raw")).alias("rate"), ((x >= 0) & (x <= F.col("cap"))).cast("int").alias("within"))
        sums = [F.sum(w * r * q) for q in p] + [F.sum(w * within * p[i] * p[j]) for i, j in pairs] + [F.sum(w * r * (x - r / 2))]
        row = [float(y or 0.0) for y in moved.agg(*sums).first()]
        m = np.zeros((n, n))
        for (i, j), y in zip(pairs, row[n:]):
            m[i, j] = m[j, i] = y
        return np.array(row[:n]), m, row[-1]

    v = np.zeros(n)
    share, m, dual = at(v)
    helped = m.diagonal() > 0  # domains that some document counts for
    side = lambda: np.where(v != 0, np.sign(v), np.where(share > high, 1.0, np.where(share < low, -1.0, 0.0))) * helped
    whole = lambda u, d, ridge: ridge / 2 * u @ u + np.where(u > 0, high, low) @ u + d
    done = 0
    for ridge in RIDGES:
        while True:
            s = side()
            on, g = s != 0, ridge * v - share + np.where(s > 0, high, low)
            if not on.any() or np.abs(g[on]).max() < CLOSE:
                break
            if done >= steps:
                warnings.warn(f"rates not fitted in {steps} steps: shares are off by up to {np.abs(g[on]).max():.6f}")
                return [v.tolist()]
            done += 1
            way = np.zeros(n)
            way[on] = -np.linalg.solve((ridge * np.eye(n) + m)[np.ix_(on, on)], g[on])
            before, length = whole(v, dual, ridge), 1.0
            while True:
                u = np.where((v + length * way) * s > 0, v + length * way, 0.0)
                found = at(u)
                if whole(u, found[2], ridge) <= before + 1e-4 * (g @ (u - v)) or length < 1e-7:
                    break
                length /= 4
            v, (share, m, dual) = u, found
    return [v.tolist()] if v.any() else []


def expected_shares(cells: DataFrame, steps: list[list[float]], n: int, size: float) -> list[float]:
    rate = rate_after(steps, F.col("first"), F.col("cap"), F.col("parts"))
    sums = cells.select("tokens", "parts", rate.alias("rate")).agg(*[F.sum(F.col("rate") * F.col("tokens") / size * F.get("parts", F.lit(i)) / PARTS) for i in range(n)]).first()
    return [float(x or 0.0) for x in sums]


def mix_size(own: list[float], wanted: list[float], shortfall: float = SHORTFALL) -> float:
    """The largest size at which what sources lack of their shares adds up to at most ``shortfall``."""
    low, high = 0.0, sum(own) / max(1e-9, 1 - shortfall) + 1.0
    lacks = lambda size: sum(max(0.0, w - o / size) for o, w in zip(own, wanted)) if size else 0.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if lacks(middle) <= shortfall else (low, middle)
    return low


def mixed(documents: DataFrame, targets: DataFrame, size: float | None = None, sample: int = SAMPLE, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, parts, copies) of every document; parts are its memberships, in the order of the sources' names."""
    rows = [(r["source"], max(r["target_share"] or 0.0, 0.0), 1 if r["max_repeats"] is None else max(int(r["max_repeats"]), 0)) for r in targets.where(F.col("source").isNotNull()).orderBy("source").collect()]
    domains = [s for s, _, _ in rows]
    labelled = documents.where(F.col("source").isin(domains) & F.col("text").isNotNull() & (F.col("text") != ""))
    part = min(1.0, sample / max(labelled.select("source").count(), 1))
    few = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    model = fit_classifier(few, domains)
    onehot = F.array(*[F.when(F.col("source") == s, PARTS).otherwise(0) for s in domains]).cast("array<int>")
    known = documents.where(F.col("source").isNotNull()).select("doc_id", "source", "text", onehot.alias("parts"))
    unknown = documents.where(F.col("source").isNull()).select("doc_id", "source", "text", posteriors(model)("text").alias("parts"))
    sized = known.unionByName(unknown).select("doc_id", "source", "parts", token_counts(folder, vocabulary)("text").alias("n_tokens"))
    sized = sized.withColumn("h", F.xxhash64("doc_id"))
    # A cell for each source, and one for all documents without, these in the order of their likeliest domain.
    likeliest = F.when(F.col("source").isNull(), F.array_position("parts", F.array_max("parts")))
    sized = sized.withColumn("cell", F.concat_ws("", F.when(F.col("source").isNull(), "unknown").otherwise("source "), "source")).withColumn("lead", F.coalesce(likeliest, F.lit(0)))
    # In the order of cell and length, over ranges that split any hot cell; the ranges are kept.
    placed = cut(sized.repartitionByRange("cell", "lead", "n_tokens", "h").withColumn("_b", F.spark_partition_id()))
    sums = {r["source"]: float(r["t"] or 0) for r in placed.where(F.col("source").isin(domains)).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    caps, own = {s: c for s, _, c in rows}, [sums.get(s, 0.0) * c for s, _, c in rows]
    wanted = np.array([t if o > 0 else 0.0 for (_, t, _), o in zip(rows, own)])
    wanted = (wanted / max(wanted.sum(), 1e-12)).tolist()
    total = (mix_size(own, wanted) if size is None else float(size)) if any(wanted) else 0.0
    if not total:
        return placed.select("doc_id", "source", "n_tokens", "parts", F.lit(0).alias("copies"))
    # Documents without a source are used once at most, for what the sources cannot give by themselves.
    unknown = placed.where(F.col("source").isNull() & (F.col("n_tokens") > 0))
    cells = cut(unknown.groupBy("parts").agg(F.sum("n_tokens").cast("double").alias("tokens")).withColumn("first", F.lit(0.0)).withColumn("cap", F.lit(1.0)))
    steps = fit_rates(cells, wanted, total, low=[max(0.0, w - o / total) for w, o in zip(wanted, own)])
    given = expected_shares(cells, steps, len(domains), total)
    rates = {s: min(float(caps[s]), max(0.0, w - g) * total / sums[s]) for s, w, g in zip(domains, wanted, given) if sums.get(s)}
    filling = F.when(F.col("source").isNull() & (F.col("n_tokens") > 0), rate_after(steps, F.lit(0.0), F.lit(1.0), F.col("parts")))
    # Documents of a source that has no target get nothing.
    return _copies(placed.withColumn("rate", F.coalesce(*[F.when(F.col("source") == s, r) for s, r in rates.items()], filling, F.lit(0.0))))


def _copies(rated: DataFrame) -> DataFrame:
    """Whole copies by systematic selection: along a cell, a copy wherever the sum of the rates passes a half."""
    rated = rated.withColumn("rate", F.col("rate").cast("decimal(22,12)"))  # sums are exact in any order
    per = rated.groupBy("cell", "_b").agg(F.sum("rate").alias("sum"))  # a row per cell and range
    before = F.sum("sum").over(W.partitionBy("cell").orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    per = per.select("cell", "_b", F.coalesce(before, F.lit(0)).cast("decimal(34,12)").alias("before"))
    upto = F.sum("rate").over(W.partitionBy("cell", "_b").orderBy("lead", "n_tokens", "h", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = rated.withColumn("upto", upto).join(per, ["cell", "_b"])
    end = F.col("before") + F.col("upto") + F.lit(0.5).cast("decimal(2,1)")
    copies = F.floor(end) - F.floor(end - F.col("rate"))
    return ranked.select("doc_id", "source", "n_tokens", "parts", copies.cast("int").alias("copies"))


def mix(documents: DataFrame, targets: DataFrame, **kw) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of every document, copies 0 where it is not chosen."""
    return mixed(documents, targets, **kw).drop("parts")


def shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Shares reached by each source of the targets or of the mix, and the shares expected by membership; from mixed()."""
    names = [r["source"] for r in targets.where(F.col("source").isNotNull()).select("source").orderBy("source").collect()]
    used = F.col("n_tokens") * F.col("copies")
    per = chosen.groupBy("source").agg(F.sum(used).alias("tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), *[F.sum(used * F.get("parts", F.lit(i)) / PARTS).alias(f"_{i}") for i in range(len(names))])
    per = cut(per)  # a row per source
    total = per.agg(F.sum("tokens"), *[F.sum(f"_{i}") for i in range(len(names))]).first()
    whole = float(total[0] or 0)
    expected = F.coalesce(*[F.when(F.col("source") == s, float(total[i + 1] or 0) / whole if whole else 0.0) for i, s in enumerate(names)], F.lit(0.0))
    out = targets.select("source", "target_share", "max_repeats").join(per, "source", "full")
    zero = F.lit(0)
    share = F.coalesce(F.col("tokens") / F.lit(whole or 1.0), F.lit(0.0))
    return out.select("source", "target_share", "max_repeats", F.coalesce("tokens", zero).alias("tokens"), F.coalesce("copies", zero).alias("copies"), F.coalesce("most_copies", zero).alias("most_copies"), F.round(share, 6).alias("share"), F.round(expected, 6).alias("expected_share"))
