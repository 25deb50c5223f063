"""Linear text classification by counting: multinomial naive Bayes over hashed features.

Features are words, or the character 1- to 3-grams of words; each falls into one
of a fixed number of buckets, so that a model has a known size however large the
corpus is.  Counts are summed in Spark; scoring is one Arrow pass without a
shuffle.  Null texts and texts without a word have no label.
"""

from __future__ import annotations

import hashlib
import io
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell import lexicons as X
from siftwell.sources.files import open_file

DIGITS = 4
FIELDS = "label string, score double"


@dataclass(frozen=True)
class Features:
    """What is counted: ``kind`` words or chars, up to ``n`` characters, in ``buckets``; ``alpha`` is added to every count."""

    kind: str = "words"
    n: int = 3
    buckets: int = 1 << 14
    alpha: float = 1.0


WORDS, CHARS = Features(), Features("chars", buckets=1 << 12)
_token, _letter = regex.compile(X.WORD_TOKEN), regex.compile(r"\p{L}")


def buckets_of(token: str, features: Features) -> tuple[int, ...]:
    """Buckets of a token, by the first 32 bits of the MD5 of each of its features."""
    if features.kind == "words":
        found = [token]
    else:
        w = f"<{token}>"
        found = [w[i : i + n] for n in range(1, features.n + 1) for i in range(len(w) - n + 1)]
    return tuple(int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % features.buckets for x in found)


def tokens_of(low: str | None) -> Counter:
    """Tokens with letters of a lower-cased text, with their counts."""
    return Counter({t: n for t, n in Counter(_token.findall(low or "")).items() if _letter.search(t)})


@dataclass
class Model:
    """Labels by name, log likelihoods (label x bucket) and log priors."""

    labels: list[str]
    weights: np.ndarray
    prior: np.ndarray
    features: Features

    def best(self, low: str | None, known: dict[str, np.ndarray]) -> tuple[str | None, float | None]:
        """Most probable label (ties by name) and its probability; ``known`` keeps what a token adds to each label."""
        c = tokens_of(low)
        if not c or not self.labels:
            return None, None
        if len(known) > 200_000:
            known.clear()
        rows = []
        for t in c:
            v = known.get(t)
            if v is None:
                v = known[t] = self.weights[:, list(buckets_of(t, self.features))].sum(1)
            rows.append(v)
        s = self.prior + np.array(list(c.values()), float) @ np.array(rows)
        return self.labels[int(np.argmax(s >= s.max() - 1e-9))], round(float(1 / np.exp(s - s.max()).sum()), DIGITS)


def train(df: DataFrame, labels: DataFrame, features: Features = WORDS, key: str = "doc_id", column: str = "text") -> Model:
    """The model of the labelled documents; what reaches the driver is one count per label and bucket."""

    def run(batches):
        sums: dict[str, Counter] = {}
        for pdf in batches:
            for label, low in zip(pdf["label"], pdf["low"]):
                sums.setdefault(label, Counter()).update(tokens_of(low))
        rows = []
        for label, c in sums.items():  # each distinct token is taken apart once
            n = np.zeros(features.buckets, np.int64)
            for t, k in c.items():
                np.add.at(n, list(buckets_of(t, features)), k)
            rows += [(label, b, n[b]) for b in np.flatnonzero(n)]
        yield pd.DataFrame(rows, columns=["label", "bucket", "n"])

    rows = df.select(key, F.lower(column).alias("low")).join(labels.select(key, "label"), key).select("label", "low")
    per = rows.mapInPandas(run, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect()
    docs = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    names = sorted({r["label"] for r in per})
    counts = np.zeros((len(names), features.buckets))
    at = {x: i for i, x in enumerate(names)}
    for r in per:
        counts[at[r["label"]], r["bucket"]] = r["n"]
    total = counts.sum(1, keepdims=True)
    weights = np.log((counts + features.alpha) / (total + features.alpha * features.buckets))
    prior = np.log([docs[x] / max(sum(docs.values()), 1) for x in names]) if names else np.zeros(0)
    return Model(names, weights, np.asarray(prior), features)


def scored(text: Column, spark, model: Model) -> Column:
    """Column: struct of the best label and its probability, nulls for a text without words."""
    shared = spark.sparkContext.broadcast(model)  # labels x buckets numbers, whatever the corpus

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, known = shared.value, {}
        for texts in series:
            yield pd.DataFrame([m.best(x, known) for x in texts], columns=["label", "score"]).astype({"label": object, "score": "float64"})

    return F.pandas_udf(run, FIELDS)(F.lower(text))


def save(model: Model, path: str) -> None:
    """Writes the model to one file of any shared file system."""
    with open_file(path, write=True) as f:
        np.savez(f, labels=np.array(model.labels), weights=model.weights, prior=model.prior, features=np.array([model.features.kind, str(model.features.n), str(model.features.buckets), str(model.features.alpha)]))


def load(path: str) -> Model:
    with open_file(path) as f:
        z = np.load(io.BytesIO(f.read()))
        kind, n, buckets, alpha = z["features"].tolist()
        return Model(z["labels"].tolist(), z["weights"], z["prior"], Features(kind, int(n), int(buckets), float(alpha)))


def labelled_lines(lines: DataFrame, prefix: str = "__label__") -> tuple[DataFrame, DataFrame]:
    """Documents and labels of lines such as ``__label__good the text``; lines without a label are left out."""
    rows = lines.where(F.col("value").startswith(prefix)).select(F.xxhash64("value").alias("doc_id"), F.split("value", r"\s+", 2).alias("p")).dropDuplicates(["doc_id"])
    both = rows.select("doc_id", F.substring(F.col("p")[0], len(prefix) + 1, 1 << 20).alias("label"), F.coalesce(F.get("p", F.lit(1)), F.lit("")).alias("text"))
    return both.select("doc_id", "text"), both.select("doc_id", "label")


def predict(df: DataFrame, model: Model, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, label, score) of every document with a word."""
    out = df.select(key, scored(F.col(column), df.sparkSession, model).alias("_p"))
    return out.select(key, "_p.label", "_p.score").where(F.col("label").isNotNull())


def classify(df: DataFrame, labels: DataFrame, features: Features = WORDS, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Trains on the labelled documents and scores all."""
    return predict(df, train(df, labels, features, key, column), key, column)


def held_out(key: str = "doc_id", tenths: int = 2) -> Column:
    """Condition: the document belongs to the part that no model is fitted on, by the hash of its key."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("bigint") % 10 < tenths


def evaluate(df: DataFrame, labels: DataFrame, features: Features = WORDS, key: str = "doc_id", column: str = "text", tenths: int = 2) -> DataFrame:
    """(label, docs, right, said): of the held-out documents of each label, how many there are, are found, and get the label."""
    model = train(df, labels.where(~held_out(key, tenths)), features, key, column)
    test = predict(df.join(labels.where(held_out(key, tenths)).select(key), key, "left_semi"), model, key, column).withColumnRenamed("label", "said")
    rows = test.join(labels.select(key, "label"), key)
    per = rows.groupBy("label").agg(F.count("*").alias("docs"), F.count_if(F.col("said") == F.col("label")).alias("right"))
    said = rows.groupBy(F.col("said").alias("label")).agg(F.count("*").alias("said"))
    zero = F.lit(0)
    return per.join(said, "label", "full").select("label", F.coalesce("docs", zero).alias("docs"), F.coalesce("right", zero).alias("right"), F.coalesce("said", zero).alias("said"))


def majority(labels: DataFrame, column: str, names: dict[int, str], key: str = "doc_id") -> DataFrame:
    """(key, label) by the majority of a 0/1 column; ties and nulls are left out."""
    votes = labels.where(F.col(key).isNotNull() & F.col(column).isin(0, 1)).groupBy(key).agg(F.avg(column).alias("v")).where("v <> 0.5")
    return votes.select(key, F.when(F.col("v") > 0.5, names[1]).otherwise(names[0]).alias("label"))


def keep(scored: DataFrame, label: str, threshold: float) -> DataFrame:
    """Rows whose label is the wanted one with at least the threshold."""
    return scored.where((F.col("label") == label) & (F.col("score") >= threshold))
