"""Abusive, hateful or sexual content by subword-bag embeddings and a linear softmax.

A window of a sentence is the mean of the vectors of its subwords: character
n-grams of its words, the words and word pairs.  Vectors and softmax are trained
jointly in numpy.  Labels are of whole documents, so the window that speaks most
for the label stands for a document labelled toxic.  A first model is fitted on
a bounded sample of labelled documents, which holds far more toxic ones than
there are; its windows are then looked for in all labelled documents in Spark,
those that mostly clean documents have become counter-examples, and the model
is fitted anew (MINED times).  So the natural rate, and every sentence that is
common on clean pages, bear on the result at any size.  As the model is linear
after the mean, each subword adds one number, and a document is scored by its
highest window; sentences of one word are windows too.

Disguises are undone before: letters of other scripts in a word, digits and
signs for letters, spaced or dotted letters, drawn-out letters; masked letters
remain as a star, and the n-grams around it speak.

Null and empty texts score 0.  Conflicting labels go to the majority, ties and
nulls are left out; without a toxic and a clean document every score is low.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.boilerplate import Lazy, share, site
from siftwell.plans.lineage import cut

TOXIC, CLEAN = 1200, 4000  # documents of either label the model is fitted on, chosen by hash
BUCKETS = 1 << 15
DIM = 8
WINDOW = 7  # words
STRIDE = 1
MINED = 2  # times the model is fitted anew with counter-examples from all labelled documents
EPOCHS = 4
THRESHOLD = 0.75
FLOOR = -2.0  # logit from which a window can be a counter-example
RATIO = 6
LEAST = 16.0  # evidence a window must have to speak for its document's label
COUNTERS = 4000  # clean sentences of the sample that are fitted
MOST = 6000  # counter-examples fitted of a round: the windows with the highest logits
KEPT = 120  # letters of the longest line whose score is kept for when it comes again

# Letters of other scripts and signs that stand for Latin letters.
LOOKALIKE = str.maketrans("аеорсухіјԁѕһԛԝтпмкнвАЕОРСХ", "aeopcyxijdshqwtnmkhbaeopcx")
SIGNS = str.maketrans("013457@$!€", "oieastasie")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_·]){3,}[^\W\d_](?![^\W_])")
REPEATED = re.compile(r"([^\W\d_])\1{2,}")
STARS = re.compile(r"\*{2,}")
WORD = re.compile(r"[^\W\d_*]+(?:\*[^\W\d_]*)*|\*[^\W\d_]+")
CYRILLIC = re.compile(r"[Ѐ-ԯ]")
LATIN = re.compile(r"[a-zà-ÿ]")
ODD = re.compile(r"[Ѐ-ԯ*]|[^\W\d_][0-9@$]|[0-9@$][^\W\d_]|([^\W\d_])\1\1|[^\W\d_][ .\-_·][^\W\d_][ .\-_·][^\W\d_][ .\-_·]")


def plain(text: str) -> str:
    """Lower case, with disguises undone."""
    t = unicodedata.normalize("NFC", text).lower()
    if not ODD.search(t):
        return t
    t = STARS.sub("*", t)
    t = SPACED.sub(lambda m: re.sub(r"[ .\-_·]", "", m[0]), t)
    t = REPEATED.sub(r"\1", t)
    if CYRILLIC.search(t) and LATIN.search(t):
        t = re.sub(r"[^\W\d_]+", lambda m: m[0].translate(LOOKALIKE) if LATIN.search(m[0]) and CYRILLIC.search(m[0]) else m[0], t)
    return re.sub(r"[\w@$]*[^\W\d_][\w@$]*", lambda m: m[0].translate(SIGNS) if not m[0].isalpha() and re.search(r"[^\W\d_].*[0-9@$]+.*[^\W\d_]|^[0-9@$][^\W\d_]{3}|[^\W\d_]{3}[0-9@$]$", m[0]) and 5 * sum(c.isdigit() for c in m[0]) <= 3 * len(m[0]) else m[0], t)


ENDING = re.compile(r"[.!?…:;][\"'”»)\]]*$")
_tokens: dict[str, tuple] = {}


def _token(token: str) -> tuple:
    """Words of a token, whether a sentence ends with it, and whether it is a lone letter."""
    if len(_tokens) > 400_000:
        _tokens.clear()
    words = tuple(WORD.findall(plain(token)))
    t = _tokens[token] = (words, ENDING.search(token) is not None, len(token) == 1 and token.isalpha())
    return t


def sentences(text: str) -> list[list[str]]:
    """Sentences as lists of plain words; lines end sentences."""
    out: list[list[str]] = []
    for line in text.lower().split("\n"):
        tokens = line.split()
        found = [t or _token(x) for t, x in zip(map(_tokens.get, tokens), tokens)]
        if sum(t[2] for t in found) > 3:
            line = SPACED.sub(lambda m: re.sub(r"[ .\-_·]", "", m[0]), line)
            found = [_tokens.get(x) or _token(x) for x in line.split()]
        now: list[str] = []
        for words, end, _ in found:
            now += words
            if end and now:
                out.append(now)
                now = []
        if now:
            out.append(now)
    return out


def subwords(word: str) -> list[int]:
    w = f"<{word}>"
    found = {w, *(w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1))}
    return [zlib.crc32(g.encode()) % BUCKETS for g in found]


def pair(a: str, b: str) -> int:
    return zlib.crc32(f"{a}\x1f{b}".encode()) % BUCKETS


class Scorer:
    """Numbers that words and pairs add, kept by word."""

    def __init__(self, model: dict) -> None:
        self.numbers = model["numbers"].astype(float)
        self.bias = float(model["bias"])
        self.words: dict[str, float] = {}
        self.pairs: dict[tuple[str, str], float] = {}
        self.lines: dict[str, float] = {}  # highest logit of lines that may come again

    def word(self, w: str) -> float:
        v = self.words.get(w)
        if v is None:
            if len(self.words) > 300_000:
                self.words.clear()
            v = self.words[w] = float(self.numbers[subwords(w)].mean())
        return v

    def pair(self, p: tuple[str, str]) -> float:
        v = self.pairs.get(p)
        if v is None:
            if len(self.pairs) > 600_000:
                self.pairs.clear()
            v = self.pairs[p] = float(self.numbers[pair(*p)])
        return v

    def best(self, sents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Highest logit of the windows of each sentence, and where it begins."""
        n = np.array([len(s) for s in sents])
        words = [w for s in sents for w in s]
        v = np.array([self.word(w) if x is None else x for x, w in zip(map(self.words.get, words), words)])
        twos = list(zip(words, words[1:]))
        b = np.array([self.pair(p) if x is None else x for x, p in zip(map(self.pairs.get, twos), twos)] + [0.0])
        ends = np.cumsum(n)
        b[ends - 1] = 0.0
        cv, cb = np.concatenate([[0.0], np.cumsum(v)]), np.concatenate([[0.0], np.cumsum(b)])
        k = np.minimum(WINDOW, n)
        count = n - k + 1  # windows of each sentence
        first = np.repeat(ends - n, count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        size = np.repeat(k, count)
        lo = first + at
        s = (cv[lo + size] - cv[lo] + cb[lo + size - 1] - cb[lo]) / (2 * size - 1)
        starts = np.cumsum(count) - count
        top = np.maximum.reduceat(s, starts)
        hit = np.flatnonzero(s == np.repeat(top, count))
        owner = np.repeat(np.arange(len(sents)), count)[hit]
        begin = np.zeros(len(sents), int)
        begin[owner[::-1]] = at[hit[::-1]]
        return top + self.bias, begin

    def texts(self, texts: list) -> np.ndarray:
        """Probability of the worst window of each text; 0 without one."""
        if len(self.lines) > 200_000:
            self.lines.clear()
        split = [t.split("\n") if t else [] for t in texts]
        new = list({x: None for t in split for x in t if x not in self.lines})
        sents, owner = [], []
        for i, x in enumerate(new):
            own = sentences(x)
            sents += own
            owner += [i] * len(own)
        top = np.full(len(new), -np.inf)
        if sents:
            np.maximum.at(top, np.array(owner), self.best(sents)[0])
        found = dict(zip(new, top.tolist()))
        known = self.lines
        out = np.array([max([known[x] if x in known else found[x] for x in t], default=-np.inf) for t in split])
        known.update((x, v) for x, v in found.items() if len(x) < KEPT)
        return 1 / (1 + np.exp(-np.clip(out, -50, 50))) * (out > -np.inf)


def _ids(words: list[str], cache: dict) -> tuple[list[int], list[float]]:
    ids, weights = [], []
    div = 2 * len(words) - 1
    for w in words:
        s = cache.get(w)
        if s is None:
            s = cache[w] = subwords(w)
        ids += s
        weights += [1 / (len(s) * div)] * len(s)
    for a, b in zip(words, words[1:]):
        ids.append(pair(a, b))
        weights.append(1 / div)
    return ids, weights


def _train(windows: list[list[str]], labels: list[int], weights: list[float], seed: int = 3) -> dict:
    """Embeddings and softmax, jointly, by adaptive gradient steps."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.3, DIM).astype(np.float32)
    bias = 0.0
    ge, gs = np.full((BUCKETS, 1), 1e-6, np.float32), np.full(DIM, 1e-6, np.float32)
    cache: dict = {}
    data = [_ids(w, cache) for w in windows]
    y, wt = np.array(labels, float), np.array(weights, float)
    order = np.arange(len(data))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), 128):
            batch = order[at : at + 128]
            ids = np.concatenate([data[i][0] for i in batch])
            val = np.concatenate([data[i][1] for i in batch]).astype(np.float32)
            n = np.array([len(data[i][0]) for i in batch])
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])
            mean = np.add.reduceat(emb[ids] * val[:, None], starts, axis=0)
            p = 1 / (1 + np.exp(-np.clip(SHARP * (mean @ soft) + bias, -30, 30)))
            g = (p - y[batch]) * wt[batch]
            d_soft = SHARP * (g @ mean) / len(batch)
            d_emb = (SHARP * g[:, None] * soft[None])[np.repeat(np.arange(len(batch)), n)] * val[:, None]
            uniq, inv = np.unique(ids, return_inverse=True)
            acc = np.zeros((len(uniq), DIM), np.float32)
            for k in range(DIM):
                acc[:, k] = np.bincount(inv, d_emb[:, k], len(uniq))
            ge[uniq] += (acc * acc).mean(1, keepdims=True)
            emb[uniq] -= 0.15 * acc / np.sqrt(ge[uniq])
            gs += d_soft * d_soft
            soft -= (0.05 * d_soft / np.sqrt(gs)).astype(np.float32)
            bias -= 0.05 * float(g.mean())
    return {"numbers": (SHARP * (emb @ soft)).astype(np.float32), "bias": bias}


SHARP = 8.0


def _windows(s: list[str]) -> list[list[str]]:
    return [s] if len(s) <= WINDOW else [s[i : i + WINDOW] for i in range(0, len(s) - WINDOW + 1, STRIDE)]


def _spans(s: list[str]) -> list[tuple]:
    """What may speak for a label: words, and runs of two and three words."""
    return [*s, *zip(s, s[1:]), *zip(s, s[1:], s[2:])]


def _evidence(pos: list, neg: list) -> dict:
    """Log-likelihood ratio of words and word pairs for the documents labelled toxic (by documents)."""
    a: dict = {}
    b: dict = {}
    for docs, df in ((pos, a), (neg, b)):
        for d in docs:
            for x in {u for s in d for u in _spans(s)}:
                df[x] = df.get(x, 0) + 1
    np_, nn = len(pos), len(neg)
    out = {}
    for x, k in a.items():
        m = b.get(x, 0)
        expect = (k + m) * np_ / (np_ + nn)
        if k > 1 and k * nn >= RATIO * m * np_:  # said far more often in documents labelled toxic
            out[x] = 2 * (k * np.log(k / expect) + (m * np.log(m / ((k + m) * nn / (np_ + nn))) if m else 0.0))
    return out


class Sample:
    """What is fitted of the sample: the windows that may speak for a toxic label, and clean windows."""

    def __init__(self, rows: list[tuple[str, int]]) -> None:
        pos = [d for d in (sentences(t) for t, y in rows if y and t) if d]
        neg = [d for d in (sentences(t) for t, y in rows if not y and t) if d]
        self.known = _evidence(pos, neg)
        # Sentences that clean documents have as often, such as notices of a site, speak for nothing.
        clean_of = Counter(t for d in neg for t in {tuple(x) for x in d})
        toxic_of = Counter(t for d in pos for t in {tuple(x) for x in d})
        pos = [[x for x in d if clean_of[tuple(x)] < max(2, toxic_of[tuple(x)])] for d in pos]
        self.pos = [d for d in pos if d]
        ranked = [(self.spoken(w), w) for w in (max((w for s in d for w in _windows(s)), key=self.spoken) for d in self.pos)]
        self.chosen = [w for x, w in ranked if x >= LEAST] or [w for _, w in ranked]
        every = sorted({tuple(s) for d in neg for s in d})
        order = np.random.default_rng(5).permutation(len(every))[:COUNTERS]
        self.clean = [w for i in order for w in _windows(list(every[i]))[:: WINDOW - 2]]

    def spoken(self, s: list[str]) -> float:
        """Evidence of a window: its two strongest spans."""
        return sum(sorted((self.known[x] for x in _spans(s) if x in self.known), reverse=True)[:2])

    def choose(self, model: dict, counters: dict) -> None:
        """Chooses the windows that speak for the toxic labels anew; a document whose worst window looks clean has a wrong label."""
        scorer, chosen = Scorer(model), []
        for d in self.pos:
            tops, begins = scorer.best(d)
            worst = [(t, s[b : b + WINDOW]) for t, s, b in zip(tops, d, begins) if tuple(s[b : b + WINDOW]) not in counters]
            if worst:
                t, w = max(worst, key=lambda x: x[0])
                if t > 0 and self.spoken(w) >= LEAST:
                    chosen.append(w)
        self.chosen = chosen or self.chosen

    def fit(self, counters: dict[tuple, int], seed: int) -> dict:
        """The model; a counter-example weighs by how many clean documents have it."""
        if not self.chosen or not self.clean:
            return {"numbers": np.zeros(BUCKETS, np.float32), "bias": -4.0}
        hard = [list(w) for w in counters]
        weight = [4.0 if counters else 8.0] * len(self.chosen) + [1.0] * len(self.clean) + [1 + float(np.log(n)) for n in counters.values()]
        return _train(self.chosen + self.clean + hard, [1] * len(self.chosen) + [0] * (len(self.clean) + len(hard)), weight, seed=seed)


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, y) of the documents with a label, by the majority of their rows."""
    votes = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("toxic").alias("v")).where("v <> 0.5")
    votes = votes.select("doc_id", (F.col("v") > 0.5).cast("int").alias("y"))
    return documents.where(F.col("text").isNotNull()).select("doc_id", "text").join(votes, "doc_id")


def sample_of(rows: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """About ``toxic`` and ``clean`` rows of each label, chosen by hash, so that no task sends more than its part."""
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    part = {y: min(1.0, n / max(sizes.get(y, 0), 1)) for y, n in ((1, toxic), (0, clean))}
    bar = F.when(F.col("y") == 1, int(part[1] * (1 << 30))).otherwise(int(part[0] * (1 << 30)))
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < bar)


def counter_examples(rows: DataFrame, model: dict, most: int = MOST) -> dict[tuple, int]:
    """Windows with the highest logits that more clean than toxic documents have, with the number of clean ones."""
    shared = share(rows.sparkSession, model)

    def run(batches):
        scorer = Lazy.of(shared, Scorer)
        for pdf in batches:
            found, ys, logits = [], [], []
            for text, y in zip(pdf["text"], pdf["y"]):
                sents = sentences(text) if text else []
                if not sents:
                    continue
                tops, begins = scorer.best(sents)
                own = {" ".join(sents[k][begins[k] : begins[k] + WINDOW]): float(tops[k]) for k in np.flatnonzero(tops > FLOOR)}
                found += own.keys()
                logits += own.values()
                ys += [y] * len(own)
            yield pd.DataFrame({"window": pd.Series(found, dtype=object), "y": pd.Series(ys, dtype="int32"), "logit": pd.Series(np.round(logits, 3), dtype="float64")})

    windows = rows.select("text", "y").mapInPandas(run, "window string, y int, logit double")
    per = windows.groupBy("window").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"), F.max("logit").alias("logit")).where("clean > toxic")
    top = per.orderBy((F.col("logit") + F.log1p("clean")).desc(), "window").limit(most)
    return {tuple(r["window"].split(" ")): int(r["clean"]) for r in top.collect()}


def train(documents: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN, mined: int = MINED) -> dict:
    """The model of the sample, fitted anew with counter-examples from all labelled documents."""
    rows = cut(labelled(documents, labels))  # read once for the sample, once for each round
    sample = Sample([(r["text"], r["y"]) for r in sample_of(rows, toxic, clean).orderBy("doc_id").collect()])
    model = sample.fit({}, 0)
    counters: dict[tuple, int] = {}
    for r in range(mined if sample.chosen and sample.clean else 0):
        counters = counter_examples(rows, model) | counters
        sample.choose(model, counters)
        model = sample.fit(counters, r + 1)
    return model


def scores(documents: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """The documents with ``abuse_score``, the probability of their worst window."""
    shared = share(documents.sparkSession, train(documents, labels, toxic, clean))

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.round(Lazy.of(shared, Scorer).texts(list(texts)), 6), dtype="float64")

    return documents.withColumn("abuse_score", F.pandas_udf(run, "double")("text"))


def abusive(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """doc_id of documents that hold an abusive, hateful or sexually explicit sentence."""
    return scores(documents.select("doc_id", "text"), labels, toxic, clean).where(F.col("abuse_score") >= threshold).select("doc_id")


def site_rates(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """Documents, abusive documents and their rate of each site (null: no site)."""
    s = scores(documents.select("doc_id", "text", "url"), labels, toxic, clean)
    g = s.groupBy(site(F.col("url")).alias("site")).agg(F.count("*").alias("docs"), F.sum((F.col("abuse_score") >= threshold).cast("bigint")).alias("abusive"))
    return g.withColumn("rate", F.round(F.col("abusive") / F.col("docs"), 6))
