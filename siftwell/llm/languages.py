"""Document and segment languages by error-correcting output codes.

Each language has a codeword of ±1 bits; one linear classifier per bit, over
hashed character n-grams of words, predicts it.  The language whose codeword has
the smallest exponential loss against the bit margins wins; the loss gap to the
next codeword gives the confidence, and a small gap flags ambiguity.  A word
adds the same amount to every margin wherever it stands, so the margins of a
text are sums over its words.

Addresses, links and tokens with figures are no words of any language.  A
document has the language of most of its words; a further language counts for it
only by a paragraph that is long enough (CLEAR_WORDS) and far enough from every
other codeword (CLEAR), so that a quoted phrase, a contact line or a notice
follows the document it stands in.

The classifiers are fitted on a bounded sample of documents with a usable label
(about SAMPLE, by hash, as many of each language); a second round leaves out
lines that disagree with the first, since labels can be wrong.  Null and empty
texts have no language.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.boilerplate import Templates, by_site, fit_templates, site
from siftwell.llm.residue import body_of, is_residue
from siftwell.llm.structure import MARK, NAMES, PROSE, line_profiles, structure

SAMPLE = 2500  # labelled documents, at most, that the classifiers are fitted on
BUCKETS = 1 << 12
BITS = 15
STEPS = 50
MOST_LINES = 500  # lines of a language that are fitted, at most
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
ADDRESS = re.compile(r"[@＠\d]|://|[(\[{](?:at|dot)[)\]}]|[^\W\d_]{2}\.[^\W\d_]{2}", re.I)
AMBIGUOUS = 0.5  # confidence below which a segment is ambiguous
FEW = 3  # words below which it is ambiguous whatever its confidence
CLEAR, CLEAR_WORDS = 0.95, 12  # what a paragraph needs to bring a further language into a document


def codewords(n: int, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """Codewords of ±1 with large distances, drawn greedily and alike every time."""
    rng = np.random.default_rng(seed)
    code = rng.choice([-1, 1], size=(1, bits))
    while len(code) < n:
        many = rng.choice([-1, 1], size=(400, bits))
        far = np.min((many[:, None, :] != code[None]).sum(2), axis=1)
        code = np.vstack([code, many[far.argmax()]])
    return code.astype(np.float32)


def grams(word: str) -> list[int]:
    """Buckets of a word's character 1- to 4-grams and of the word itself."""
    w = f"<{word}>"
    found = {w, *(w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1))}
    return [zlib.crc32(g.encode()) % BUCKETS for g in found]


def tokenize(text: str) -> list[str]:
    return WORDS.findall(text.lower())


class Coder:
    """Bit classifiers, their codewords, and a cache of margins by word."""

    def __init__(self, model: dict) -> None:
        self.langs = model["langs"]
        self.code = codewords(len(self.langs))
        self.weights = model["weights"]
        self.bias = model["bias"]
        self.index: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, BITS + 1), np.float32)

    def _id(self, token: str) -> int:
        """Place of a token between white space: the margins of its words, and their number."""
        row = np.zeros(BITS + 1, np.float32)
        for w in () if ADDRESS.search(token) else tokenize(token):
            b = grams(w)
            row[:BITS] += self.weights[b].sum(0) / np.sqrt(len(b))
            row[BITS] += 1
        self.index[token] = len(self.rows)
        self.rows.append(row)
        return len(self.rows) - 1

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Margins of each bit and number of words of each text."""
        if len(self.index) > 300_000:
            self.index.clear()
            self.rows.clear()
            self.table = self.table[:0]
        tokens = [t.lower().split() for t in texts]
        n = np.array([len(t) for t in tokens])
        flat = [x for t in tokens for x in t]
        ids = np.array([self._id(x) if i is None and x not in self.index else self.index[x] if i is None else i for i, x in zip(map(self.index.get, flat), flat)], dtype=np.int64)
        if len(self.table) < len(self.rows):
            self.table = np.vstack([self.table, np.array(self.rows[len(self.table) :], np.float32)])
        out = np.zeros((len(texts), BITS + 1), np.float32)
        full = np.flatnonzero(n)
        if len(full):
            out[full] = np.add.reduceat(self.table[ids], np.concatenate([[0], np.cumsum(n[full])[:-1]]), axis=0)
        count = out[:, BITS]
        return np.where(count[:, None] > 0, out[:, :BITS] / np.maximum(count, 1)[:, None] + self.bias, 0), count.astype(int)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language index by the smallest loss, and a confidence from the losses of all codewords."""
        loss = np.exp(-np.clip(margins[:, None, :] * self.code[None], -6, 6)).mean(2)
        best = loss.argmin(1)
        p = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        return best, p.max(1) / p.sum(1)


def fit(rows: list[tuple[str, str]]) -> dict:
    """Fits the bit classifiers on (text, language) rows by logistic gradient steps; two rounds.

    The second round leaves out the rows whose language the first one contradicts.
    """
    langs = sorted({b for _, b in rows})
    code = codewords(len(langs))
    y = np.array([langs.index(b) for _, b in rows], dtype=int)
    known: dict[str, list[int]] = {}
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (text, _) in enumerate(rows):
        words = tokenize(text)
        for w in words:
            b = known.get(w)
            if b is None:
                b = known[w] = grams(w)
            np.add.at(x[i], b, 1 / (np.sqrt(len(b)) * len(words)))
    keep = x.any(1)
    model: dict = {}
    for _ in range(2):
        if not keep.any():
            break
        xs, target = x[keep], code[y[keep]]
        share_of = np.bincount(y[keep], minlength=len(langs)) / keep.sum()
        weight = (1 / np.sqrt(share_of[y[keep]] * len(langs)))[:, None]
        weights, bias = np.zeros((BUCKETS, BITS), np.float32), np.zeros(BITS, np.float32)
        square = np.full((BUCKETS, 1), 1e-8, np.float32)
        for _s in range(STEPS):
            g = -target / (1 + np.exp(np.clip(target * (xs @ weights + bias), -30, 30))) * weight
            gw = xs.T @ g.astype(np.float32) / len(xs)
            square += (gw * gw).mean(1, keepdims=True)
            weights -= 0.6 * gw / np.sqrt(square)
            bias -= 0.1 * g.mean(0)
        model = {"langs": langs, "weights": weights, "bias": bias}
        best, _p = Coder(model).decode(x @ weights + bias)
        keep = x.any(1) & (best == y)
    return model


def sentence_lines(body: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Paragraphs of a body: lines of prose, no headings, lists or tables."""
    if not body:
        return []
    found = line_profiles([x for _, x in body])[0]
    return [b for b, p in zip(body, found) if p >= 0 and NAMES[p] in PROSE]


def _training(pdf, ts, _):
    rows = []
    for text, host, lang, t in zip(pdf["text"], pdf["site"], pdf["code"], ts):
        for _, x in sentence_lines(body_of(text, host, t)):
            if len(x) > 60:
                rows.append((x, lang))
    return pd.DataFrame(rows, columns=["line", "code"])


def train(documents: DataFrame, labels: DataFrame, templates, sample: int = SAMPLE) -> dict:
    """Bit classifiers from about ``sample`` labelled documents: as many of each language, chosen by hash."""
    coded = documents.join(F.broadcast(labels.select("label", F.col("lang").alias("code"))), documents["lang"] == F.col("label")).where(F.col("text") != "")
    sizes = {r["code"]: r["count"] for r in coded.groupBy("code").count().collect()}  # one row per language
    if not sizes:
        return {}
    per, bar = max(sample // len(sizes), 1), F.lit(0)
    for code, n in sizes.items():
        bar = F.when(F.col("code") == code, int(min(1.0, per / n) * (1 << 30))).otherwise(bar)
    chosen = coded.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < bar)
    rows = chosen.select("doc_id", "text", site(F.col("url")).alias("site"), "code")
    lines = by_site(rows, templates, _training, "line string, code string").toPandas()
    drawn: list[tuple[str, str]] = []
    for _code, part in lines.sort_values(["code", "line"]).groupby("code"):
        part = part.sample(min(len(part), MOST_LINES), random_state=1)
        drawn += list(zip(part["line"], part["code"]))
    return fit(drawn)


SEGMENT_FIELDS = "doc_id long, line_no int, lang string, confidence double, words int, ambiguous boolean, junk boolean"


def _segments(pdf, ts, value):
    ids, nos, texts, junk = [], [], [], []
    bodies = [body_of(x, h, t) if x else [] for x, h, t in zip(pdf["text"], pdf["site"], ts)]
    profiles = line_profiles([x for b in bodies for _, x in b])[0]
    at = 0
    for d, b in zip(pdf["doc_id"], bodies):
        own = profiles[at : at + len(b)]
        at += len(b)
        lines = [x for _, x in b]
        prose, other, _ = structure(lines, own)
        out = bool(b) and (other > prose or is_residue(lines))
        for (no, x), p in zip(b, own):
            if p >= 0 and NAMES[p] in PROSE and not MARK.match(x):
                ids.append(d)
                nos.append(no)
                texts.append(x)
                junk.append(out)
    margins, n = value.coder.margins(texts) if texts else (np.zeros((0, BITS)), np.zeros(0, int))
    best, sure = value.coder.decode(margins) if texts else (np.zeros(0, int), np.zeros(0))
    langs = np.array(value.coder.langs, dtype=object)
    out = {"doc_id": pd.Series(ids, dtype="int64"), "line_no": pd.Series(nos, dtype="int32"), "lang": pd.Series(langs[best] if len(texts) else [], dtype=object), "confidence": pd.Series(np.round(sure, 4), dtype="float64"), "words": pd.Series(n, dtype="int32")}
    return pd.DataFrame(out | {"ambiguous": pd.Series((sure < AMBIGUOUS) | (n < FEW), dtype=bool), "junk": pd.Series(junk, dtype=bool)})[n > 0]


class Both:
    """Templates and coder of one broadcast."""

    def __init__(self, value) -> None:
        self.templates = Templates(value["templates"])
        self.coder = Coder(value["model"])


def segments(documents: DataFrame, pages: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A row per paragraph of each body: its language and confidence, and whether the document is residue or no prose."""
    templates = fit_templates(pages)
    model = train(documents, labels, templates, sample)
    if not model:
        return documents.sparkSession.createDataFrame([], SEGMENT_FIELDS)
    rows = documents.where(F.col("text").isNotNull()).select("doc_id", "text", site(F.col("url")).alias("site"))
    return by_site(rows, templates, _segments, SEGMENT_FIELDS, {"templates": templates.common, "model": model}, Both)


def per_language(seg: DataFrame) -> DataFrame:
    """A row per document with its ``main`` language, that language's confidence, and all ``langs`` it has.

    The main language has most of the words, weighted by confidence (ties: by
    name); segments that are ambiguous vote only where there is no other.
    """
    sure = ~F.col("ambiguous")
    per = seg.groupBy("doc_id", "lang").agg(
        F.sum(F.when(sure, F.col("words") * F.col("confidence")).otherwise(0.0)).alias("w"), F.sum(F.col("words") * F.col("confidence")).alias("all"),
        F.avg("confidence").alias("c"), F.max((F.col("confidence") >= CLEAR) & (F.col("words") >= CLEAR_WORDS) & sure).alias("clear"),
    )
    rows = per.groupBy("doc_id").agg(F.max(F.struct(F.round("w", 3).alias("w"), F.round("all", 3).alias("all"), "lang", "c")).alias("m"), F.collect_set(F.when(F.col("clear"), F.col("lang"))).alias("clear"))
    return rows.select("doc_id", F.col("m.lang").alias("main"), F.round("m.c", 4).alias("confidence"), F.array_union(F.array("m.lang"), "clear").alias("langs"))


def found(documents: DataFrame, pages: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """(doc_id, lang) of documents whose label is missing or wrong, or whose body is mixed."""
    whole = per_language(segments(documents, pages, labels, **kw).where(~F.col("junk")))
    label = documents.select("doc_id", F.col("lang").alias("label")).join(F.broadcast(labels.select("label", F.col("lang").alias("code"))), "label", "left").select("doc_id", "code")
    case = F.col("code").isNull() | ~F.array_contains("langs", F.col("code")) | (F.size("langs") > 1)
    return whole.join(label, "doc_id").where(case).select("doc_id", F.explode("langs").alias("lang"))


def document_languages(documents: DataFrame, pages: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """doc_id, its main language, confidence and number of languages; null and 0 where it has no paragraph."""
    rows = per_language(segments(documents, pages, labels, **kw))
    return documents.select("doc_id").join(rows, "doc_id", "left").select("doc_id", F.col("main").alias("lang"), "confidence", F.coalesce(F.size("langs"), F.lit(0)).alias("n_langs"))
