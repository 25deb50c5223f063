"""Skip-chain conditional random field over the tokens of a document, with trained potentials.

The lines of a document that hold a candidate of any kind are sequences of
tokens, each with one label: none, or a kind of personal information.  Node
potentials are what the shapes of the candidates say (pii.WEIGHTS), to which the
fit adds the weights of hashed features (shape, letters around digits, the
words on both sides, whether the token is, or is built like, a listed name, and
which shapes of candidates cover it); neighbours share a matrix of transitions;
skip edges join distant tokens of the document that repeat a word or a number,
or have the same shape of digits, and favour equal labels.  Loopy sum-product
over all edges, of all documents of a batch at once, gives the marginals.

The tables have no right labels.  The weights are fitted by pseudo-likelihood, on
a bounded sample of documents (SAMPLE, by hash), to the candidates of which
pii.Tagger is all but certain (CERTAIN), as labels; what lies between counts in
proportion to its marginal, and is decided by the field.  Null texts come out as null with zero counts;
placeholders of an earlier masking stay.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import pii
from siftwell.llm.boilerplate import Lazy, share

LABELS = ("none", *pii.KINDS)
SAMPLE = 4000  # documents the potentials are fitted on, about
CERTAIN = 0.9
BUCKETS = 1 << 15
NO_SHAPE, BOUND = -4.0, 6.0  # potential of a kind without a candidate, and the largest of one with
WIDE = 16  # features of a token, at most
LEAST = 0.2  # marginal of all kinds together from which a token belongs to one: a miss is worse than a mask too many
EPOCHS = 30
DROPPED = 0.1  # share of features left out of each step of the fit
ROUNDS = 6
CORE = re.compile(r"^\W+|\W+$")
SHAPES = ((re.compile(r"\d+"), "0"), (re.compile(r"[^\W\d_]+"), "a"))


def shape(token: str) -> str:
    for pattern, to in SHAPES:
        token = pattern.sub(to, token)
    return token[:12]


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % (BUCKETS - 1) + 1  # 0 is no feature


class Graph:
    """Tokens of the evidence lines of several texts, their features, and the edges between them."""

    def __init__(self, tagger: pii.Tagger, texts: list) -> None:
        self.ids: list[list[int]] = []
        self.place: list[tuple[int, int]] = []
        self.owner: list[int] = []
        self.line: list[int] = []
        self.seed: list[tuple[int, float]] = []  # label and its weight; the rest is none
        self.score: list[list[float]] = []
        self.near: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.known: dict[str, int] = {}
        self.found: dict[int, tuple[list, int, int]] = {}  # candidates of each text, and its tokens
        for d, text in enumerate(texts):
            if text:
                self._add(tagger, d, text)

    def _id(self, feature: str) -> int:
        i = self.known.get(feature)
        if i is None:
            i = self.known[feature] = _bucket(feature)
        return i

    def _add(self, tagger: pii.Tagger, d: int, text: str) -> None:
        found = tagger.candidates(text)
        if not found:
            return
        sure = pii.marginals(found)
        spans = sorted((a, b, k, p, s) for (a, b, k, s, _), p in zip(found, sure))
        first, at, by = len(self.ids), 0, defaultdict(list)
        for no, line in enumerate(text.split("\n"), 1):
            end = at + len(line)
            inside = [s for s in spans if s[0] < end and s[1] > at]
            if inside:
                self._line(tagger, d, no, line, at, inside, by)
            at = end + 1
        self.found[d] = (found, first, len(self.ids))
        for members in by.values():
            self.skip += zip(members, members[1:])

    def _line(self, tagger, d, no, line, at, inside, by) -> None:
        toks = [(m.start() + at, m.end() + at, m[0]) for m in pii.TOKEN.finditer(line)]
        cores = [CORE.sub("", t).lower() for _, _, t in toks]
        n = len(self.ids)
        for i, (a, b, t) in enumerate(toks):
            over = [s for s in inside if s[0] < b and s[1] > a]
            kinds = {k for _, _, k, _, _ in over}
            score = [0.0] + [NO_SHAPE] * len(pii.KINDS)
            for _, _, k, _, x in over:
                at_kind = LABELS.index(k)
                score[at_kind] = max(score[at_kind], min(max(x, -BOUND), BOUND))
            self.score.append(score)
            name = tagger.names.kind(t)
            before, after = cores[i - 1] if i else "<", cores[i + 1] if i + 1 < len(cores) else ">"
            near = "".join(str(tagger.names.kind(toks[j][2])) if 0 <= j < len(toks) else "-" for j in (i - 1, i + 1))
            f = [f"s{shape(t)}", f"w{cores[i]}", f"b{before}", f"a{after}", f"n{name}{t[:1].isupper()}", f"g{near}", f"p{cores[i - 2] if i > 1 else '<'}", f"e{t[-1]}", f"u{t.isupper()}", "1"]
            f += [f"k{'+'.join(sorted(kinds))}"] if kinds else []  # the kinds of all candidates that cover the token, as one
            f += [f"c{k}" for k in sorted(kinds)] + [f"cb{k}{before}" for k in sorted(kinds)][:2]
            self.ids.append([self._id(x) for x in f][:WIDE])
            self.place.append((a, b))
            self.owner.append(d)
            self.line.append(no)
            best = max(over, key=lambda s: s[3], default=None)
            p = best[3] if best else 0.0
            self.seed.append((LABELS.index(best[2]), 1.0 if p >= CERTAIN else p) if p > 1 - CERTAIN else (0, 1.0))
            if i:
                self.near.append((n + i - 1, n + i))
            digits = sum(map(str.isdigit, t))
            if digits > 3:
                by["0", shape(t)].append(n + i)
                by["n", re.sub(r"\D", "", t)].append(n + i)
            elif len(cores[i]) > 3 and (name or kinds):
                by["w", cores[i]].append(n + i)

    def arrays(self):
        x = np.zeros((len(self.ids), WIDE), np.int32)
        for i, f in enumerate(self.ids):
            x[i, : len(f)] = f
        edges = lambda e: np.array(e, np.int64).reshape(-1, 2)
        return x, np.array(self.score, float).reshape(-1, len(LABELS)), edges(self.near), edges(self.skip), self.seed


def fit(tagger: pii.Tagger, texts: list, epochs: int = EPOCHS, seed: int = 1) -> dict:
    """Weights of features, transitions and skip edges by pseudo-likelihood of the certain labels."""
    x, score, near, skip, y = Graph(tagger, texts).arrays()
    k = len(LABELS)
    w, t, u = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    if not len(x):
        return {"w": w.astype(np.float32), "t": t, "u": u}
    one = np.zeros((len(x), k))
    for i, (label, p) in enumerate(y):
        one[i, label] += p
        one[i, 0] += 1 - p
    left, right, same = np.zeros_like(one), np.zeros_like(one), np.zeros_like(one)
    left[near[:, 1]], right[near[:, 0]] = one[near[:, 0]], one[near[:, 1]]
    np.add.at(same, skip[:, 0], one[skip[:, 1]])
    np.add.at(same, skip[:, 1], one[skip[:, 0]])
    squares = [np.full_like(v, 1e-6) for v in (w, t, u)]
    rows, rng = np.arange(len(x)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), 4096):
            r = rows[at : at + 4096]
            f = np.where(rng.random((len(r), WIDE)) < DROPPED, 0, x[r])  # no feature learns to be the only one
            s = score[r] + w[f].sum(1) + left[r] @ t + right[r] @ t.T + same[r] * u
            p = np.exp(s - s.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - one[r]) / len(r)
            flat = f.ravel()
            gw = np.stack([np.bincount(flat, np.repeat(g[:, c], WIDE), BUCKETS) for c in range(k)], 1) + 1e-6 * w
            gw[0] = 0.0
            for v, grad, square in zip((w, t, u), (gw, left[r].T @ g + g.T @ right[r], (same[r] * g).sum(0)), squares):
                square += grad * grad
                v -= 0.5 * grad / np.sqrt(square)
    return {"w": w.astype(np.float32), "t": t, "u": u}


def _messages(belief, sent, back, a, potential):
    """Log messages out of the ends ``a``, without what came back along the same edge."""
    h = belief[a] - back
    h -= h.max(1, keepdims=True)
    out = np.log(np.exp(h) @ np.exp(potential) + 1e-30)
    return 0.5 * sent + 0.5 * (out - out.max(1, keepdims=True))


def marginals(model: dict, x: np.ndarray, score: np.ndarray, near: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of the tokens by loopy sum-product over neighbours and skip edges."""
    node = score + model["w"][x].sum(1)
    k = node.shape[1]
    t, u = model["t"], np.diag(model["u"])
    groups = [(near[:, 0], near[:, 1], t, t.T), (skip[:, 0], skip[:, 1], u, u)]
    sent = [[np.zeros((len(a), k)), np.zeros((len(a), k))] for a, _, _, _ in groups]
    belief = node.copy()
    for _ in range(rounds):
        sent = [[_messages(belief, there, back, a, p), _messages(belief, back, there, b, q)] for (a, b, p, q), (there, back) in zip(groups, sent)]
        belief = node.copy()
        for (a, b, _, _), (there, back) in zip(groups, sent):
            np.add.at(belief, b, there)
            np.add.at(belief, a, back)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def decided(p: np.ndarray) -> np.ndarray:
    """Label of each token: the most probable kind where the kinds together reach LEAST, else none."""
    return np.where(1 - p[:, 0] > LEAST, p[:, 1:].argmax(1) + 1, 0)


class Field:
    """Tagger and trained potentials of one broadcast."""

    def __init__(self, value) -> None:
        self.tagger = pii.Tagger(value["names"])
        self.model = value["model"]

    def lines(self, texts: list) -> list[tuple[int, int, str]]:
        """(place of the text, line, kind) that a token's most probable label gives."""
        g = Graph(self.tagger, texts)
        if not g.ids:
            return []
        x, score, near, skip, _ = g.arrays()
        best = decided(marginals(self.model, x, score, near, skip))
        return sorted({(g.owner[i], g.line[i], LABELS[best[i]]) for i in np.flatnonzero(best)})


    def spans(self, texts: list) -> list[list[tuple[int, int, str, float]]]:
        """(start, end, kind, marginal) of each text's candidates most of whose tokens the field gives their kind."""
        g = Graph(self.tagger, texts)
        out: list[list] = [[] for _ in texts]
        if not g.ids:
            return out
        x, score, near, skip, _ = g.arrays()
        p = marginals(self.model, x, score, near, skip)
        best = decided(p)
        for d, (found, lo, hi) in g.found.items():
            for a, b, k, _, _ in found:
                inside = [i for i in range(lo, hi) if g.place[i][0] < b and g.place[i][1] > a]
                hits = [i for i in inside if LABELS[best[i]] == k]
                if 2 * len(hits) > len(inside):
                    out[d].append((a, b, k, float(p[hits, LABELS.index(k)].mean())))
        return out


def _shared(documents: DataFrame, person_names: DataFrame, sample: int):
    """Broadcast of the names and of the model, fitted on about ``sample`` documents."""
    names = pii.tagger(person_names)
    filled = documents.where(F.col("text").isNotNull() & (F.col("text") != ""))
    part = min(1.0, sample / max(filled.select("doc_id").count(), 1))
    few = filled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    model = fit(pii.Tagger(names), [r["text"] for r in few.select("doc_id", "text").orderBy("doc_id").collect()])
    return share(documents.sparkSession, {"names": names, "model": model})


def found(documents: DataFrame, person_names: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, line_no, kind) of each line and kind that the field finds; null and empty texts, and rows without a doc_id, have none."""
    shared = _shared(documents, person_names, sample)

    def run(batches):
        field = Lazy.of(shared, Field)
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at : at + 1000]
                ids = part["doc_id"].tolist()
                rows = [(ids[d], no, kind) for d, no, kind in field.lines(part["text"].tolist())]
                yield pd.DataFrame(rows, columns=["doc_id", "line_no", "kind"]).astype({"doc_id": "int64", "line_no": "int32"})

    rows = documents.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text")
    return rows.mapInPandas(run, "doc_id long, line_no int, kind string")


MASKED = "text string, email int, phone_numbers int, id_numbers int, addresses int, names int, ip_address int"


def masked(documents: DataFrame, person_names: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Documents with placeholders in ``text`` and right ``pii_counts``; the other columns stay."""
    shared = _shared(documents, person_names, sample)

    def run(texts: pd.Series) -> pd.DataFrame:
        field = Lazy.of(shared, Field)
        rows = []
        given = texts.tolist()
        parts = [y for at in range(0, len(given), 1000) for y in field.spans(given[at : at + 1000])]
        for x, spans in zip(given, parts):
            y, n = pii.mask(x, spans) if x else (x, dict.fromkeys(pii.KINDS, 0))
            rows.append((y, n["email"], n["phone"], n["id"], n["address"], n["name"], n["ip"]))
        return pd.DataFrame(rows, columns=["text", "email", "phone_numbers", "id_numbers", "addresses", "names", "ip_address"])

    out = documents.withColumn("_m", F.pandas_udf(run, MASKED)("text"))
    counts = F.struct(*[F.col(f"_m.{c}").alias(c) for c in ("email", "phone_numbers", "ip_address", "id_numbers", "addresses", "names")])
    return out.withColumn("text", F.col("_m.text")).withColumn("pii_counts", counts).drop("_m")
