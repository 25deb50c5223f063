"""Fuzzy deduplication: shingles, MinHash, banding, exact Jaccard, components.

Documents with the same set of shingles are one class; everything after that
works on one representative of each class, so copies never multiply into pairs.
Shingles are sorted arrays of 64-bit hashes, made in one Arrow pass over the
texts.  They are larger than the texts, so they are made anew where they are
needed and not kept or shuffled, but for documents that may be in a pair; only
the way by signatures keeps them.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell import lexicons as X
from siftwell.functions import text as T
from siftwell.functions.murmur import signature as murmur_signature
from siftwell.plans.lineage import cut

PRIME = (1 << 31) - 1
MAX_ROUNDS = 60


def _md5_32(s: str) -> int:
    return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)


def _md5_64(s: str) -> int:
    return int(hashlib.md5(s.encode()).hexdigest()[:16], 16)


def coefficients(n: int) -> list[tuple[int, int]]:
    """Multipliers and offsets of the hash family, small enough that products fit in 62 bits."""
    return [(_md5_32(f"a{i}") % ((1 << 30) - 1) + 1, _md5_32(f"b{i}") % (1 << 30)) for i in range(n)]


def gram_strings(text: str | None, n: int) -> set[str]:
    """Distinct n-word shingles of a normalized text; none of fewer words."""
    w = [x for x in text.split(" ") if x] if text else []
    return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}


SPACE = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: rf"\u{int(m[1], 16):04x}", X.WS))


class _Folds(dict):
    """Code points to what normalizing for shingles leaves of them, as the SQL has it."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        if SPACE.fullmatch(c):
            out = " "
        else:
            bare = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.category(x).startswith("M"))
            out = "".join(x for x in unicodedata.normalize("NFC", bare) if unicodedata.category(x) not in ("Cc", "Cf", "Cs", "Co") and x not in X.ASCII_PUNCTUATION)
        self[code] = out
        return out


class _Words(dict):
    """Words to 64 bits of their MD5; forgotten when there are many."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.md5(word.encode()).digest()[:8], "little")
        return h


WORDS_KEPT = 300_000
_folds, _words = _Folds(), _Words()


TEXTS_AT_ONCE = 500


def _word_shingles(texts, n: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct n-word shingles of each text, mixed from the hashes of their words."""
    if len(texts) > TEXTS_AT_ONCE:
        return [g for at in range(0, len(texts), TEXTS_AT_ONCE) for g in _word_shingles(texts[at : at + TEXTS_AT_ONCE], n)]
    pieces = [t.translate(_folds).split() if t else () for t in texts]
    words = np.fromiter((_words[w] for p in pieces for w in p), dtype=np.uint64, count=sum(map(len, pieces)))
    k = max(0, len(words) - n + 1)
    h = np.zeros(k, np.uint64)
    for i in range(n):
        h += words[i : i + k] * np.uint64(_md5_64(f"place {i}") | 1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)  # a fixed odd value that mixes the bits
    h ^= h >> np.uint64(32)
    out, at = [], 0
    for p in pieces:
        out.append(np.unique(h[at : max(at, at + len(p) - n + 1)].view(np.int64)))
        at += len(p)
    return out


def _string_shingles(texts, n: int) -> list[np.ndarray]:
    """Sorted 64 bits of the MD5 of each text's distinct n-word shingles."""
    out = []
    for t in texts:
        w = t.translate(_folds).split() if t else []
        raw = b"".join([hashlib.md5(g.encode()).digest()[:8] for g in {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}])
        out.append(np.unique(np.frombuffer(raw, dtype=">i8").astype(np.int64)))
    return out


def grams(df: DataFrame, n: int = 5, key: str = "doc_id", column: str = "text", md5: bool = False) -> DataFrame:
    """(key, grams): distinct shingles of each document, as sorted 64-bit hashes; with ``md5``, those of the shingles' text, which minhash() takes."""
    of = _string_shingles if md5 else _word_shingles
    run = F.pandas_udf(lambda texts: pd.Series(of(texts.to_list(), n), dtype=object), "array<bigint>")
    return df.select(key, run(F.col(column)).alias("grams"))


@dataclass(frozen=True)
class Shingled:
    """Sets of shingles of the rows of a frame: made from ``column`` wherever they are asked for."""

    frame: DataFrame
    key: str
    column: str
    make: Callable  # of a list of the column's values, the sorted hashes of each

    @property
    def keyed(self) -> str:
        return self.frame.schema[self.key].dataType.simpleString()

    def rows(self, run, schema: str) -> DataFrame:
        """What ``run`` gives of the keys and sets of each batch, those of empty sets and without a key left out, and at last of None."""
        key, column, make = self.key, self.column, self.make

        def batches(frames):
            for d in frames:
                sets = make(d[column].to_list())
                some = np.array([len(g) > 0 for g in sets], dtype=bool) & d[key].notna().to_numpy()
                if some.any():
                    yield d[key][some].reset_index(drop=True), [g for g, x in zip(sets, some) if x]

        return self.frame.where(F.col(key).isNotNull()).select(key, column).mapInPandas(lambda frames: run(batches(frames)), schema)

    def grams(self) -> DataFrame:
        """(key, grams) of the sets that are not empty."""
        key = self.key
        return self.rows(lambda batches: (pd.DataFrame({key: k, "grams": pd.Series(g, dtype=object)}) for k, g in batches), f"`{key}` {self.keyed}, grams array<bigint>")

    def where(self, condition: Column) -> Shingled:
        return replace(self, frame=self.frame.where(condition))


def shingles(df: DataFrame, n: int = 5, key: str = "doc_id", column: str = "text", md5: bool = False) -> Shingled:
    """The sets of grams()."""
    of = _string_shingles if md5 else _word_shingles
    return Shingled(df, key, column, lambda texts: of(texts, n))


def made(df: DataFrame, key: str) -> Shingled:
    """The sets in the column ``grams``."""
    return Shingled(df, key, "grams", lambda sets: [np.asarray(() if g is None else g, dtype=np.int64) for g in sets])


BUCKETS = 1 << 22  # of the counts by which shingles are ordered
PIECE = 1 << 16


def survey(sets: Shingled) -> DataFrame:
    """One pass over the sets, kept: (key, a, b, size) with a 128-bit hash of each, and the counts of buckets of shingles in pieces (piece, counts)."""
    key = sets.key

    def run(batches):
        total = np.zeros(BUCKETS, np.uint32)
        for keys, grams in batches:
            raw = np.frombuffer(b"".join(hashlib.md5(g.tobytes()).digest() for g in grams), dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({key: keys, "a": raw[:, 0], "b": raw[:, 1], "size": [len(g) for g in grams], "piece": None, "counts": None})
            total += np.bincount(_bucket(np.concatenate(grams)), minlength=BUCKETS).astype(np.uint32)
        at = [i for i in range(0, BUCKETS, PIECE) if total[i : i + PIECE].any()]
        yield pd.DataFrame({key: None, "a": None, "b": None, "size": None, "piece": [i // PIECE for i in at], "counts": [zlib.compress(total[i : i + PIECE].tobytes(), 1) for i in at]})

    return cut(sets.rows(run, f"`{key}` {sets.keyed}, a bigint, b bigint, size int, piece int, counts binary"))


def _bucket(g: np.ndarray) -> np.ndarray:
    return (g.view(np.uint64) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)


def bucket_counts(surveyed: DataFrame) -> np.ndarray:
    """How many shingles fall into each bucket, up to 65,535: a table of fixed size."""

    def run(d: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), dtype=np.uint32).astype(np.int64) for x in d["counts"])
        return pd.DataFrame({"piece": d["piece"].iloc[:1], "counts": [zlib.compress(np.minimum(total, 65_535).astype(np.uint16).tobytes(), 1)]})

    out = np.zeros(BUCKETS, np.uint16)
    for r in surveyed.where("piece is not null").select("piece", "counts").groupBy("piece").applyInPandas(run, "piece int, counts binary").toLocalIterator():
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = np.frombuffer(zlib.decompress(r.counts), dtype=np.uint16)
    return out


def memberships(surveyed: DataFrame, key: str = "doc_id", *more: str) -> DataFrame:
    """(key, rep): the smallest key with the same set of shingles."""
    some = surveyed.where("a is not null").select(key, "a", "b", *more)
    return some.join(some.groupBy("a", "b").agg(F.min(key).alias("rep")), ["a", "b"]).select(key, "rep", *more)


def classes(shingled: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Representatives (rep, grams) of equal shingle sets, and membership (key, rep); empty sets are left out.

    The shingles are computed once and kept; the arrays are shuffled once.
    """
    some = cut(shingled.where(F.size("grams") > 0).withColumn("_s", F.sha2(F.array_join("grams", ","), 256)))
    reps = some.groupBy("_s").agg(F.min(key).alias("rep"))
    members = some.select(key, "_s").join(reps, "_s").select(key, "rep")
    return some.join(reps.select(F.col("rep").alias(key)), key, "left_semi").select(F.col(key).alias("rep"), "grams"), members


def minhash(shingled: DataFrame, num_hashes: int = 128, key: str = "doc_id") -> DataFrame:
    """(key, signature): minima of the hash family over the shingles' first 32 bits; none without shingles."""
    a = np.array([x for x, _ in coefficients(num_hashes)], dtype=np.int64)
    b = np.array([y for _, y in coefficients(num_hashes)], dtype=np.int64)

    def run(hashes: pd.Series) -> pd.Series:
        out = []
        for h in hashes:
            x = (np.asarray(h, dtype=np.int64).view(np.uint64) >> np.uint64(32)).astype(np.int64)
            best = np.full(len(a), PRIME, dtype=np.int64)
            for at in range(0, len(x), 4096):
                best = np.minimum(best, ((x[at : at + 4096, None] * a + b) % PRIME).min(0))
            out.append(best)
        return pd.Series(out, dtype=object)

    return shingled.where(F.size("grams") > 0).select(key, F.pandas_udf(run, "array<bigint>")("grams").alias("signature"))


def murmur_minhash(df: DataFrame, num_hashes: int = 32, n: int = 3, key: str = "doc_id", column: str = "text", literal: bool = False) -> DataFrame:
    """(key, signature): the smallest MurmurHash3 of any shingle for each seed, as stored signatures have it."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([murmur_signature(sorted(g), num_hashes) if (g := gram_strings(t, n)) else None for t in texts], dtype=object)

    rows = df.select(key, F.pandas_udf(run, "array<bigint>")(T.normalize_for_grams(F.col(column), literal)).alias("signature"))
    return rows.where(F.col("signature").isNotNull())


def bands(signatures: DataFrame, num_bands: int = 16, num_hashes: int = 128, key: str = "doc_id") -> DataFrame:
    """(key, band_no, band): the signature in chunks; the band number belongs to the key of a bucket."""
    if num_bands < 1 or num_hashes % num_bands:
        raise ValueError("the number of hashes must be a multiple of the number of bands")
    size = num_hashes // num_bands
    parts = F.transform(F.sequence(F.lit(0), F.lit(num_bands - 1)), lambda i: F.array_join(F.slice("signature", i * size + 1, size), ","))
    return signatures.select(key, F.posexplode(parts).alias("band_no", "band"))


def candidates(banded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(src, dst) with src < dst that share a bucket.  To be given representatives, not copies."""
    hashed = banded.select(F.xxhash64("band_no", "band").alias("bucket"), key)
    counted = hashed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    shared = hashed.join(counted, "bucket", "left_semi")
    return shared.select("bucket", F.col(key).alias("src")).join(shared.select("bucket", F.col(key).alias("dst")), "bucket").where("src < dst").select("src", "dst").distinct()


def verify(pairs: DataFrame, shingled: DataFrame, tenths: int = 8, key: str = "rep") -> DataFrame:
    """(src, dst, inter, total) of the pairs whose Jaccard similarity is at least tenths / 10."""
    g = shingled.select(F.col(key).alias("src"), F.col("grams").alias("ga"))
    h = shingled.select(F.col(key).alias("dst"), F.col("grams").alias("gb"))
    both = pairs.join(g, "src").join(h, "dst")
    both = both.withColumn("inter", F.size(F.array_intersect("ga", "gb")).cast("bigint"))
    both = both.withColumn("total", (F.size("ga") + F.size("gb")).cast("bigint") - F.col("inter"))
    return both.where(F.col("inter") * 10 >= F.col("total") * tenths).select("src", "dst", "inter", "total")


BITS, BITMAP = 1 << 24, 1 << 15


def hinted(ids: DataFrame) -> Column:
    """A filter of fixed size for the only column of ``ids``: true for all of its values and for few others."""
    (name,) = ids.columns
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    found = ids.select(bit(F.col(name)).alias("bit")).distinct().select(F.floor(F.col("bit") / BITMAP).alias("at"), (F.col("bit") % BITMAP).alias("bit"))
    bits = np.zeros(BITS // 8, np.uint8)
    for r in found.groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        bits[r["at"] * BITMAP // 8 : (r["at"] + 1) * BITMAP // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    sent = ids.sparkSession.sparkContext.broadcast(bits)

    def run(at: pd.Series) -> pd.Series:
        at = at.to_numpy()
        return pd.Series((sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    test = F.pandas_udf(run, "boolean")
    return test(bit(F.col(name)))


PAIRS_AT_ONCE = 500_000


def shared_prefixes(sets: Shingled, reps: DataFrame | None, counts: np.ndarray, tenths: int) -> DataFrame:
    """(src, dst, na, nb, shared): pairs whose sizes allow the similarity, and how many shingles of their prefixes they share.

    Shingles are ordered by how full their bucket is; two sets that are similar
    enough must share one among their first |x| - ceil(t |x|) + 1.
    """
    sent = sets.frame.sparkSession.sparkContext.broadcast(counts)
    key, keyed = sets.key, sets.keyed

    def firsts(batches):
        for keys, grams in batches:
            out = []
            for g in grams:
                order = sent.value[_bucket(g)].astype(np.uint64) << np.uint64(48) | g.view(np.uint64) >> np.uint64(16)
                first = np.argsort(order, kind="stable")[: len(g) + (-len(g) * tenths // 10) + 1]
                out.append(g[first[order[first] >> np.uint64(48) > 1]])  # alone in its bucket, a shingle is of one set only
            yield pd.DataFrame({key: keys, "n": np.array([len(g) for g in grams], dtype=np.int32), "first": pd.Series(out, dtype=object)})

    prefix = sets.rows(firsts, f"`{key}` {keyed}, n int, first array<bigint>")
    if reps is not None:
        prefix = prefix.join(reps, key, "left_semi")
    rows = prefix.select(F.explode("first").alias("gram"), F.col(key).alias("rep"), "n").repartition("gram").sortWithinPartitions("gram")

    def pairs(batches):
        held = None
        for d in batches:
            d = d if held is None else pd.concat([held, d], ignore_index=True)
            end = int(np.searchsorted(d["gram"].to_numpy(), d["gram"].iloc[-1]))  # the last shingle may go on in the next batch
            yield from paired(d.iloc[:end])
            held = d.iloc[end:]
        if held is not None:
            yield from paired(held)

    def paired(d):
        gram, rep, n = d["gram"].to_numpy(), d["rep"].to_numpy(), d["n"].to_numpy().astype(np.int64)
        i = np.arange(len(gram))
        step, found, many = 0, [], 0
        while True:
            step += 1
            i = i[i + step < len(gram)]
            i = i[gram[i] == gram[i + step]]
            if not len(i):
                break
            j = i + step
            fits = (n[i] * 10 >= n[j] * tenths) & (n[j] * 10 >= n[i] * tenths) & (rep[i] != rep[j])
            found.append((i[fits], j[fits]))
            many += int(fits.sum())
            if many >= PAIRS_AT_ONCE:
                yield listed(rep, n, found)
                found, many = [], 0
        if many:
            yield listed(rep, n, found)

    def listed(rep, n, found):
        i, j = (np.concatenate(x) for x in zip(*found))
        turned = rep[i] > rep[j]
        i, j = np.where(turned, j, i), np.where(turned, i, j)
        return pd.DataFrame({"src": rep[i], "dst": rep[j], "na": n[i].astype(np.int32), "nb": n[j].astype(np.int32)})

    return rows.mapInPandas(pairs, f"src {keyed}, dst {keyed}, na int, nb int").groupBy("src", "dst", "na", "nb").agg(F.count("*").alias("shared"))


def pairs_of(sets: Shingled, reps: DataFrame | None, surveyed: DataFrame, tenths: int) -> DataFrame:
    """similar_pairs() of the sets whose keys are in ``reps``, or of all; ``surveyed`` is their survey()."""
    key = sets.key
    found = shared_prefixes(sets, reps, bucket_counts(surveyed), tenths)
    # One of the two sets holds all else that they share behind its prefix: ceil(t |x|) - 1 shingles at most.
    rest = F.ceil(F.greatest("na", "nb") * tenths / 10) - 1
    able = found.where((F.col("shared") + rest) * (10 + tenths) >= (F.col("na") + F.col("nb")).cast("bigint") * tenths)
    able = cut(able.select("src", "dst").distinct())
    ends = able.select(F.col("src").alias(key)).union(able.select(F.col("dst").alias(key)))
    return verify(able, sets.where(hinted(ends)).grams(), tenths, key)


def similar_pairs(reps: DataFrame, tenths: int = 8) -> DataFrame:
    """(src, dst, inter, total) of every pair of (rep, grams) at or above the similarity: an exact join on rare-shingle prefixes."""
    sets = made(reps, "rep")
    return pairs_of(sets, None, survey(sets), tenths)


def near_pairs(df: DataFrame, n: int = 5, tenths: int = 8, key: str = "doc_id", column: str = "text") -> tuple[DataFrame, DataFrame]:
    """similar_pairs() of the representatives of the documents' classes, and membership (key, rep)."""
    sets = shingles(df, n, key, column)
    surveyed = survey(sets)
    members = memberships(surveyed, key)
    return pairs_of(sets, members.select(F.col("rep").alias(key)).distinct(), surveyed, tenths), members


def all_pairs(df: DataFrame, n: int = 5, tenths: int = 8, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(src, dst, inter, total) of every pair of documents at or above the similarity, copies with copies too."""
    sets = shingles(df, n, key, column)
    surveyed = survey(sets)
    members = cut(memberships(surveyed, key, "size"))
    pairs = pairs_of(sets, members.select(F.col("rep").alias(key)).distinct(), surveyed, tenths)
    several = members.groupBy("rep").agg(F.count("*").alias("copies")).where("copies > 1").select("rep")
    copied = members.join(several, "rep", "left_semi")
    size = F.col("size").cast("bigint")
    twins = copied.select("rep", F.col(key).alias("src"), "size").join(copied.select("rep", F.col(key).alias("dst")), "rep").where("src < dst").select("src", "dst", size.alias("inter"), size.alias("total"))
    a = members.select(F.col("rep").alias("src"), F.col(key).alias("x"))
    b = members.select(F.col("rep").alias("dst"), F.col(key).alias("y"))
    others = pairs.join(a, "src").join(b, "dst").select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst"), "inter", "total")
    return others.union(twins)


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every id in an edge: the smallest id of its component.

    Smaller labels spread along edges, and labels jump to the label of their
    label, until nothing changes.
    """
    e = cut(edges.select("src", "dst").where("src <> dst"))  # both directions read it
    both = cut(e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    label = cut(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("label")).select(F.col("src").alias("id"), "label"))
    if label.isEmpty():
        return label
    for _ in range(MAX_ROUNDS):
        near = both.join(label.select(F.col("id").alias("dst"), F.col("label").alias("other")), "dst").groupBy("src").agg(F.min("other").alias("other"))
        step = label.join(near.withColumnRenamed("src", "id"), "id").select("id", F.least("label", "other").alias("new"), "label")
        jump = step.select(F.col("id").alias("new"), F.col("new").alias("far"))
        new = cut(step.join(jump, "new", "left").select("id", F.coalesce(F.least("new", "far"), "new").alias("label"), F.col("label").alias("old")))
        changed = not new.where("label <> old").isEmpty()
        label = new.select("id", "label")
        if not changed:
            return label
    raise RuntimeError("labels did not settle")


def clusters(df: DataFrame, n: int = 5, tenths: int = 8, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, cluster) of every document that is a near duplicate of another: the smallest key of its cluster.

    Links come from the exact join, so that none is lost to an unlucky signature.
    """
    pairs, members = near_pairs(df, n, tenths, key, column)
    label = components(pairs).withColumnRenamed("id", "rep")
    joined = members.join(label, "rep", "left").select(key, F.coalesce("label", "rep").alias("cluster"))
    several = joined.groupBy("cluster").count().where("count > 1").select("cluster")
    return joined.join(several, "cluster", "left_semi").select(key, "cluster")


def lsh_clusters(df: DataFrame, n: int = 5, num_hashes: int = 128, num_bands: int = 16, tenths: int = 8, key: str = "doc_id", column: str = "text") -> DataFrame:
    """clusters() with links from shared buckets only: cheaper, and a link of similarity s is lost with (1 - s^rows)^bands."""
    reps, members = classes(grams(df, n, key, column, md5=True), key)
    pairs = verify(candidates(bands(minhash(reps, num_hashes, "rep"), num_bands, num_hashes, "rep"), "rep"), reps, tenths)
    label = components(pairs).withColumnRenamed("id", "rep")
    joined = members.join(label, "rep", "left").select(key, F.coalesce("label", "rep").alias("cluster"))
    several = joined.groupBy("cluster").count().where("count > 1").select("cluster")
    return joined.join(several, "cluster", "left_semi").select(key, "cluster")


def survivors(df: DataFrame, key: str = "doc_id", **kw) -> DataFrame:
    """Documents that are in no cluster, or the first of theirs."""
    gone = clusters(df, key=key, **kw).where(F.col(key) != F.col("cluster")).select(key)
    return df.join(gone, key, "left_anti")
