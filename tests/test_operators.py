import gzip
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.config import Stage1Config
from siftwell.functions import bpe, murmur
from siftwell.functions import text as T
from siftwell.operators import classify, dedup, lines, quality, tokens
from siftwell.plans import catalog, pipeline
from siftwell.sources import files, text_files, warc


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_line_rules(spark):
    bad = {
        "words": "too short", "long": "word " * 120, "blacklist": "please read more about the whole thing", "tag": "a line with a <b> tag in it", "link": "see https://x.example for all of it",
        "marks": "a, b. c! d? e; f: g", "digits": "12345 67890 12345 in a line here", "foreign": "äöü äöü äöü äöü äöü äöü",
    }
    df = docs(spark, *bad.values())
    for i, (name, line) in enumerate(bad.items()):
        row = df.where(F.col("doc_id") == i).select(*[r.alias(k) for k, r in lines.line_rules(F.col("text")).items()]).first()
        assert row[name], (name, line)
    assert docs(spark, "This is a good line of plain text").select(lines.filter_lines(F.col("text"))).first()[0] == "This is a good line of plain text"


def test_exact_line_dedup_removes_all_copies(spark):
    df = docs(spark, "same\nonly one", "same", "", None, "  same \nother")
    assert {r.doc_id: r.text for r in lines.exact_line_dedup(df).collect()} == {0: "only one", 1: "", 2: "", 3: "", 4: "other"}


def test_gopher_rules(spark):
    good = "the quick brown fox is and that have with to of be " * 6
    rows = docs(spark, good, "too short", "the and " + "# " * 60, (good + "\n") + "more to read...\n" * 3, "", None)
    kept = {r.doc_id for r in quality.gopher_filter(rows).collect()}
    assert kept == {0}


def test_clusters_are_idempotent_and_whole(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base + " extra"
    df = docs(spark, base, near, base, "something else entirely that is long enough to count", "", None, "two words")
    found = {r.doc_id: r.cluster for r in dedup.clusters(df).collect()}
    assert found == {0: 0, 1: 0, 2: 0}
    left = dedup.survivors(df)
    assert {r.doc_id for r in left.collect()} == {0, 3, 4, 5, 6}
    assert dedup.survivors(left).count() == left.count()


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "src long, dst long")
    labels = {r.id: r.label for r in dedup.components(edges).collect()}
    assert all(labels[i] == 0 for i in range(41)) and labels[101] == 100


def test_similar_pairs_equal_brute_force(spark):
    import itertools
    import random

    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(40)] for _ in range(6)]
    texts = [" ".join(x if rng.random() > 0.02 else "zz" for x in b) for b in base for _ in range(4)]
    df = docs(spark, *texts)
    reps, _ = dedup.classes(dedup.grams(df, 2))
    sets = {r.rep: set(r.grams) for r in reps.collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    assert want and {(r.src, r.dst) for r in dedup.similar_pairs(reps).collect()} == want


def test_band_count_must_divide(spark):
    with pytest.raises(ValueError):
        dedup.bands(spark.createDataFrame([(1, [1, 2, 3])], "doc_id long, signature array<bigint>"), 2, 3)


def test_naive_bayes(spark):
    df = docs(spark, "good fine words", "bad evil words", "good words here", "evil things", None, "")
    labels = spark.createDataFrame([(0, "good"), (1, "bad")], "doc_id long, label string")
    out = {r.doc_id: r.label for r in classify.classify(df, labels).collect()}
    assert out == {0: "good", 1: "bad", 2: "good", 3: "bad"}


def test_token_file_round_trip(spark, tmp_path):
    df = docs(spark, "Hello world", "two", None, "", "zwölf Boxkämpfer 😀").repartition(3)
    stream = tokens.token_stream(df)
    want = [x for r in stream.orderBy("doc_id").collect() for x in r.ids]
    tokens.write_packed(stream, str(tmp_path))
    tokens.write_packed(stream.where("doc_id < 2"), str(tmp_path / "x"))
    tokens.write_packed(stream, str(tmp_path / "x"))  # the files of the earlier write count no more
    got = [x for r in tokens.read_packed(spark, f"file://{tmp_path}").orderBy("part").collect() for x in r.ids]
    assert got == want == [x for r in tokens.read_packed(spark, str(tmp_path / "x")).orderBy("part").collect() for x in r.ids]
    parts = tokens.packed_parts(spark, str(tmp_path)).orderBy("part").collect()
    assert [r.start for r in parts] == [sum(p.tokens for p in parts[:i]) for i in range(len(parts))]
    for r in tokens.random_batches(spark, str(tmp_path), 2, 5, 4, 7).collect():
        assert r.x == want[r.start : r.start + 4] and r.y == want[r.start + 1 : r.start + 5]
    text = bpe.encoding().decode([t for t in want if t != bpe.EOS])
    assert text == "Hello world\ntwo\n\nzwölf Boxkämpfer 😀\n"
    x, y = tokens.batch(got, 3, 4, 1)
    assert (x[:, 1:] == y[:, :-1]).all()


def test_token_counts_equal_encoding():
    enc = bpe.encoding()
    for t in ("", "a", "  two   blanks \n\n\n and tabs\t\t", "don't we'll 12345 ½ ß", "日本語 текст"):
        assert bpe.count(t) == len(enc.encode_ordinary(t))


def test_windows_cover_the_stream(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate((5, 0, 700, 3, 511))], "doc_id long, n long")
    w = tokens.windows(tokens.offsets(df, "n"), "n", 512).collect()
    assert sum(r.to_pos - r.from_pos for r in w) == 1219
    per = {}
    for r in w:
        per[r.window_id] = per.get(r.window_id, 0) + r.to_pos - r.from_pos
    assert per == {0: 512, 1: 512, 2: 195}


def test_offsets_of_any_keys(spark):
    rows = [(-(1 << 63), 3), ((1 << 63) - 1, 4), (0, 5), (7, 0), (8, 1)] + [(10**6 + i, 2) for i in range(300)]
    out = tokens.offsets(spark.createDataFrame(rows, "doc_id long, n long"), "n").collect()
    at = 0
    for r in sorted(out, key=lambda r: r.doc_id):
        assert r.start == at
        at += r.n
    assert at == sum(n for _, n in rows)


def test_murmur_signature(spark):
    # Published hashes of MurmurHash3 (x86, 32 bits).
    for data, seed, want in ((b"", 0, 0), (b"", 1, 0x514E28B7), (b"test", 0, 0xBA6BD213), (b"Hello, world!", 0, 0xC0363E43), (b"The quick brown fox jumps over the lazy dog", 0x9747B28C, 0x2FA826CD)):
        assert murmur.murmur3(data, seed) == want
    words = "one two three four five six".split()
    want = [min(murmur.murmur3(" ".join(words[i : i + 3]).encode(), seed) for i in range(4)) for seed in range(8)]
    out = dedup.murmur_minhash(docs(spark, " ".join(words), "One, TWO three  four five six", "too short", None, ""), 8).collect()
    assert [r.signature for r in out] == [want, want]


LICENCE = """You may use, copy, change and share this little program and its papers without paying, as long as this
note and the names above it stay in every copy you pass on. The program comes as it is, without any promise that it
fits a purpose or is free of faults, and the people who wrote it answer for no loss that comes from using it,
whether the loss was foreseen or not, in any land and under any law that may apply to such a matter."""


def test_wrapping_and_names_do_not_part_copies(spark):
    other = "Made by Somebody Else in a shed\n\n" + " ".join(LICENCE.split()[:40]) + "\n" + "\n".join(" ".join(LICENCE.split()[i : i + 7]) for i in range(40, 90, 7))
    third = " ".join(f"word{i} and" for i in range(80))
    df = docs(spark, "Made by Anybody\n" + LICENCE, other, third)
    assert {r.doc_id: r.cluster for r in dedup.clusters(df).collect()} == {0: 0, 1: 0}
    assert {r.doc_id for r in dedup.survivors(df).collect()} == {0, 2}
    assert {r.doc_id: r.cluster for r in dedup.lsh_clusters(df, 5, 500, 50).collect()} == {0: 0, 1: 0}


def test_chains_are_one_cluster(spark):
    w = [f"w{i}" for i in range(130)]
    df = docs(spark, *[" ".join(w[i : i + 100]) for i in (0, 9, 18, 27)], "a word or two that stand for themselves alone")
    pairs = {(r.src, r.dst) for r in dedup.similar_pairs(dedup.classes(dedup.grams(df))[0]).collect()}
    assert pairs == {(0, 1), (1, 2), (2, 3)}
    assert {r.doc_id: r.cluster for r in dedup.clusters(df).collect()} == {0: 0, 1: 0, 2: 0, 3: 0}


def test_addresses_of_files(tmp_path):
    for name in ("a.wet", "b.wet", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "folder").mkdir()
    assert files.find_files(str(tmp_path)) == [f"{tmp_path}/{x}" for x in ("a.wet", "b.wet", "c.txt")]
    assert files.find_files(f"file://{tmp_path}/*.wet") == [f"file://{tmp_path}/{x}" for x in ("a.wet", "b.wet")]
    assert files.find_files(f"file://{tmp_path}/c.txt") == [f"file://{tmp_path}/c.txt"] and files.find_files(f"{tmp_path}/none/*") == []
    with files.open_file(f"file://{tmp_path}/new/d.bin", write=True) as f:
        f.write(b"0123")
    with files.open_file(f"{tmp_path}/new/d.bin", at=2) as f:
        assert f.read() == b"23"


def test_warc_audit(spark, tmp_path):
    rec = b"WARC/1.0\r\nWARC-Type: conversion\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (tmp_path / "a.wet").write_bytes(rec * 3)
    (tmp_path / "b.wet.gz").write_bytes(gzip.compress(rec * 2)[:-12])
    (tmp_path / "c.wet.gz").write_bytes(b"\x1f\x8bgarbage that is no stream")
    (tmp_path / "d.wet").write_bytes(rec + b"no record\r\n")
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path))
    got = {os.path.basename(r.source_file): (r.records, r.broken) for r in warc.audit(rows).collect()}
    assert got["a.wet"] == (3, 0) and got["b.wet.gz"][1] == 1 and got["c.wet.gz"] == (0, 1) and got["d.wet"] == (1, 1)
    ids = [r.record_no for r in rows.where("source_file like '%a.wet'").collect()]
    assert sorted(ids) == [1, 2, 3]
    kept = spark.createDataFrame([(f"{tmp_path}/a.wet",)] * 2, "source_file string")
    assert {os.path.basename(r.source_file): r.kept for r in warc.audit(rows, kept).collect()}["a.wet"] in (0, 2)


def test_warc(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hi</p>"
    rec = lambda kind, b: b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Target-URI: http://a.example/\r\nContent-Length: " + str(len(b)).encode() + b"\r\n\r\n" + b + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(rec(b"request", b"x") + rec(b"response", body)))
    (tmp_path / "b.wet").write_bytes(rec(b"conversion", "täxt".encode()) + b"WARC/1.0\r\nContent-Length: 99\r\n\r\nbroken")
    warc.register(spark)
    rows = {r.record_type: r for r in spark.read.format("warc").load(str(tmp_path)).collect()}
    assert rows["response"].content == b"<p>hi</p>" and rows["response"].http_content_type == "text/html"
    assert bytes(rows["conversion"].content).decode() == "täxt" and set(rows) == {"response", "conversion", "error"}


def test_text_files(spark, tmp_path):
    p = str(tmp_path / "in.jsonl")
    with open(p, "w") as f:
        f.write('{"text": "a \\n b"}\nnot json\n')
    good, bad = text_files.positive_lines(spark, p)
    assert [r.value for r in good.collect()] == ["__label__good a b"] and bad.count() == 1
    out = str(tmp_path / "out")
    text_files.write_lines(docs(spark, "x\ny", None), out)
    assert [r.value for r in spark.read.text(out).collect()] == ["x y"]
    assert spark.createDataFrame([("__label__toxic",)], "l string").select(text_files.read_label(F.col("l"))).first()[0] == "toxic"


@pytest.fixture(scope="module")
def models(spark, sf):
    return catalog._models(spark, sf)


def test_stage1_keeps_what_the_steps_say(spark, sf, models):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    report = pipeline.retention(d, "lang", models=models).agg(*[F.sum(f"after_{x}").alias(x) for x in pipeline.STEPS]).first()
    assert pipeline.stage1(d, models=models).count() == report.not_empty > 0
    assert d.count() >= report.not_blank > report.language > report.gopher > report.super_quality


def test_a_missing_classifier_is_no_silent_pass(spark, sf):
    with pytest.raises(ValueError, match="language"):
        pipeline.stage1(spark.read.parquet(f"{sf}/documents.parquet"))


def test_each_classifier_can_drop_a_document(spark, models):
    good = "the quick brown fox is and that have with to of be report study " * 6
    df = docs(spark, good)
    for name in ("language", "nsfw", "toxicity", "quality"):
        labels = {"language": "en", "quality": "good"}.get(name, "safe")
        for label, kept in ((labels, 1), ("other", 0)):
            m = classify.Model([label], np.zeros((1, 64)), np.zeros(1), classify.Features(buckets=64))
            off = {f"enable_{x}": x == name for x in ("language", "nsfw", "toxicity", "quality")}
            config = Stage1Config(enable_super_quality=False, min_words=1, max_chars_per_line=10_000, **off)
            assert pipeline.stage1(df, config, pipeline.Models(**{name: m})).count() == kept, (name, label)


def test_stream_equals_batch(spark, sf, tmp_path, models):
    from siftwell.streaming import incremental

    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "confidence")
    d.write.parquet(str(tmp_path / "in"))
    s = incremental.clean_stream(incremental.read_landing(spark, str(tmp_path / "in"), d.schema), models=models)
    incremental.start(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == pipeline.stage1(d, models=models).count()


def test_stream_drops_copies(spark, sf, tmp_path):
    from siftwell.streaming import incremental

    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, text string").withColumn("at", F.lit("2020-01-01").cast("timestamp"))
    d.write.parquet(str(tmp_path / "in"))
    s = incremental.drop_copies(incremental.read_landing(spark, str(tmp_path / "in"), d.schema), "at")
    incremental.start(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_held_out_languages(spark, sf):
    rows = catalog.QUERIES["langid_held_out"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r.right for r in rows) >= 0.8 * sum(r.docs for r in rows)  # about a tenth of the labels are wrong


def test_json_and_path_lists(spark, tmp_path):
    df = spark.createDataFrame([("t", "en", 0.51239, "http://a.example/", (1, 2, 3))], text_files.RECORD)
    text_files.write_jsonl(df, str(tmp_path / "j"))
    with open(tmp_path / "j" / "x.json", "w") as f:
        f.write("broken\n")
    rows = text_files.read_jsonl(spark, str(tmp_path / "j")).collect()
    assert sorted((r.text or "", r._corrupt or "") for r in rows) == [("", "broken"), ("t", "")] and max(r.confidence or 0 for r in rows) == 0.5124
    (tmp_path / "index").write_text("a\nb\n\nc\n")
    some = [r.path for r in text_files.path_list(spark, str(tmp_path / "index"), 2, "s3://x/").collect()]
    assert len(some) == 2 and set(some) < {"s3://x/a", "s3://x/b", "s3://x/c"} and some == [r.path for r in text_files.path_list(spark, str(tmp_path / "index"), 2, "s3://x/").collect()]


def test_empty_tables(spark):
    e = docs(spark).limit(0)
    assert lines.exact_line_dedup(e).count() == dedup.clusters(e).count() == tokens.offsets(e.withColumn("n", F.lit(1)), "n").count() == 0
    assert quality.gopher_filter(e).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    want = con.execute(catalog.SQL[name]).df()
    got = catalog.QUERIES[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    key = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert sorted(got.columns) == cols and key(got) == key(want)


def test_entry_does_not_need_llm():
    import siftwell

    root = os.path.dirname(siftwell.__file__ or "") or list(siftwell.__path__)[0]
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                assert "siftwell.llm" not in open(os.path.join(folder, f)).read(), f
