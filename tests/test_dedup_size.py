import itertools
import random

import duckdb
import pytest

from siftwell.operators import dedup


def kept_columns(monkeypatch):
    kept, cut = [], dedup.cut
    monkeypatch.setattr(dedup, "cut", lambda frame: kept.append(dict(frame.dtypes)) or cut(frame))
    return kept


def near_copies(rng, groups, copies):
    bases = [[f"{rng.choice('abcdefgh')}{rng.randrange(40)}" for _ in range(rng.randrange(20, 90))] for _ in range(groups)]
    return [" ".join(x if rng.random() > 0.03 else "other" for x in b) for b in bases for _ in range(copies)]


def test_clusters_keep_no_shingles(spark, monkeypatch):
    kept = kept_columns(monkeypatch)
    df = spark.createDataFrame(list(enumerate(near_copies(random.Random(1), 6, 3))), "doc_id long, text string")
    assert dedup.clusters(df, 2, 4).count()
    assert kept and not [c for columns in kept for c in columns.items() if "array" in c[1]]


@pytest.mark.parametrize("tenths", (3, 4, 8, 10))
def test_pairs_of_all_similarities_equal_brute_force(spark, tenths):
    rng = random.Random(tenths)
    df = spark.createDataFrame(list(enumerate(near_copies(rng, 8, 5))), "doc_id long, text string")
    reps, _ = dedup.classes(dedup.grams(df, 2))
    sets = {r.rep: set(r.grams) for r in reps.collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 10 * len(sets[a] & sets[b]) >= tenths * len(sets[a] | sets[b])}
    got = {(r.src, r.dst, r.inter, r.total) for r in dedup.near_pairs(df, 2, tenths)[0].collect()}
    assert got == {(a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a, b in want} and (want or tenths == 10)


def test_jaccard_pairs_lists_copies(spark, tmp_path):
    from siftwell.plans import catalog

    w = [f"w{i}" for i in range(100)]
    texts = [" ".join(w), " ".join(w) + "!", " ".join(w[3:]), " ".join(w[3:]), "one two three four five", "One two three four five", "too short", "too short"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {(0, 1, 96, 96), (2, 3, 93, 93), (4, 5, 1, 1)} | {(a, b, 93, 96) for a in (0, 1) for b in (2, 3)}
    assert sorted(tuple(r) for r in catalog.QUERIES["jaccard_pairs"](spark, str(tmp_path)).collect()) == sorted(want)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(catalog.SQL["jaccard_pairs"]).fetchall()) == sorted(want)


def test_links_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for d in batches:
            made.add(len(d))
            yield d

    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "src long, dst long").mapInPandas(rows, "src long, dst long")
    assert {(r.id, r.label) for r in dedup.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}
    assert made.value == 3


def test_kept_lines_split_a_text_once(spark):
    from siftwell.operators import lines

    df = spark.createDataFrame([(0, "a\nb\nc\nb\n\nd"), (1, "c\ne"), (2, None)], "doc_id long, text string")
    out = lines.exact_line_dedup(df)
    assert {r.doc_id: r.text for r in out.collect()} == {0: "a\n\nd", 1: "e", 2: ""}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at(lambda" in plan


def test_survivors_keep_no_shingles(spark, monkeypatch):
    kept = kept_columns(monkeypatch)
    df = spark.createDataFrame(list(enumerate(near_copies(random.Random(2), 4, 3))), "doc_id long, text string")
    assert dedup.survivors(df, n=2, tenths=4).count() < 12
    assert kept and not [c for columns in kept for c in columns.items() if "array" in c[1]]
