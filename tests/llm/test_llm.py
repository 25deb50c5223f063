import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import abuse, boilerplate, chain, components, languages, mixing, packing, pii, residue, site_lines, statistics, structure
from siftwell.llm import queries as Q

DOCS = "doc_id long, text string, url string, lang string, source string, extra int, count long, site string"


def docs(spark, rows):
    """Rows of (text, url, lang, source), with further columns whose names clash with those in use."""
    rows = [(i, *(list(r) + [None] * (4 - len(r))), 1, 2, "x") for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, DOCS)


PROSE = "The harbour needed a new bridge, and the council asked the engineers for a plan. "


def page(i, body):
    return (i, "https://www.a.example:80/p", f"<html><body><nav><ul><li>Home | Shop | About</li></ul></nav><article><h1>Title {'abcdefg'[i % 7]}</h1><p>{body}</article><footer>© 2020 Some Site. All rights reserved.</footer></body></html>")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [page(i, PROSE + f"It took weeks {'one two three four five six seven'.split()[i % 7]}.") for i in range(8)] + [(9, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture(scope="module")
def small(spark):
    return docs(
        spark,
        [
            ("Home | Shop | About\nA bridge at last\n" + PROSE * 2 + "\n\n© 2022 Some Site. All rights reserved.", "http://A.example/x", "en", "web"),
            (None, None, None, None), ("", "http://a.example/y", "xx", "web"),
            ("Access denied. You do not have permission to open this page.", "http://a.example/z", "en", "web"),
            ("{{headline}} - %%city%%\nPosted in [[PRODUCT]] by {{name}}", None, "en", None),
            ("\n".join(f"{i};harbour;{i}.5;{i + 2};{i}" for i in range(200, 230)), "http://b.example/", "en", "tab"),
            (PROSE * 1500, "http://b.example/long", "en", "web"),
        ],
    )


def test_site_of_an_address(spark):
    df = spark.createDataFrame([(u,) for u in ("HTTPS://www.A.example:8080/x?y", "a.example/p", "http://u@b.example#t", "", None)], "url string")
    assert [r[0] for r in df.select(boilerplate.site(F.col("url"))).collect()] == ["a.example", "a.example", "b.example", None, None]


def test_boilerplate(spark, small, pages):
    found = {(r.doc_id, r.line_no) for r in boilerplate.boilerplate_lines(small, pages).collect()}
    assert found == {(0, 1), (0, 5)}
    clean = {r.doc_id: r.text for r in boilerplate.main_content(small, pages).collect()}
    assert clean[0].startswith("A bridge at last") and "©" not in clean[0] and clean[1] is None and clean[2] == ""
    assert boilerplate.main_content(small, pages).columns == small.columns


def test_boilerplate_of_empty_tables(spark, small, pages):
    assert boilerplate.boilerplate_lines(small.limit(0), pages).count() == 0
    # Without pages no template is known; a line that begins with the mark of a copyright is one by itself.
    assert {(r.doc_id, r.line_no) for r in boilerplate.boilerplate_lines(small, pages.limit(0)).collect()} == {(0, 5)}


def test_elements_know_the_body():
    got = boilerplate.elements("<nav>menu</nav><div class=ad>buy</div><p>text<p>more<div>odd</div>")
    assert got == [("menu", False), ("buy", False), ("text", True), ("more", True), ("odd", None)]


def test_residue(spark, small, pages):
    assert {r.doc_id for r in residue.residue_documents(small, pages).collect()} == {3, 4}
    assert {r.doc_id for r in residue.without_residue(small, pages).collect()} == {0, 1, 2, 5, 6}
    about = PROSE + "A mark such as {{name}} is replaced by the template tool when the letter is made."
    assert not residue.is_residue([about]) and not residue.is_residue([PROSE + "Readers who met the error 404 last week can open the page again."])
    assert residue.is_residue(["undefined NaN null", "[object Object] &nbsp;"]) and residue.is_residue(["Lorem ipsum vocat tesquo noctal", "Dolor sanem resto lumet vocat armen"])
    assert not residue.is_residue([])


def test_profiles(spark, small, pages):
    assert {r.doc_id for r in statistics.not_prose(small, pages).collect()} == {5, 6}  # a table, and one sentence said over and over
    s = {r.doc_id: r for r in statistics.statistics(small, pages).collect()}
    assert len(s) == 7 and s[1].n_words is None and s[2].n_words == 0 and s[0].is_prose and not s[5].is_prose
    lines = ["word " * 30, "ab12 cd34 ef56 ab78 1234 9f9f", "%$# ==* |/| ~~ ^^", PROSE, "• garden bench", "xkcd brtz wqrt lmnp zzkt vvbn hjkl", "Der Hafen brauchte eine neue Brücke, und die Gemeinde fragte nach einem Plan für das Jahr."]
    names = ["prose" if (n := structure.NAMES[p]) in structure.PROSE else n for p in structure.nearest_profiles(lines)]
    assert names == ["stuffed", "machine", "symbols", "prose", "list", "random", "prose"]


def test_counts_equal_plain_python(spark, small):
    import re

    for r in statistics.counts(small.where("doc_id in (0, 3, 5)")).join(small.select("doc_id", "text"), "doc_id").collect():
        w = re.findall(r"[^\W_]+", r.text)
        assert r.n_words == len(w) and r.mean_word_length == round(sum(map(len, w)) / len(w), 6)


def brute_site_lines(rows):
    per, seen = {}, {}
    for d, (text, site) in enumerate(rows):
        if text is None or not site:
            continue
        per[site] = per.get(site, 0) + 1
        for n, line in enumerate(text.split("\n") if text else [], 1):
            k = "".join(c for c in line.lower() if c.isalpha())
            if k:
                seen.setdefault((site, k), {}).setdefault(d, []).append(n)
    return {(d, n) for (s, _), ds in seen.items() if len(ds) >= 5 and 20 * len(ds) >= per[s] for d, ns in ds.items() for n in ns}


def test_site_lines_equal_brute_force(spark):
    rng = random.Random(1)
    pool = ["Share this story", "share THIS story (12)", "All rights reserved.", "!!!", "", "a", "Read on: one", "Read on: two", "x" * 400]
    rows = [("\n".join(rng.choice(pool) if rng.random() < 0.4 else f"own {rng.randrange(10**6)} line {'abc'[rng.randrange(3)]}{rng.choice('xyz') * rng.randrange(9)}" for _ in range(rng.randrange(7))), rng.choice(["a.example", "b.example", None])) for _ in range(160)]
    rows += [(None, "a.example"), ("", "a.example")] + [rows[0]] * 3
    df = docs(spark, [(t, s and f"http://www.{s}/p") for t, s in rows])
    assert {(r.doc_id, r.line_no) for r in site_lines.repeated_lines(df).collect()} == brute_site_lines(rows)
    assert site_lines.repeated_lines(df.limit(0)).count() == 0
    found = brute_site_lines(rows)
    clean = {r.doc_id: r.text for r in site_lines.without_lines(df, site_lines.repeated_lines(df)).collect()}
    for i, (t, _) in enumerate(rows):
        assert clean[i] == (t and "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in found))


def test_line_templates_have_slots(spark, monkeypatch):
    monkeypatch.setattr(site_lines, "LINES", 3)  # leaves come in several parts
    people = "amber birch cedar daisy ember fern grove hazel iris juniper".split()
    rows = [(f"Story written for you by {p} of this paper\nown {p} text that {p} wrote {i}", f"http://a.example/{i}") for i, p in enumerate(people)]
    rows += [("Short", "http://a.example/x"), (None, "http://a.example/y"), ("Story written for you by nobody of this paper", None), ("Story written for you by jasmine of this paper", "http://b.example/")]
    df = docs(spark, rows)
    templates = site_lines.covering_templates(df)
    assert {(r.site, r.template, r.n) for r in templates.collect()} == {("a.example", "story written for you by * of this paper", 10)}
    assert {(r.doc_id, r.line_no) for r in site_lines.template_lines(df).collect()} == {(i, 1) for i in range(10)}
    assert site_lines.template_lines(df.limit(0)).count() == 0


def test_counted_hashes(spark):
    import hashlib
    from datetime import datetime

    h = hashlib.sha256(b"Share this").hexdigest()
    at = lambda n: datetime(2024, 1, n)
    rows = [(h, 9, "a.example", 0, at(1)), (h.upper(), 3, "a.example", 0, at(2)), (h, 4, "a.example", 1, at(1)), (h, 4, "a.example", 1, at(1)), (h, None, "a.example", 2, at(1)), (h, 50, None, 0, at(1)), (None, 1, "a.example", 0, at(1))]
    counts = spark.createDataFrame(rows, "hash string, cnt int, site string, shard int, counted_at timestamp")
    assert [(r.site, r.hash, r.cnt) for r in site_lines.counted_hashes(counts).collect()] == [("a.example", h, 7)]
    df = docs(spark, [("x\n  Share this \n", "http://www.a.example/"), ("Share this", "http://b.example/"), (None, "http://a.example/")])
    assert [(r.doc_id, r.line_no, r.cnt) for r in site_lines.counted_lines(df, counts).collect()] == [(0, 2, 7)]


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 400)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    want = {}
    for x in root:
        want.setdefault(find(x), set()).add(x)
    df = spark.createDataFrame(edges + [(None, 1)], "src long, dst long")
    got = {}
    for r in components.groups(df).collect():
        got.setdefault(r.label, set()).add(r.vertex)
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want.values() if len(g) > 1}
    assert components.groups(df.limit(0)).count() == 0


def test_file_groups(spark):
    rows = [(0, "[1, 2,3,4]", "x/B.txt "), (0, "[1,2,3,4]", "a.txt"), (1, "[1,2,3,4]", "c.txt"), (0, "[9,9,9,9]", "c.txt"), (0, "[9, 9, 9, 9]", "b.txt"), (0, "[]", "d.txt"), (0, "[]", "e.txt"), (0, None, "f.txt"), (0, "[5,5,5,5]", None), (2, "[8,8,8,8]", "A.TXT"), (2, "[8,8,8,8]", "data/a.txt")]
    df = spark.createDataFrame(rows, "band_no int, band string, doc string")
    assert {(r.path, r.group_path) for r in components.file_groups(df).collect()} == {("a.txt", "a.txt"), ("b.txt", "a.txt"), ("c.txt", "a.txt")}


def test_best_fill_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
        room = rng.randrange(1, 60)
        taken = packing.best_fill(room, counts, sorted(counts, reverse=True))
        items = [n for n, c in counts.items() for _ in range(c)]
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        assert sum(n * k for n, k in taken) == best and all(k <= counts[n] for n, k in taken)


def test_windows(spark, small):
    rows = packing.windows(small, capacity=100).collect()
    assert {r.doc_id for r in rows} == set(range(7))
    fill = {}
    for r in rows:
        fill[r.block, r.window] = fill.get((r.block, r.window), 0) + r.n_tokens
    assert max(fill.values()) <= 100
    once = [r for r in rows if r.doc_id == 3]
    assert len(once) == 1
    assert packing.windows(small.limit(0)).count() == 0


def test_mixing(spark):
    rows = [("alpha words here " * 5, None, None, "a")] * 60 + [("beta words there " * 5, None, None, "b")] * 20 + [(None, None, None, "a"), ("", None, None, None), ("gamma", None, None, "zzz")]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 2), ("none", 0.1, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mixed(docs(spark, rows), targets)
    share = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    assert abs(share["a"].share - 5 / 9) < 0.03 and abs(share["b"].share - 4 / 9) < 0.03 and share["none"].tokens == 0
    assert abs(share["a"].expected_share - 5 / 9) < 0.03
    assert share["a"].most_copies <= 1 and share["b"].most_copies <= 2 and share["zzz"].copies == 0
    assert mixed.count() == len(rows) == mixing.mix(docs(spark, rows), targets).count()
    assert mixing.mix(docs(spark, rows).limit(0), targets).count() == 0


def test_a_small_source_does_not_shrink_the_mix():
    assert mixing.mix_size([1000.0, 5.0], [0.98, 0.02]) > 900
    assert abs(mixing.mix_size([100.0, 100.0], [0.5, 0.5], 0.0) - 200) < 1


def test_rates_meet_targets(spark):
    rows = [([64, 0], 100.0, 0.2, 1.0), ([0, 64], 300.0, 0.1, 1.0), ([32, 32], 50.0, 0.0, 1.0)]
    cells = spark.createDataFrame(rows, "parts array<int>, tokens double, first double, cap double")
    steps = mixing.fit_rates(cells, [0.5, 0.5], 200.0, 200)
    r = [x.r for x in cells.select(mixing.rate_after(steps, F.col("first"), F.col("cap"), F.col("parts")).alias("r")).collect()]
    got = (np.array([t for _, t, _, _ in rows]) * r) @ (np.array([p for p, _, _, _ in rows]) / 64)
    assert np.allclose(got, [100, 100], atol=1) and min(r) >= 0 and max(r) <= 1


def test_unlabelled_documents_fill_a_short_domain(spark):
    rows = [("alpha words here " * 5, None, None, "a")] * 40 + [("beta things there " * 5, None, None, "b")] * 5 + [("beta things there " * 5,)] * 20
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    share = {r.source: r for r in mixing.shares(mixing.mixed(docs(spark, rows), targets, size=600), targets).collect()}
    assert share["b"].share < 0.4 and abs(share["b"].expected_share - 0.5) < 0.06 and share[None].tokens > 0


LETTERS = "abcdefghijklmnopqrst"


def of_two_vocabularies(many, few, unknown):
    """Rows of two sources without common words, and rows without a source that have all words of the second and from none on of the first."""
    first, second = ([f"{w}{x}" for x in LETTERS] for w in ("alpha", "beta"))
    rows = [(" ".join(first), None, None, "a")] * many + [(" ".join(second), None, None, "b")] * few
    return rows + [(" ".join(second + first[:k]),) for k in range(unknown)]


def test_the_fit_goes_on_while_shares_miss_by_much(spark):
    targets = spark.createDataFrame([("a", 0.98, 1), ("b", 0.02, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mixed(docs(spark, of_two_vocabularies(800, 4, 3)), targets).collect()
    assert [r.copies for r in mixed if r.source is None] == [1, 1, 1]


def test_rates_below_a_half_add_up_to_copies(spark):
    table = docs(spark, of_two_vocabularies(300, 14, 20))
    targets = spark.createDataFrame([("a", 0.95, 1), ("b", 0.05, 1)], "source string, target_share double, max_repeats int")
    whole = sum(r.n_tokens for r in mixing.mixed(table, targets).collect() if r.source == "a")
    mixed = mixing.mixed(table, targets, size=whole / 0.95)
    assert mixed.where("source IS NULL").select("parts").distinct().count() > 8
    share = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    assert 5 <= share[None].copies <= 7 and share[None].most_copies == 1
    assert share["b"].share < 0.035 and abs(share["b"].expected_share - 0.05) < 0.003


def test_rates_are_least_squares(spark):
    random = np.random.default_rng(3)
    parts = np.vstack([random.multinomial(64, [0.4, 0.3, 0.2, 0.1], 60), random.multinomial(64, [0.0, 0.0, 0.05, 0.95], 3)])
    tokens = random.exponential(1.0, 63) ** 2
    tokens /= tokens.sum()
    cells = spark.createDataFrame([([int(x) for x in p], float(t), 0.0, 1.0) for p, t in zip(parts, tokens)], "parts array<int>, tokens double, first double, cap double")
    target = np.array([0.1, 0.2, 0.15, 0.2])
    a, r = parts / 64 * tokens[:, None], np.zeros(63)
    for _ in range(50_000):
        r = np.clip(r - a @ (r @ a - target) / (a.T @ a).trace(), 0, 1)
    steps = mixing.fit_rates(cells, target.tolist(), 1.0)
    got = [x.r for x in cells.select(mixing.rate_after(steps, F.col("first"), F.col("cap"), F.col("parts")).alias("r")).collect()]
    assert np.abs((got - r) @ a).max() < 1e-3


NAMES = [("Corvin", "given"), ("Hazel", "given"), *[(h + t, "surname") for h in ("Alder", "Brack", "Kess") for t in ("moor", "bury", "wick")]]


def kinds(text):
    return {(text[a:b].strip(" ,.()"), k) for a, b, k, _ in pii.Tagger(NAMES).spans(text)}


@pytest.mark.parametrize(
    "text,want",
    [
        ("Write to a.b+c@mail.example for it.", {("a.b+c@mail.example", "email")}),
        ("Write to ab [at] mail [dot] example.", {("ab [at] mail [dot] example", "email")}),
        ("Call +44 20 7946 0819 now", {("+44 20 7946 0819", "phone")}),
        ("Tel. 555-0162", {("555-0162", "phone")}),
        ("SSN 999-88-5524", {("999-88-5524", "id")}),
        ("Host 192.0.2.27:8080 failed", {("192.0.2.27:8080", "ip")}),
        ("Host 2001:db8::c830:7612 failed", {("2001:db8::c830:7612", "ip")}),
        ("They live at 134 Wint Street, Millfield.", {("134 Wint Street", "address")}),
        ("Many thanks to Corvin Aldermoor for the pictures.", {("Corvin Aldermoor", "name")}),
        ("Posted 2020-01-02 by Unlisted Kessbury", {("Unlisted Kessbury", "name")}),
        ("Release 4.22.41.1 fixed the fault.", set()),
        ("ISBN 8-64649-82-46 is out. Order no. 01796-066 is on its way.", set()),
        ("The hazel grows. Paid by Aldermoor & Sons Ltd.", set()),
        ("|||EMAIL_ADDRESS||| was on the list. Follow @user25. 4 kettles @ 53.50 each", set()),
    ],
)
def test_pii_kinds(text, want):
    assert kinds(text) == want


def test_skip_edges_carry_evidence():
    weak = [(0, 5, "name", -0.6, ("aldermoor",)), (50, 55, "name", 4.0, ("aldermoor",))]
    apart = [weak[0], (50, 55, "name", 4.0, ("other",))]
    assert pii.marginals(weak)[0] > 0.5 > pii.marginals(apart)[0]
    assert min(pii.marginals([(0, 9, "id", 2.0, ()), (0, 9, "phone", 3.0, ())])) < 0.5


def test_masking(spark):
    df = docs(spark, [("Mail x@y.example or x@y.example\nTel. 555-0162",), (None,), ("",)])
    names = spark.createDataFrame(NAMES, "name string, kind string")
    out = {r.doc_id: r for r in chain.masked(df, names).collect()}
    assert out[0].text == "Mail [EMAIL] or [EMAIL]\nTel. [PHONE]" and out[0].pii_counts.email == 2 and out[0].pii_counts.phone_numbers == 1
    assert out[1].text is None and out[2].text == "" and out[2].pii_counts.names == 0
    assert {(r.line_no, r.kind) for r in chain.found(df, names).collect()} == {(1, "email"), (2, "phone")}


def test_field_agrees_with_certain_spans_held_out():
    rng = random.Random(8)
    people = [f"{g} {h}{t}" for g in ("Corvin", "Hazel") for h in ("Alder", "Brack", "Kess") for t in ("moor", "bury", "wick")]
    carriers = {
        "name": lambda: f"The talk was given by {rng.choice(people)} today.", "email": lambda: f"Write to u{rng.randrange(99)}@mail.example for it.",
        "phone": lambda: f"Call +44 20 7946 {rng.randrange(1000, 9999)} now.", "id": lambda: f"Her SSN {rng.randrange(100, 900)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)} is known.",
        "address": lambda: f"They live at {rng.randrange(1, 200)} Wint Street, Millfield.", "ip": lambda: f"Host 192.0.2.{rng.randrange(1, 250)} failed.",
    }
    make = lambda: (lambda ks: ("\n".join([PROSE, *[carriers[k]() for k in ks], "Release 4.22.41.1 fixed the fault. Order no. 01796-066 is on its way."]), set(enumerate(ks, 2))))(rng.sample(sorted(carriers), 3))
    train, test = [make() for _ in range(150)], [make() for _ in range(60)]
    tagger = pii.Tagger(NAMES)
    field = chain.Field({"names": NAMES, "model": chain.fit(tagger, [t for t, _ in train])})
    got = field.lines([t for t, _ in test])
    for kind in pii.KINDS:
        want = {(i, n) for i, (_, s) in enumerate(test) for n, k in s if k == kind}
        found = {(i, n) for i, n, k in got if k == kind}
        assert len(want & found) >= 0.95 * len(want) and len(want & found) >= 0.95 * len(found), kind


def test_skip_edges_of_the_field_carry_labels():
    k = len(chain.LABELS)
    model = {"w": np.zeros((chain.BUCKETS, k), np.float32), "t": np.zeros((k, k)), "u": np.full(k, 3.0)}
    score = np.zeros((2, k))
    score[0, 5], score[1, 5] = 4.0, -0.5
    x, none = np.zeros((2, chain.WIDE), np.int32), np.zeros((0, 2), np.int64)
    apart, joined = chain.marginals(model, x, score, none, none), chain.marginals(model, x, score, none, np.array([[0, 1]]))
    assert apart[1].argmax() != 5 and joined[1].argmax() == 5 and np.allclose(joined.sum(1), 1)


def test_codewords_are_apart():
    c = languages.codewords(7)
    assert min((a != b).sum() for a, b in itertools.combinations(c, 2)) >= 5


def test_languages_held_out():
    en, de = structure.FUNCTION_WORDS["en"], structure.FUNCTION_WORDS["de"]
    rng = random.Random(5)
    make = lambda ws, extra: " ".join(rng.choice(ws) if rng.random() < 0.6 else rng.choice(extra) for _ in range(14))
    rows = [(make(en, ["harbour", "bridge", "council"]), "en") for _ in range(60)] + [(make(de, ["Hafen", "Brücke", "Gemeinde"]), "de") for _ in range(60)]
    rows[0] = (rows[0][0], "de")  # a wrong label
    coder = languages.Coder(languages.fit(rows))
    tests = [(make(en, ["window"]), "en") for _ in range(40)] + [(make(de, ["Fenster"]), "de") for _ in range(40)]
    m, n = coder.margins([t for t, _ in tests])
    best, sure = coder.decode(m)
    assert np.mean([coder.langs[b] == x for b, (_, x) in zip(best, tests)]) >= 0.95 and n.min() == 14 and sure.max() <= 1
    assert coder.margins(["", "123"])[1].tolist() == [0, 0]


@pytest.mark.parametrize("text,want", [("what an i d i o t!", "idiot"), ("IDIОT", "idiot"), ("looooser", "loser"), ("1d10t you", "idiot"), ("i.d.i.o.t", "idiot"), ("i****t", "i*t")])
def test_disguises(text, want):
    assert want in [w for s in abuse.sentences(text) for w in s]


def test_abuse_held_out(spark):
    rng = random.Random(6)
    clean = lambda: " ".join(rng.choice("the harbour council bridge opened a new garden for every reader of our town today".split()) for _ in range(12)) + ". "
    bad = ["You are a worthless idiot!", "Shut up, you filthy loser!", "Go away, you stupid moron!"]
    rows = [(clean() * 3 + (rng.choice(bad) if i % 4 == 0 else "The word idiot once had a legal meaning.") + " " + clean(), int(i % 4 == 0)) for i in range(240)]
    sample = abuse.Sample(rows[:160])
    first = sample.fit({}, 0)
    found = abuse.counter_examples(spark.createDataFrame(rows[:160], "text string, y int"), first, 50)
    assert all("worthless" not in w and "filthy" not in w for w in found)
    sample.choose(first, found)
    model = abuse.Scorer(sample.fit(found, 1))
    p = model.texts([t for t, _ in rows[160:]])
    y = np.array([y for _, y in rows[160:]])
    assert ((p > abuse.THRESHOLD) == (y == 1)).mean() >= 0.95
    assert model.texts(["", None, "idiot"]).tolist()[:2] == [0.0, 0.0]
    df = docs(spark, [(t,) for t, _ in rows] + [(None,), ("",)])
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows)] + [(0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    s = {r.doc_id: r.abuse_score for r in abuse.scores(df, labels).collect()}
    assert len(s) == 242 and s[240] == s[241] == 0.0
    assert abuse.site_rates(df, labels).first().docs == 242


# Columns of the results that are compared with true cases.
FOUND = {
    "p1_found": "doc_id bigint, line_no int", "p2_found": "doc_id bigint, line_no int, kind string", "p3_found": "doc_id bigint, lang string", "p4_found": "doc_id bigint, line_no int", "p5_found": "doc_id bigint",
    "p6_found": "path string, group_path string", "p7_found": "doc_id bigint", "p10_found": "doc_id bigint",
}
EACH = ("p1_main_content", "p2_masked", "p3_document_languages", "p4_clean_text", "p5_scores", "p7_statistics")  # one row per document


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_run(spark, sf, name):
    df = Q.QUERIES[name](spark, sf)
    rows = df.collect()
    if name in FOUND:
        assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == FOUND[name]
        assert len(rows) == len(set(rows))
    if name in EACH:
        ids = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
        assert sorted(r.doc_id for r in rows) == sorted(ids)
    if name not in ("p1_method", "p4_method", "p10_method", "p5_found", "p4_counted_lines"):  # few or none in the smallest tables
        assert rows


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, sf, name):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    want = con.execute(Q.SQL[name]).df()
    got = Q.QUERIES[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    key = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert sorted(got.columns) == cols and key(got) == key(want)
