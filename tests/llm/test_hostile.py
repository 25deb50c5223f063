"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftwell.llm import abuse, boilerplate, chain, components, languages, mixing, packing, residue, site_lines, statistics

DOCS = "doc_id long, text string, lang string, source string, n_chars long, url string, confidence double, path string, crawled_at timestamp, site string, count long, h string, words string, part int, key long, copies string"
LONG = "The harbour needed a new bridge, and the council asked u5@mail.example for a plan. " * 3000


@pytest.fixture(scope="module")
def tables(spark):
    extra = ("x", 1, "x", "x", 1, 1, "x")
    texts = [None, "", "\n\n", "a", LONG, "one line\nYou idiot!\n{{name}}", "one line\nYou idiot!\n{{name}}", "\x00\ud7ff \U0001f600 \u2028", "word" * 60_000]
    rows = [(i, t, "en", "web", 1, f"http://a.example/{i}", 0.5, "p", datetime(2024, 1, 1), *extra) for i, t in enumerate(texts)]
    rows += [(None, "a text of no number", None, None, None, None, None, None, None, *[None] * 7), (0, None, None, None, None, "", None, None, None, *extra), (3, "a", "??", "", 0, "::", None, "", None, *extra), rows[5]]
    make = spark.createDataFrame
    return {
        "documents": make(rows, DOCS),
        "pages": make([(1, "http://a.example/", "<p>x"), (2, None, None), (3, "http://a.example/", ""), (4, "", "<"), (None, None, "<nav>a</nav>")] * 2, "page_id long, url string, html string"),
        "labels": make([(5, 1, 1), (5, 1, 1), (3, None, 0), (4, 0, 0), (None, 1, 1), (6, 1, None), (7, 0, 7)], "doc_id long, quality int, toxic int"),
        "names": make([("Corvin", "given"), ("Corvin", "given"), (None, "surname"), ("", None), ("Aldermoor", "surname")], "name string, kind string"),
        "langs": make([("en", "en"), ("EN", "en"), (None, "de"), ("de", "de")], "label string, lang string"),
        "targets": make([("web", 0.5, 2), ("", 0.2, None), (None, 0.1, 1), ("none", None, 1)], "source string, target_share double, max_repeats int"),
        "bands": make([(0, "[1,2,3,4]", "a"), (0, "[1, 2, 3, 4]", " A "), (None, "[1,2,3,4]", "b"), (0, None, "c"), (0, "", None), (0, "[1,2,3,4]", "a")], "band_no int, band string, doc string"),
        "signature": make([("x/a", "[1]", None), (None, None, None), ("x/d", "[]", None), ("x/d", "[]", None)], "path string, signature_list string, built_at timestamp"),
        "hash_cnt": make([("ab", None, "a.example", 0, None), (None, 1, None, None, None), ("ab", 7, "a.example", None, datetime(2024, 1, 1))], "hash string, cnt int, site string, shard int, counted_at timestamp"),
    }


RUNS = {
    "boilerplate_lines": lambda t: boilerplate.boilerplate_lines(t["documents"], t["pages"]),
    "template_lines": lambda t: boilerplate.template_lines(t["documents"], t["pages"]),
    "main_content": lambda t: boilerplate.main_content(t["documents"], t["pages"]),
    "chain_found": lambda t: chain.found(t["documents"], t["names"]),
    "chain_masked": lambda t: chain.masked(t["documents"], t["names"]),
    "languages_found": lambda t: languages.found(t["documents"], t["pages"], t["langs"]),
    "languages_segments": lambda t: languages.segments(t["documents"], t["pages"], t["langs"]),
    "document_languages": lambda t: languages.document_languages(t["documents"], t["pages"], t["langs"]),
    "repeated_lines": lambda t: site_lines.repeated_lines(t["documents"]),
    "site_templates": lambda t: site_lines.template_lines(t["documents"]),
    "without_lines": lambda t: site_lines.without_lines(t["documents"], site_lines.repeated_lines(t["documents"])),
    "counted_lines": lambda t: site_lines.counted_lines(t["documents"], t["hash_cnt"], 1),
    "abuse_scores": lambda t: abuse.scores(t["documents"], t["labels"]),
    "site_rates": lambda t: abuse.site_rates(t["documents"], t["labels"]),
    "every_file": lambda t: components.every_file(t["bands"], t["signature"]),
    "not_prose": lambda t: statistics.not_prose(t["documents"], t["pages"]),
    "statistics": lambda t: statistics.statistics(t["documents"], t["pages"]),
    "windows": lambda t: packing.windows(t["documents"]),
    "mixed": lambda t: mixing.mixed(t["documents"], t["targets"]),
    "shares": lambda t: mixing.shares(mixing.mixed(t["documents"], t["targets"]), t["targets"]),
    "residue_documents": lambda t: residue.residue_documents(t["documents"], t["pages"]),
    "covered_documents": lambda t: residue.covered_documents(t["documents"], t["pages"]),
    "without_residue": lambda t: residue.without_residue(t["documents"], t["pages"]),
}
WHOLE = ("main_content", "chain_masked", "without_lines", "abuse_scores")  # rows in, rows out


@pytest.mark.parametrize("name", sorted(RUNS))
def test_hostile_rows(tables, name):
    rows = RUNS[name](tables).collect()
    if name in WHOLE:
        assert len(rows) == tables["documents"].count()


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_tables(tables, name):
    assert RUNS[name]({k: t.where(F.lit(False)) for k, t in tables.items()}).count() == 0
