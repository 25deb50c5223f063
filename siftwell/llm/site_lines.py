"""Lines repeated across one site's documents.

The distinct lines of each site are counted first, each document once, so that
everything after works on one row per site and line.  For the templates, lines
go down token trees of fixed depth: from their site by the number of their words
and their first words to a leaf, where a line joins the template that agrees
with it in most positions; positions that differ become wildcard slots.  Leaves
whose lines together have too few documents are pruned before anything in them
is parsed.  Partial trees are built per partition and merged over two levels of
ever wider parts of a leaf; then each line goes back to its template, and the
templates that cover many documents are excessive.

A case of the problem is a line whose letters agree, all of them, with those of
other documents.  A template with wildcard slots covers lines whose letters
differ, so repeated_lines() counts the lines themselves, and template_lines()
removes what the templates cover.

Null and empty texts have no lines, a null url has no site; lines without
letters are never removed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.boilerplate import site
from siftwell.plans.lineage import cut

MIN_DOCS = 5
SHARE = 20  # a line is excessive on 1 in SHARE documents of its site
DEPTH = 3  # words on the way to a leaf
SIMILAR = 0.6  # agreeing positions that make a line join a template
FAN = 16  # parts of a leaf that are merged before the leaf is
LINES = 50_000  # distinct lines of a leaf that one task gives back to its templates
WILD = "*"


def letters(line):
    """Column: the letters of a line, lower-cased."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}]+", "")


def words(line):
    """Column: the words of a line, lower-cased, between single blanks."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))


def with_site(documents: DataFrame) -> DataFrame:
    docs = documents.where(F.col("text").isNotNull() & (F.col("text") != "")).select("doc_id", site(F.col("url")).alias("site"), "text")
    return docs.where(F.col("site").isNotNull())


def site_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, site, line_no, h): every line with letters of a document that has a site, by the hash of its letters."""
    lines = with_site(documents).select("doc_id", "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("doc_id", "site", (F.col("pos") + 1).alias("line_no"), letters(F.col("line")).alias("letters"))
    return lines.where(F.col("letters") != "").select("doc_id", "site", "line_no", F.xxhash64("letters").alias("h"))


def site_sizes(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("text").isNotNull()).groupBy(site(F.col("url")).alias("site")).agg(F.count("*").alias("docs")).where(F.col("site").isNotNull())


def often(counted: DataFrame, sizes: DataFrame, count: str, min_docs: int, share: int) -> DataFrame:
    return counted.where(F.col(count) >= min_docs).join(sizes, "site").where(F.col(count) * share >= F.col("docs")).drop("docs")


def distinct_lines(documents: DataFrame, spelled: bool = False) -> DataFrame:
    """(site, h, n): documents of each distinct line of a site.

    ``spelled`` adds its words (the first spelling of several); a document that
    spells a line in two ways then counts for each, so n is a bound.
    """
    lines = F.filter(F.split("text", "\n", -1), lambda x: letters(x) != "")
    if spelled:
        rows = F.transform(lines, lambda x: F.struct(F.xxhash64(letters(x)).alias("h"), words(x).alias("words")))
        each = with_site(documents).select("site", F.explode(F.array_distinct(rows)).alias("l")).select("site", "l.h", "l.words")
        return each.groupBy("site", "h").agg(F.count("*").alias("n"), F.min("words").alias("words"))
    # Each document is one row: its lines are made distinct before anything is shuffled.
    hashes = F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.nullif(letters(x), F.lit(""))))
    each = with_site(documents).select("site", F.explode(hashes).alias("letters")).where(F.col("letters").isNotNull())
    return each.groupBy("site", F.xxhash64("letters").alias("h")).agg(F.count("*").alias("n"))


def repeated_lines(documents: DataFrame, min_docs: int = MIN_DOCS, share: int = SHARE) -> DataFrame:
    """(doc_id, line_no) of lines whose letters recur in min_docs documents and one in ``share`` of their site."""
    excessive = often(distinct_lines(documents), site_sizes(documents), "n", min_docs, share).select("site", "h")
    return site_lines(documents).join(excessive, ["site", "h"], "left_semi").select("doc_id", "line_no")


def leaf(text):
    """Column: the leaf of a line, from the number of its words and its first ones."""
    w = F.split(text, " ")
    return F.xxhash64(F.size(w), F.array_join(F.slice(w, 1, DEPTH), " "))


def join_template(templates: list[list[str]], toks: list[str]) -> int:
    """Index of the most similar template, or -1; the earliest wins a tie."""
    best, at = -1.0, -1
    for i, t in enumerate(templates):
        same = sum(a == b for a, b in zip(t, toks))
        if same / len(toks) >= SIMILAR and same > best:
            best, at = same, i
    return at


def merge(templates: list[list[str]], new: list[str]) -> None:
    """Adds a template: into a similar one, whose differing positions become slots, or beside it."""
    at = join_template(templates, new)
    if at < 0:
        templates.append(list(new))
    else:
        templates[at] = [a if a == b else WILD for a, b in zip(templates[at], new)]


def _merge_sorted(batches):
    """Merges rows that come sorted by site and leaf; only the templates of one leaf are held."""
    at, own = None, []
    for pdf in batches:
        out = []
        for s, n, t in zip(pdf["site"], pdf["leaf"], pdf["template"]):
            if (s, n) != at:
                out += [(*at, " ".join(x)) for x in own] if at else []
                at, own = (s, n), []
            merge(own, t.split(" "))
        yield pd.DataFrame(out, columns=["site", "leaf", "template"])
    yield pd.DataFrame([(*at, " ".join(x)) for x in own] if at else [], columns=["site", "leaf", "template"])


TEMPLATE = "site string, leaf long, template string"


def _merged(rows: DataFrame, *by) -> DataFrame:
    return rows.repartition(*by).sortWithinPartitions("site", "leaf", "template").mapInPandas(_merge_sorted, TEMPLATE)


def _assign(batches):
    """Gives each line of a leaf to its most similar template; rows come sorted, templates first."""
    at, own = None, []
    for pdf in batches:
        out = []
        for s, n, p, h, t in zip(pdf["site"], pdf["leaf"], pdf["part"], pdf["h"], pdf["words"]):
            if (s, n, p) != at:
                at, own = (s, n, p), []
            if h == "":
                own.append(t.split(" "))
                continue
            i = join_template(own, t.split(" "))
            out.append((s, int(h), " ".join(own[i]) if i >= 0 else t))
        yield pd.DataFrame(out, columns=["site", "h", "template"])


def line_templates(documents: DataFrame, min_docs: int = MIN_DOCS, share: int = SHARE) -> DataFrame:
    """(site, h, template): the template of each distinct line in leaves that may cover many documents."""
    lines = distinct_lines(documents, spelled=True).withColumn("leaf", leaf(F.col("words")))
    lines = cut(lines)  # once for the sizes of the leaves, once for the lines in them
    leaves = lines.groupBy("site", "leaf").agg(F.sum("n").alias("n"), F.count("*").alias("lines"))
    leaves = often(leaves, site_sizes(documents), "n", min_docs, share).select("site", "leaf", F.floor(F.col("lines") / LINES).cast("int").alias("parts"))
    kept = cut(lines.join(leaves, ["site", "leaf"]).select("site", "leaf", "h", "words", "parts"))
    trees = kept.select("site", "leaf", F.col("words").alias("template"))
    trees = trees.sortWithinPartitions("site", "leaf", "template").mapInPandas(_merge_sorted, TEMPLATE)
    for fan in (FAN, 1):
        trees = _merged(trees, "site", "leaf", F.pmod(F.xxhash64("template"), F.lit(fan)))
    part = F.when(F.col("parts") > 0, F.pmod(F.col("h"), F.col("parts") + 1)).otherwise(0).cast("int")
    given = kept.select("site", "leaf", part.alias("part"), F.col("h").cast("string").alias("h"), "words")
    spread = trees.join(kept.select("site", "leaf", "parts").distinct(), ["site", "leaf"]).select("site", "leaf", F.explode(F.sequence(F.lit(0), "parts")).alias("part"), F.lit("").alias("h"), F.col("template").alias("words"))
    both = given.unionByName(spread).repartition("site", "leaf", "part").sortWithinPartitions("site", "leaf", "part", F.col("h") != "", "words")
    return both.mapInPandas(_assign, "site string, h long, template string")


def _parsed(documents: DataFrame, min_docs: int, share: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Templates of lines, lines with the hash of their template, and (site, t, n) of those that cover many documents."""
    of = cut(line_templates(documents, min_docs, share))
    parsed = cut(site_lines(documents).join(of.select("site", "h", F.xxhash64("template").alias("t")), ["site", "h"]).drop("h"))
    per = parsed.select("doc_id", "site", "t").distinct().groupBy("site", "t").agg(F.count("*").alias("n"))
    return of, parsed, often(per, site_sizes(documents), "n", min_docs, share)


def covering_templates(documents: DataFrame, min_docs: int = MIN_DOCS, share: int = SHARE) -> DataFrame:
    """(site, template, n) of the templates that cover many documents; slots are stars."""
    of, _, covering = _parsed(documents, min_docs, share)
    return of.select("site", "template", F.xxhash64("template").alias("t")).distinct().join(covering, ["site", "t"]).drop("t")


def template_lines(documents: DataFrame, min_docs: int = MIN_DOCS, share: int = SHARE) -> DataFrame:
    """(doc_id, line_no) of the lines of templates that cover many documents of their site."""
    _, parsed, covering = _parsed(documents, min_docs, share)
    return parsed.join(covering.select("site", "t"), ["site", "t"], "left_semi").select("doc_id", "line_no")


def without_lines(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """The documents without the given (doc_id, line_no); everything else in them, and the other columns, stays."""
    gone = lines.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line_no").alias("_gone"))  # lines of one document
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("_gone", i + 1)), "\n")
    joined = documents.join(gone, F.col("doc_id") == F.col("_id"), "left")
    return joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept)).select(*[F.col(f"`{c}`") for c in documents.columns])


def counted_hashes(hash_cnt: DataFrame) -> DataFrame:
    """(site, hash, cnt): occurrences of each line of a site over all shards, from earlier counts.

    Of the rows of one shard, site and hash the latest holds (ties: the larger
    count); a null count is 0, hashes are in lower case, a null site is none.
    """
    latest = hash_cnt.where("site is not null and hash is not null").groupBy("shard", "site", F.lower(F.trim("hash")).alias("hash")).agg(F.max(F.struct("counted_at", "cnt")).alias("m"))
    return latest.groupBy("site", "hash").agg(F.sum(F.coalesce("m.cnt", F.lit(0))).cast("bigint").alias("cnt"))


def counted_lines(documents: DataFrame, hash_cnt: DataFrame, min_count: int = MIN_DOCS) -> DataFrame:
    """(doc_id, line_no, cnt) of the lines whose stripped text earlier counts give ``min_count`` or more on their site."""
    lines = with_site(documents).select("doc_id", "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    stripped = F.regexp_replace("line", r"\A[\t-\r ]+|[\t-\r ]+\z", "")
    lines = lines.where(stripped != "").select("doc_id", "site", (F.col("pos") + 1).alias("line_no"), F.sha2(stripped, 256).alias("hash"))
    return lines.join(counted_hashes(hash_cnt).where(F.col("cnt") >= min_count), ["site", "hash"]).select("doc_id", "line_no", "cnt")
