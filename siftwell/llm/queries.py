"""Queries of the problems, by name, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwell.llm import abuse, boilerplate, chain, components, languages, mixing, packing, residue, site_lines, statistics


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_method(spark, d):
    return boilerplate.template_lines(table(spark, d, "documents"), table(spark, d, "pages"))


def p1_found(spark, d):
    return boilerplate.boilerplate_lines(table(spark, d, "documents"), table(spark, d, "pages"))


def p1_main_content(spark, d):
    t = boilerplate.main_content(table(spark, d, "documents"), table(spark, d, "pages"))
    return t.select("doc_id", "text")


def p4_found(spark, d):
    return site_lines.repeated_lines(table(spark, d, "documents"))


def p4_method(spark, d):
    return site_lines.template_lines(table(spark, d, "documents"))


def p4_clean_text(spark, d):
    documents = table(spark, d, "documents")
    return site_lines.without_lines(documents, site_lines.repeated_lines(documents)).select("doc_id", "text")


def p4_counted_lines(spark, d):
    return site_lines.counted_lines(table(spark, d, "documents"), table(spark, d, "hash_cnt"))


def p5_found(spark, d):
    return abuse.abusive(table(spark, d, "documents"), table(spark, d, "labels"))


def p5_scores(spark, d):
    return abuse.scores(table(spark, d, "documents"), table(spark, d, "labels")).select("doc_id", "abuse_score")


def p5_site_rates(spark, d):
    return abuse.site_rates(table(spark, d, "documents"), table(spark, d, "labels"))


def p6_found(spark, d):
    return components.file_groups(table(spark, d, "bands"))


def p6_every_file(spark, d):
    return components.every_file(table(spark, d, "bands"), table(spark, d, "signature"))


def p2_found(spark, d):
    return chain.found(table(spark, d, "documents"), table(spark, d, "person_names"))


def p2_masked(spark, d):
    return chain.masked(table(spark, d, "documents"), table(spark, d, "person_names")).select("doc_id", "text", "pii_counts")


def p3_found(spark, d):
    return languages.found(table(spark, d, "documents"), table(spark, d, "pages"), table(spark, d, "lang_labels"))


def p3_document_languages(spark, d):
    return languages.document_languages(table(spark, d, "documents"), table(spark, d, "pages"), table(spark, d, "lang_labels"))


def p3_segments(spark, d):
    t = languages.segments(table(spark, d, "documents"), table(spark, d, "pages"), table(spark, d, "lang_labels"))
    return t.select("doc_id", "line_no", "lang", "confidence", "ambiguous")


def p7_found(spark, d):
    return statistics.not_prose(table(spark, d, "documents"), table(spark, d, "pages"))


def p7_statistics(spark, d):
    return statistics.statistics(table(spark, d, "documents"), table(spark, d, "pages"))


def p10_method(spark, d):
    return residue.covered_documents(table(spark, d, "documents"), table(spark, d, "pages"))


def p10_found(spark, d):
    return residue.residue_documents(table(spark, d, "documents"), table(spark, d, "pages"))


def p10_without_residue(spark, d):
    return residue.without_residue(table(spark, d, "documents"), table(spark, d, "pages")).select("doc_id", "text")


def p8_windows(spark, d):
    return packing.windows(table(spark, d, "documents"))


def p8_fill(spark, d):
    return packing.fill_report(p8_windows(spark, d))


def p9_mix(spark, d):
    mixed = mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))
    return mixed.where("copies > 0")


def p9_shares(spark, d):
    targets = table(spark, d, "source_targets")
    return mixing.shares(mixing.mixed(table(spark, d, "documents"), targets), targets)


QUERIES = {"p1_method": p1_method, "p1_found": p1_found, "p1_main_content": p1_main_content, "p2_found": p2_found, "p2_masked": p2_masked, "p3_found": p3_found, "p3_document_languages": p3_document_languages, "p3_segments": p3_segments, "p4_method": p4_method, "p4_found": p4_found, "p4_clean_text": p4_clean_text, "p4_counted_lines": p4_counted_lines, "p5_found": p5_found, "p5_scores": p5_scores, "p5_site_rates": p5_site_rates, "p6_found": p6_found, "p6_every_file": p6_every_file, "p7_found": p7_found, "p7_statistics": p7_statistics, "p8_windows": p8_windows, "p8_fill": p8_fill, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_method": p10_method, "p10_found": p10_found, "p10_without_residue": p10_without_residue}

SITE_SQL = "nullif(regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.\\-]*://)?(?:[^/@?#]*@)?([^/:?#]+)', 1), '^www\\.', ''), '')"

P4_SQL = f"""
WITH d AS (SELECT doc_id, {SITE_SQL} AS site, text FROM documents WHERE text IS NOT NULL),
n AS (SELECT site, count(*) AS docs FROM d WHERE site IS NOT NULL GROUP BY site),
l AS (SELECT doc_id, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM d WHERE text <> '' AND site IS NOT NULL),
k AS (SELECT doc_id, site, line_no, regexp_replace(lower(line), '[^\\p{{L}}]+', '', 'g') AS letters FROM l),
c AS (SELECT site, letters, count(DISTINCT doc_id) AS n FROM k WHERE letters <> '' GROUP BY ALL),
f AS (SELECT site, letters FROM c JOIN n USING (site) WHERE c.n >= 5 AND 20 * c.n >= n.docs)
SELECT doc_id, line_no::INTEGER AS line_no FROM k JOIN f USING (site, letters)
"""

P6_LINKS = """
r AS (SELECT DISTINCT band_no, regexp_replace(band, '[\\s\\[\\]]+', '', 'g') AS b, lower(trim(regexp_extract(doc, '[^/]*$'), chr(32)||chr(9)||chr(10)||chr(13))) AS file FROM bands WHERE doc IS NOT NULL AND band IS NOT NULL),
h AS (SELECT band_no, b, min(file) AS hub FROM r WHERE b <> '' AND file <> '' GROUP BY ALL HAVING count(*) > 1),
e AS (SELECT DISTINCT hub AS u, file AS v FROM r JOIN h USING (band_no, b) WHERE file <> hub),
s AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
g(u, v) AS (SELECT DISTINCT u, u FROM s UNION SELECT g.u, s.v FROM g JOIN s ON g.v = s.u),
m AS (SELECT u AS path, min(v) AS group_path FROM g GROUP BY u)
"""

P4_CLEAN = f"""
WITH p4 AS ({P4_SQL}), g AS (SELECT doc_id, list(line_no) AS gone FROM p4 GROUP BY doc_id),
t AS (SELECT doc_id, text, gone, string_split(text, chr(10)) AS l FROM documents LEFT JOIN g USING (doc_id))
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(list_transform(generate_series(1, len(l)), lambda i: CASE WHEN list_contains(gone, i) THEN NULL ELSE l[i] END), lambda x: x IS NOT NULL), chr(10)) END AS text FROM t
"""

P4_COUNTED = f"""
WITH h AS (SELECT shard, site, lower(trim(hash)) AS hash, max(struct_pack(counted_at := counted_at, cnt := cnt)) AS m FROM hash_cnt WHERE site IS NOT NULL AND hash IS NOT NULL GROUP BY ALL),
c AS (SELECT site, hash, sum(coalesce(m.cnt, 0))::BIGINT AS cnt FROM h GROUP BY ALL),
d AS (SELECT doc_id, {SITE_SQL} AS site, text FROM documents WHERE text <> ''),
l AS (SELECT doc_id, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM d WHERE site IS NOT NULL),
k AS (SELECT doc_id, site, line_no, regexp_replace(line, '\\A[\\t-\\r ]+|[\\t-\\r ]+\\z', '', 'g') AS s FROM l)
SELECT doc_id, line_no::INTEGER AS line_no, cnt FROM k JOIN c ON k.site = c.site AND c.hash = sha256(k.s) WHERE s <> '' AND cnt >= 5
"""

SQL = {
    "p4_found": P4_SQL,
    "p4_clean_text": P4_CLEAN,
    "p4_counted_lines": P4_COUNTED,
    "p6_found": f"WITH RECURSIVE {P6_LINKS} SELECT path, group_path FROM m",
    "p6_every_file": f"""WITH RECURSIVE {P6_LINKS},
        a AS (SELECT lower(trim(regexp_extract(path, '[^/]*$'), chr(32)||chr(9)||chr(10)||chr(13))) AS path FROM signature UNION SELECT lower(trim(regexp_extract(doc, '[^/]*$'), chr(32)||chr(9)||chr(10)||chr(13))) FROM bands)
        SELECT a.path, coalesce(m.group_path, a.path) AS group_path FROM a LEFT JOIN m ON a.path = m.path WHERE a.path IS NOT NULL AND a.path <> ''""",
}
