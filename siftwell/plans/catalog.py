"""Queries of the reference's operators by name, with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell import lexicons as X
from siftwell.config import Stage1Config
from siftwell.functions import bpe, masking
from siftwell.functions import text as T
from siftwell.operators import classify, dedup, lines, quality, tokens
from siftwell.plans import pipeline
from siftwell.plans import sql as S
from siftwell.sources import html, text_files

QUERIES: dict = {}
SQL: dict = {}
N, HASHES, BANDS = 5, 128, 16


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- text transforms

query("normalize_whitespace", f"SELECT doc_id, {S.normalize_whitespace('text')} AS text FROM documents")(
    lambda s, d: docs(s, d).select("doc_id", T.normalize_whitespace(F.col("text")).alias("text"))
)
query("one_doc_per_line", f"SELECT doc_id, {S.collapse('text')} AS line FROM documents WHERE text IS NOT NULL")(
    lambda s, d: docs(s, d).where("text is not null").select("doc_id", text_files.one_line(F.col("text")).alias("line"))
)
query("fasttext_lines", "SELECT doc_id, '__label__' || CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END || ' ' || substr(replace(text, chr(10), ' '), 1, 10000) AS line FROM documents JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IN (0, 1)) USING (doc_id) WHERE text IS NOT NULL")(
    lambda s, d: docs(s, d).where("text is not null")
    .join(table(s, d, "labels").where(F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct(), "doc_id")
    .select("doc_id", text_files.labelled_line(F.when(F.col("quality") == 1, "good").otherwise("bad"), F.col("text")).alias("line"))
)
query("grams_normalized", f"SELECT doc_id, {S.grams_text('text')} AS text FROM documents")(
    lambda s, d: docs(s, d).select("doc_id", T.normalize_for_grams(F.col("text")).alias("text"))
)
query("jsonl_record", "SELECT doc_id, text, lang, round(confidence, 4) AS confidence, url, coalesce(pii_counts.email, 0) + coalesce(pii_counts.phone_numbers, 0) + coalesce(pii_counts.ip_address, 0) AS pii_total FROM documents")(
    lambda s, d: docs(s, d).select("doc_id", "text", "lang", F.round("confidence", 4).alias("confidence"), "url", text_files.pii_total().alias("pii_total"))
)


# ---- masking

_m, _c = S.masked("text")


@query("pii_mask", f"SELECT doc_id, {_m} AS text FROM documents")
def pii_mask(s, d):
    return docs(s, d).select("doc_id", masking.mask(F.col("text"))[0].alias("text"))


@query("pii_counts", f"SELECT doc_id, {', '.join(f'{e} AS {k}' for k, e in _c.items())} FROM documents")
def pii_counts(s, d):
    return docs(s, d).select("doc_id", *[c.alias(k) for k, c in masking.mask(F.col("text"))[1].items()])


@query("pii_by_source", f"SELECT source, count(*) AS docs, {', '.join(f'sum({e})::BIGINT AS {k}' for k, e in _c.items())} FROM documents GROUP BY source")
def pii_by_source(s, d):
    counts = masking.mask(F.col("text"))[1]
    return docs(s, d).select("source", *[c.alias(k) for k, c in counts.items()]).groupBy("source").agg(F.count("*").alias("docs"), *[F.sum(k).alias(k) for k in counts])


# ---- document rules

_t = "coalesce(text, '')"
_metrics = f"""m0 AS (SELECT doc_id, source, lang, confidence, {_t} AS text, {S.tokens(_t)} AS tok, {S.lines(_t)} AS lin, {S.words(_t)} AS w FROM documents),
m AS (SELECT doc_id, source, lang, confidence, text, len(tok) AS n_tokens, length(array_to_string(tok, '')) AS token_chars,
 len(list_filter(tok, lambda x: regexp_matches(x, '\\p{{L}}'))) AS alpha_tokens, len(list_filter(tok, lambda x: x IN ('#', '...'))) AS symbol_tokens,
 len(list_filter(tok, lambda x: lower(x) IN ({', '.join(map(S.q, X.STOP_WORDS))}))) AS stop_hits, len(lin) AS n_lines,
 len(list_filter(lin, lambda x: suffix({S.strip('x')}, '...'))) AS ellipsis_lines,
 len(list_distinct(tok)) AS distinct_tokens, len(w) AS n_words, len(list_filter(w, lambda x: regexp_matches(x, {S.q(X.HTML_NOISE)}))) AS noise_words,
 {S.count_class('text', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}' + X.WS[1:])} AS punctuation_chars, length(text) AS n_chars_all,
 len(list_filter(tok, lambda x: regexp_matches(x, '\\p{{Nd}}'))) AS digit_tokens FROM m0)"""
_gopher = {
    "length": "n_tokens >= 50 AND n_tokens <= 100000",
    "mean_length": "token_chars >= 3 * n_tokens AND token_chars <= 10 * n_tokens",
    "alphabetic": "10 * alpha_tokens >= 8 * n_tokens",
    "symbols": "10 * symbol_tokens <= n_tokens",
    "stop_words": "stop_hits >= 2",
    "ellipsis": "n_lines > 0 AND 10 * ellipsis_lines <= 3 * n_lines",
}
_gopher_all = " AND ".join(f"({r})" for r in _gopher.values())
def _super_sql(terms):
    hits = " + ".join(f"contains(lower(text), {S.q(t)})::BIGINT" for t in terms)
    return f"(10 * distinct_tokens >= 3 * n_tokens) AND (1000 * noise_words < 5 * greatest(n_words, 1)) AND (n_chars_all > 0 AND 10 * punctuation_chars <= 2 * n_chars_all) AND (10 * digit_tokens <= n_tokens) AND ({hits} >= 2)"


def _counts(s, d, terms=()):
    return quality.metrics(docs(s, d), terms=terms)


def _super_keep(s, d, terms):
    return _counts(s, d, terms).where(quality.all_of(quality.gopher_rules()) & quality.all_of(quality.super_rules())).select("doc_id")


query("gopher_metrics", f"WITH {_metrics} SELECT doc_id, {', '.join(quality.GOPHER)} FROM m")(lambda s, d: _counts(s, d).select("doc_id", *quality.GOPHER))
query("gopher_keep", f"WITH {_metrics} SELECT doc_id FROM m WHERE {_gopher_all}")(lambda s, d: _counts(s, d).where(quality.all_of(quality.gopher_rules())).select("doc_id"))
query("gopher_fail_reasons", f"WITH {_metrics} SELECT doc_id, concat_ws(',', {', '.join(f'CASE WHEN NOT ({r}) THEN {S.q(k)} END' for k, r in _gopher.items())}) AS reasons FROM m")(
    lambda s, d: _counts(s, d).select("doc_id", quality.reasons(quality.gopher_rules()).alias("reasons"))
)
query("lexical_diversity", f"WITH {_metrics} SELECT doc_id, distinct_tokens, n_tokens, 10 * distinct_tokens >= 3 * n_tokens AS keep FROM m")(
    lambda s, d: _counts(s, d).select("doc_id", "distinct_tokens", "n_tokens", quality.super_rules()["diversity"].alias("keep"))
)
query("html_noise", f"WITH {_metrics} SELECT doc_id, noise_words, n_words, 1000 * noise_words < 5 * greatest(n_words, 1) AS keep FROM m")(
    lambda s, d: _counts(s, d).select("doc_id", "noise_words", "n_words", quality.super_rules()["html_noise"].alias("keep"))
)
query("punctuation_ratio", f"WITH {_metrics} SELECT doc_id, punctuation_chars, n_chars_all, n_chars_all > 0 AND 10 * punctuation_chars <= 2 * n_chars_all AS keep FROM m")(
    lambda s, d: _counts(s, d).select("doc_id", "punctuation_chars", "n_chars_all", quality.super_rules()["punctuation"].alias("keep"))
)
query("numeric_ratio", f"WITH {_metrics} SELECT doc_id, digit_tokens, n_tokens, 10 * digit_tokens <= n_tokens AS keep FROM m")(
    lambda s, d: _counts(s, d).select("doc_id", "digit_tokens", "n_tokens", quality.super_rules()["numeric"].alias("keep"))
)
query("domain_coherence", "SELECT doc_id, " + " + ".join(f"contains(lower(coalesce(text, '')), {S.q(t)})::BIGINT" for t in X.DOMAIN_TERMS) + " AS domain_hits FROM documents")(
    lambda s, d: _counts(s, d, X.DOMAIN_TERMS).select("doc_id", "domain_hits")
)
query("super_quality_keep", f"WITH {_metrics} SELECT doc_id FROM m WHERE {_gopher_all} AND {_super_sql(X.DOMAIN_TERMS)}")(lambda s, d: _super_keep(s, d, X.DOMAIN_TERMS))

# ---- lines

_black = "|".join(__import__("re").sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", t) for t in X.LINE_BLACKLIST)


def _rules_sql(x: str, min_words: int) -> dict[str, str]:
    low = f"lower({S.strip(x)})"
    marks = S.count_class(x, "[^" + chr(92) + "p{L}" + chr(92) + "p{N}" + X.WS[1:])
    n = f"len({S.words(low)})"
    return {
        "words": f"{n} < {min_words}", "long": f"length({x}) > 500", "blacklist": f"regexp_matches({low}, {S.q(_black)})", "tag": f"contains({x}, '<')",
        "link": f"contains({low}, 'http://') OR contains({low}, 'https://')", "marks": f"2 * {marks} > greatest({n}, 1)",
        "digits": f"5 * {S.count_class(x, chr(92) + 'p{Nd}')} > greatest(length({x}), 1)", "foreign": f"5 * {S.count_class(x, '[^' + chr(92) + 'x{00}-' + chr(92) + 'x{7f}]')} > greatest(length({x}), 1)",
    }


_l6 = _rules_sql("x", 6)
_drop6 = " OR ".join(f"({r})" for r in _l6.values())
_filtered = f"array_to_string(list_filter({S.lines('text')}, lambda x: NOT ({_drop6})), chr(10))"
query("line_filter", f"SELECT doc_id, {_filtered} AS text FROM documents")(lambda s, d: docs(s, d).select("doc_id", lines.filter_lines(F.col("text"), min_words=6).alias("text")))
query("line_filter_reasons", f"WITH l AS (SELECT doc_id, unnest({S.lines('text')}) AS x FROM documents), r AS (SELECT " + ", ".join(f"({r}) AS {k}_" for k, r in _l6.items()) + " FROM l) SELECT count(*) AS n_lines, " + ", ".join(f"count(*) FILTER (WHERE {k}_) AS {k}_lines" for k in _l6) + " FROM r")(
    lambda s, d: docs(s, d).select(F.explode(T.lines(F.col("text"))).alias("x")).select(*[r.alias(k) for k, r in lines.line_rules(F.col("x"), min_words=6).items()])
    .agg(F.count("*").alias("n_lines"), *[F.count_if(F.col(k)).alias(f"{k}_lines") for k in _l6])
)
_fl = f"f AS (SELECT doc_id, unnest({S.feed_lines('text')}) AS line, generate_subscripts({S.feed_lines('text')}, 1) AS line_no FROM documents), g AS (SELECT doc_id, line_no, line, sha256({S.rep('line', chr(92) + 'A' + lines.ASCII_WS + '+|' + lines.ASCII_WS + '+' + chr(92) + 'z')}) AS h FROM f)"
query("line_frequency_top", f"WITH {_fl} SELECT h, count(*) AS cnt FROM g GROUP BY h HAVING count(*) >= 20")(
    lambda s, d: lines.line_counts(lines.feed_lines(docs(s, d))).where("cnt >= 20")
)
_once = f"{_fl}, o AS (SELECT h FROM g GROUP BY h HAVING count(*) = 1), k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM g JOIN o USING (h) GROUP BY doc_id), ld AS (SELECT doc_id, coalesce(k.text, '') AS text FROM documents LEFT JOIN k USING (doc_id))"
query("exact_line_dedup", f"WITH {_once} SELECT doc_id, text FROM ld")(lambda s, d: lines.exact_line_dedup(docs(s, d)))
query("exact_doc_dedup", "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")(lambda s, d: lines.exact_doc_dedup(docs(s, d)))

# ---- fuzzy deduplication

_g = S.grams_cte("documents", N)
_lsh = f"{_g}, {S.minhash_cte(HASHES)}, {S.bands_cte(HASHES, BANDS)}"


def _clusters_sql(cand: str, tenths: int = 8) -> str:
    return f"{cand}, {S.verify(tenths)}, {S.LINKS}, {S.clusters_cte()}"


def _reps(s, d, n=N):
    return dedup.classes(dedup.grams(docs(s, d), n, md5=True))


def _lsh_pairs(s, d, n=N, tenths=8, num_bands=BANDS):
    reps, _ = _reps(s, d, n)
    return dedup.verify(dedup.candidates(dedup.bands(dedup.minhash(reps, HASHES, "rep"), num_bands, HASHES, "rep"), "rep"), reps, tenths)


query("ngram_counts", f"WITH {_g} SELECT doc_id, len(grams) AS n_grams FROM gg")(lambda s, d: dedup.grams(docs(s, d), N).select("doc_id", F.size("grams").cast("bigint").alias("n_grams")))
query("shingle_classes", f"WITH {_g} SELECT doc_id, rep FROM gm")(lambda s, d: _reps(s, d)[1])
# At eight tenths few pairs or none are there in small tables, so that each join is also asked at LOW tenths and 3-grams.
LOW = 4
query("jaccard_pairs", f"WITH {S.grams_cte('documents', N)}, reps_all AS (SELECT doc_id AS rep, grams FROM gg), {S.EXACT_CAND.replace('FROM reps', 'FROM reps_all')}, {S.verify(8).replace('JOIN reps ', 'JOIN reps_all ')} SELECT src, dst, inter, total FROM pairs")(
    lambda s, d: dedup.all_pairs(docs(s, d), N, 8)
)
query("jaccard_pairs_low", f"WITH {S.grams_cte('documents', 3)}, {S.EXACT_CAND}, {S.verify(LOW)} SELECT src, dst, inter, total FROM pairs")(lambda s, d: dedup.near_pairs(docs(s, d), 3, LOW)[0])
query("minhash_signature", f"WITH {_g}, {S.minhash_cte(HASHES)} SELECT rep, array_to_string(signature, ',') AS signature FROM sig")(
    lambda s, d: dedup.minhash(_reps(s, d)[0], HASHES, "rep").select("rep", F.array_join("signature", ",").alias("signature"))
)
query("lsh_candidates", f"WITH {_lsh} SELECT src, dst FROM cand")(
    lambda s, d: dedup.candidates(dedup.bands(dedup.minhash(_reps(s, d)[0], HASHES, "rep"), BANDS, HASHES, "rep"), "rep")
)


for _name, _n, _tenths, _b in (("near_dup_pairs", N, 8, BANDS), ("near_dup_pairs_low", 3, LOW, 64)):
    query(_name, f"WITH {S.grams_cte('documents', _n)}, {S.minhash_cte(HASHES)}, {S.bands_cte(HASHES, _b)}, {S.verify(_tenths)} SELECT src, dst, inter, total FROM pairs")(lambda s, d, n=_n, t=_tenths, b=_b: _lsh_pairs(s, d, n, t, b))
for _name, _n, _tenths in (("near_dup_clusters", N, 8), ("near_dup_clusters_low", 3, LOW)):
    query(_name, f"WITH RECURSIVE {S.grams_cte('documents', _n)}, {_clusters_sql(S.EXACT_CAND, _tenths)} SELECT doc_id, cluster FROM clu")(lambda s, d, n=_n, t=_tenths: dedup.clusters(docs(s, d), n, t))
query("lsh_clusters", f"WITH RECURSIVE {_lsh}, {S.VERIFY}, {S.LINKS}, {S.clusters_cte()} SELECT doc_id, cluster FROM clu")(lambda s, d: dedup.lsh_clusters(docs(s, d), N, HASHES, BANDS))
query("fuzzy_dedup_survivors", f"WITH RECURSIVE {_g}, {_clusters_sql(S.EXACT_CAND)} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM clu WHERE doc_id <> cluster)")(
    lambda s, d: dedup.survivors(docs(s, d), n=N).select("doc_id")
)
query("murmur_signature")(lambda s, d: dedup.murmur_minhash(docs(s, d)).select("doc_id", F.array_join("signature", ",").alias("signature")))

# ---- classifiers

_lang = "SELECT doc_id, l.lang AS label FROM documents d JOIN lang_labels l ON d.lang = l.label WHERE text IS NOT NULL"


def _langs(s, d):
    l = table(s, d, "lang_labels").select(F.col("label").alias("_l"), F.col("lang").alias("label"))
    return docs(s, d).where("text is not null").join(F.broadcast(l), F.col("lang") == F.col("_l")).select("doc_id", "label")


def _votes(column: str, one: str, zero: str) -> str:
    return f"SELECT doc_id, CASE WHEN v > 0.5 THEN '{one}' ELSE '{zero}' END AS label FROM (SELECT doc_id, avg({column}) AS v FROM labels WHERE doc_id IS NOT NULL AND {column} IN (0, 1) GROUP BY doc_id) JOIN documents USING (doc_id) WHERE v <> 0.5 AND text IS NOT NULL"


def _labelled(s, d, column, one, zero):
    return classify.majority(table(s, d, "labels"), column, {1: one, 0: zero}).join(docs(s, d).where("text is not null").select("doc_id"), "doc_id", "left_semi")


_quality, _toxic = _votes("quality", "good", "bad"), _votes("toxic", "harmful", "safe")


def _quality_labels(s, d):
    return _labelled(s, d, "quality", "good", "bad")


def _harm_labels(s, d):
    return _labelled(s, d, "toxic", "harmful", "safe")


query("langid_predict", f"WITH {S.naive_bayes(_lang, classify.CHARS)} SELECT doc_id, label, score FROM pr")(lambda s, d: classify.classify(docs(s, d), _langs(s, d), classify.CHARS))
query("langid_confusion", f"WITH {S.naive_bayes(_lang, classify.CHARS)} SELECT lb.label AS label, pr.label AS predicted, count(*) AS docs FROM pr JOIN lb USING (doc_id) GROUP BY ALL")(
    lambda s, d: classify.classify(docs(s, d), _langs(s, d), classify.CHARS).withColumnRenamed("label", "predicted").join(_langs(s, d), "doc_id").groupBy("label", "predicted").agg(F.count("*").alias("docs"))
)
query("langid_held_out", S.evaluate(_lang, classify.CHARS))(lambda s, d: classify.evaluate(docs(s, d), _langs(s, d), classify.CHARS))
query("quality_score", f"WITH {S.naive_bayes(_quality, classify.WORDS)} SELECT doc_id, label, score FROM pr")(lambda s, d: classify.classify(docs(s, d), _quality_labels(s, d)))
query("quality_held_out", S.evaluate(_quality, classify.WORDS))(lambda s, d: classify.evaluate(docs(s, d), _quality_labels(s, d)))
query("harm_score", f"WITH {S.naive_bayes(_toxic, classify.WORDS)} SELECT doc_id, label, score FROM pr")(lambda s, d: classify.classify(docs(s, d), _harm_labels(s, d)))
query("threshold_filter", f"WITH {S.naive_bayes(_quality, classify.WORDS)} SELECT doc_id, score FROM pr WHERE label = 'good' AND score >= 0.8")(
    lambda s, d: classify.keep(classify.classify(docs(s, d), _quality_labels(s, d)), "good", 0.8).select("doc_id", "score")
)

# ---- pages, tokens

_h = "html"
for _p, _to in html.NATIVE:
    _h = S.rep(_h, _p, _to)
query("html_extract", f"SELECT page_id, trim({_h}) AS text FROM pages")(lambda s, d: table(s, d, "pages").select("page_id", html.native_text(F.col("html")).alias("text")))
query("html_text")(lambda s, d: html.extract_text(table(s, d, "pages")).select("page_id", "text"))
query("bpe_token_counts")(lambda s, d: docs(s, d).select("doc_id", bpe.token_counts()("text").alias("n_tokens")))
query("token_stream_offsets")(lambda s, d: tokens.offsets(tokens.token_stream(docs(s, d)).select("doc_id", F.size("ids").cast("bigint").alias("n")), "n"))
query("token_stream")(lambda s, d: tokens.token_stream(docs(s, d)).select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.element_at("ids", -1).alias("last_id")))


def _lengths(s, d):
    return docs(s, d).select("doc_id", F.size(T.tokens(F.coalesce("text", F.lit("")))).cast("bigint").alias("n"))


_of = f"n0 AS (SELECT doc_id, len({S.tokens(_t)}) AS n FROM documents), n1 AS (SELECT doc_id, n, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM n0)"
query("token_pack_offsets", f"WITH {_of} SELECT doc_id, n, start FROM n1")(lambda s, d: tokens.offsets(_lengths(s, d), "n"))
query("training_windows", f"WITH {_of}, n2 AS (SELECT doc_id, n, start, unnest(generate_series(start // 512, (start + n - 1) // 512)) AS window_id FROM n1 WHERE n > 0) SELECT window_id, doc_id, greatest(window_id * 512 - start, 0) AS from_pos, least((window_id + 1) * 512 - start, n) AS to_pos FROM n2")(
    lambda s, d: tokens.windows(tokens.offsets(_lengths(s, d), "n"), "n", 512)
)

# ---- stages


def _models(s, d):
    """The classifiers of stage 1 from the tables at hand: one harm classifier serves both steps that ask for one."""
    harm = classify.train(docs(s, d), _harm_labels(s, d))
    return pipeline.Models(classify.train(docs(s, d), _langs(s, d), classify.CHARS), harm, harm, classify.train(docs(s, d), _quality_labels(s, d)))


_s1m, _s1c = S.masked("text")
_clean = f"f AS (SELECT doc_id, {_filtered} AS text FROM documents), c AS (SELECT doc_id, {S.normalize_whitespace('mt')} AS text, email, phone_numbers, ip_address FROM (SELECT doc_id, {_s1m} AS mt, {', '.join(f'{e} AS {k}' for k, e in _s1c.items())} FROM f))"
_scores = f"{S.naive_bayes(_lang, classify.CHARS, 'l')}, {S.naive_bayes(_toxic, classify.WORDS, 'h')}, {S.naive_bayes(_quality, classify.WORDS, 'q', 'f')}"
_joined = "FROM m JOIN c USING (doc_id) LEFT JOIN lpr ON lpr.doc_id = m.doc_id LEFT JOIN hpr ON hpr.doc_id = m.doc_id LEFT JOIN qpr ON qpr.doc_id = m.doc_id"


def _steps(terms):
    return {
        "not_blank": f"{S.strip('m.text')} <> ''", "language": "coalesce(lpr.label = 'en' AND lpr.score >= 0.9, false)", "gopher": _gopher_all, "super_quality": _super_sql(terms).replace("lower(text)", "lower(m.text)"),
        "nsfw": "coalesce(hpr.label = 'safe' AND hpr.score >= 0.95, false)", "toxicity": "true", "quality": "coalesce(qpr.label = 'good' AND qpr.score >= 0.8, false)", "not_empty": "coalesce(c.text, '') <> ''",
    }


def _stage1_sql(terms):
    return f"WITH {_metrics}, {_clean}, {_scores} SELECT c.doc_id, c.text, c.email, c.phone_numbers, c.ip_address {_joined} WHERE " + " AND ".join(f"({e})" for e in _steps(terms).values())


query("stage1", _stage1_sql(X.DOMAIN_TERMS))(lambda s, d: pipeline.stage1(docs(s, d), models=_models(s, d)))
_after = []
for _i, _k in enumerate(_steps(X.DOMAIN_TERMS)):
    _after.append(f"count(*) FILTER (WHERE {' AND '.join(f'({e})' for e in list(_steps(X.DOMAIN_TERMS).values())[: _i + 1])}) AS after_{_k}")
query("retention_report", f"WITH {_metrics}, {_clean}, {_scores} SELECT source, count(*) AS docs, {', '.join(_after)} {_joined} GROUP BY source")(
    lambda s, d: pipeline.retention(docs(s, d), "source", models=_models(s, d))
)
_nt = f"nt AS (SELECT doc_id, url, {S.normalize_whitespace('text')} AS text FROM documents)"
_jm, _jc = S.masked("nt.text")
query("json_lines", f"WITH {_nt}, {_metrics.replace('FROM documents)', 'FROM (SELECT doc_id, source, nt.text, documents.lang, documents.confidence FROM documents JOIN nt USING (doc_id)))')}, {S.naive_bayes(_lang, classify.CHARS, 'l', 'nt')}, {S.naive_bayes(_toxic, classify.WORDS, 'h', 'nt')} SELECT nt.url, {_jm} AS text, lpr.label AS lang, lpr.score AS confidence, {' + '.join(_jc.values())} AS masked FROM nt JOIN m USING (doc_id) JOIN lpr ON lpr.doc_id = nt.doc_id JOIN hpr ON hpr.doc_id = nt.doc_id WHERE nt.text <> '' AND lpr.label = 'en' AND lpr.score >= 0.9 AND hpr.label = 'safe' AND hpr.score >= 0.95 AND {_gopher_all}")(
    lambda s, d: pipeline.json_lines(docs(s, d), Stage1Config(enable_quality=False, enable_toxicity=True), _models(s, d)).select("url", "text", "lang", "confidence", (F.col("pii_counts.email") + F.col("pii_counts.phone_numbers") + F.col("pii_counts.ip_address")).cast("bigint").alias("masked"))
)
_tm, _tc = S.masked("d.text")
query("training_lines", f"WITH {S.naive_bayes(_lang, classify.CHARS, 'l')} SELECT '__label__bad ' || substr(replace({_tm}, chr(10), ' '), 1, 10000) AS value FROM documents d JOIN lpr ON lpr.doc_id = d.doc_id WHERE lpr.label = 'en' AND lpr.score >= 0.9 AND {S.strip('d.text')} <> ''")(
    lambda s, d: pipeline.training_lines(docs(s, d), Stage1Config(enable_quality=False, enable_nsfw=False), pipeline.Models(classify.train(docs(s, d), _langs(s, d), classify.CHARS)), good=False)
)
_g2 = f"{S.grams_cte('ld', N)}, {_clusters_sql(S.EXACT_CAND)}"
query("stage2", f"WITH RECURSIVE {_once}, {_g2} SELECT doc_id, {S.collapse('text')} AS text FROM ld WHERE doc_id NOT IN (SELECT doc_id FROM clu WHERE doc_id <> cluster)")(lambda s, d: pipeline.stage2(docs(s, d)))
