"""Building blocks of the SQL equivalents, from the same patterns and lists."""

from __future__ import annotations

from siftwell import lexicons as X
from siftwell.operators.dedup import PRIME, coefficients


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rep(expr: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(to)}, 'g')"


def strip(e: str) -> str:
    return rep(e, rf"\A{X.WS}+|{X.WS}+\z")


def collapse(e: str) -> str:
    return f"trim({rep(e, X.WS + '+', ' ')})"


def lines(e: str) -> str:
    return f"CASE WHEN {e} = '' THEN []::VARCHAR[] WHEN {e} IS NOT NULL THEN regexp_split_to_array(regexp_replace({e}, {q(rf'(?:{X.BREAK})' + chr(92) + 'z')}, ''), {q(X.BREAK)}) END"


def feed_lines(e: str) -> str:
    return f"CASE WHEN {e} = '' THEN []::VARCHAR[] WHEN {e} IS NOT NULL THEN string_split(regexp_replace({e}, '\\n\\z', ''), chr(10)) END"


def tokens(e: str) -> str:
    return f"regexp_extract_all({e}, {q(X.WORD_TOKEN)})"


def words(e: str) -> str:
    return f"list_filter(string_split({collapse(e)}, ' '), lambda x: x <> '')"


def count_class(e: str, c: str) -> str:
    return f"(length({e}) - length({rep(e, c)}))"


def matches(e: str, p: str) -> str:
    return f"len(regexp_extract_all({e}, {q(p)}))"


def normalize_whitespace(e: str) -> str:
    return f"array_to_string(list_filter(list_transform({lines(e)}, lambda x: {strip('x')}), lambda x: x <> ''), chr(10))"


def masked(e: str) -> tuple[str, dict[str, str]]:
    counts = {}
    for kind, pattern, token in X.MASKS:
        counts[kind] = matches(e, pattern)
        e = rep(e, pattern, token)
    return e, counts


def grams_text(e: str) -> str:
    e = f"strip_accents({rep(f'lower({e})', X.WS + '+', ' ')})"
    e = f"translate({rep(e, '[' + chr(92) + 'p{Mn}' + chr(92) + 'p{C}]+')}, {q(X.ASCII_PUNCTUATION)}, '')"
    return collapse(e)


def grams_cte(source: str, n: int, key: str = "doc_id", column: str = "text") -> str:
    return f"""gw AS (SELECT {key}, list_filter(string_split({grams_text(f"coalesce({column}, '')")}, ' '), lambda x: x <> '') AS w FROM {source}),
gg AS (SELECT {key}, CASE WHEN len(w) < {n} THEN []::VARCHAR[] ELSE list_distinct(list_transform(generate_series(1, len(w) - {n - 1}), lambda i: array_to_string(w[i:i+{n - 1}], ' '))) END AS grams FROM gw),
gs AS (SELECT {key}, grams, sha256(array_to_string(list_sort(grams), chr(31))) AS s FROM gg WHERE len(grams) > 0),
gr AS (SELECT s, min({key}) AS rep FROM gs GROUP BY s),
gm AS (SELECT {key}, rep FROM gs JOIN gr USING (s)),
reps AS (SELECT gr.rep, gs.grams FROM gr JOIN gs ON gs.{key} = gr.rep)"""


def minhash_cte(num_hashes: int, source: str = "reps", key: str = "rep") -> str:
    mins = ", ".join(f"min(({a} * x + {b}) % {PRIME})" for a, b in coefficients(num_hashes))
    return f"""hx AS (SELECT {key}, ('0x' || substr(md5(g), 1, 8))::BIGINT AS x FROM (SELECT {key}, unnest(grams) AS g FROM {source})),
sig AS (SELECT {key}, [{mins}] AS signature FROM hx GROUP BY {key})"""


def bands_cte(num_hashes: int, num_bands: int, key: str = "rep") -> str:
    size = num_hashes // num_bands
    return f"""bd AS (SELECT {key}, b AS band_no, array_to_string(list_slice(signature, b * {size} + 1, (b + 1) * {size}), ',') AS band FROM sig, range({num_bands}) t(b)),
cand AS (SELECT DISTINCT x.{key} AS src, y.{key} AS dst FROM bd x JOIN bd y ON x.band_no = y.band_no AND x.band = y.band AND x.{key} < y.{key})"""


VERIFY = """vx AS (SELECT src, dst, len(list_intersect(a.grams, b.grams)) AS inter, len(a.grams) + len(b.grams) AS sz FROM cand JOIN reps a ON a.rep = src JOIN reps b ON b.rep = dst),
pairs AS (SELECT src, dst, inter, sz - inter AS total FROM vx WHERE inter * 10 >= (sz - inter) * 8)"""

LINKS = """ln AS (SELECT src AS u, dst AS v FROM pairs UNION SELECT dst, src FROM pairs),
rc(u, v) AS (SELECT DISTINCT u, u FROM ln UNION SELECT rc.u, ln.v FROM rc JOIN ln ON rc.v = ln.u),
lab AS (SELECT u AS rep, min(v) AS label FROM rc GROUP BY u)"""


def clusters_cte(key: str = "doc_id") -> str:
    return f"""cj AS (SELECT {key}, coalesce(label, rep) AS cluster FROM gm LEFT JOIN lab USING (rep)),
clu AS (SELECT {key}, cluster FROM cj WHERE cluster IN (SELECT cluster FROM cj GROUP BY cluster HAVING count(*) > 1))"""


EXACT_CAND = "cand AS (SELECT DISTINCT x.rep AS src, y.rep AS dst FROM (SELECT rep, unnest(grams) AS g FROM reps) x JOIN (SELECT rep, unnest(grams) AS g FROM reps) y ON x.g = y.g AND x.rep < y.rep)"


def verify(tenths: int = 8) -> str:
    return VERIFY.replace("* 8)", f"* {tenths})")


def features_cte(p: str, source: str, kind: str, n: int, buckets: int) -> str:
    """{p}tn (doc_id, bucket, n): hashed features of the texts of ``source`` (doc_id, text)."""
    pieces = "[token]" if kind == "words" else f"flatten(list_transform(generate_series(1, {n}), lambda k: list_transform(generate_series(1, length(token) + 3 - k), lambda i: substr('<' || token || '>', i, k))))"
    return f"""{p}t0 AS (SELECT doc_id, unnest({tokens("lower(text)")}) AS token FROM {source} WHERE text IS NOT NULL),
{p}t1 AS (SELECT doc_id, token, count(*) AS n FROM {p}t0 WHERE regexp_matches(token, '\\p{{L}}') GROUP BY ALL),
{p}g AS (SELECT token, unnest({pieces}) AS g FROM (SELECT DISTINCT token FROM {p}t1)),
{p}v AS (SELECT token, ('0x' || substr(md5(g), 1, 8))::BIGINT % {buckets} AS bucket, count(*) AS k FROM {p}g GROUP BY ALL),
{p}tn AS (SELECT doc_id, bucket, sum(n * k)::BIGINT AS n FROM {p}t1 JOIN {p}v USING (token) GROUP BY ALL)"""


def naive_bayes(labels: str, features, p: str = "", source: str = "documents", digits: int = 4) -> str:
    """CTEs of classify(): ``labels`` selects (doc_id, label); {p}pr (doc_id, label, score) are the texts of ``source``."""
    of = lambda q, s: features_cte(q, s, features.kind, features.n, features.buckets)
    t = p if source == "documents" else p + "s"
    return f"""{p}lb AS ({labels}),
{of(p, "documents")},{"" if t == p else chr(10) + of(t, source) + ","}
{p}per AS (SELECT label, bucket, sum(n)::BIGINT AS n FROM {p}tn JOIN {p}lb USING (doc_id) GROUP BY ALL),
{p}tot AS (SELECT label, sum(n)::BIGINT AS total FROM {p}per GROUP BY label),
{p}dc AS (SELECT label, count(*) AS docs FROM {p}lb GROUP BY label),
{p}mo AS (SELECT label, ln(docs / (SELECT sum(docs) FROM {p}dc)) AS prior, ln(1.0::DOUBLE / (total + {features.buckets})) AS base FROM {p}dc JOIN {p}tot USING (label)),
{p}le AS (SELECT doc_id, sum(n)::BIGINT AS length FROM {t}tn GROUP BY doc_id),
{p}se AS (SELECT x.doc_id, y.label, sum(x.n * ln(y.n + 1.0::DOUBLE)) AS s FROM {t}tn x JOIN {p}per y USING (bucket) GROUP BY ALL),
{p}sc AS (SELECT le.doc_id, mo.label, prior + length * base + coalesce(s, 0) AS s FROM {p}le le CROSS JOIN {p}mo mo LEFT JOIN {p}se se ON se.doc_id = le.doc_id AND se.label = mo.label),
{p}tp AS (SELECT doc_id, max(s) AS top FROM {p}sc GROUP BY doc_id),
{p}pr AS (SELECT doc_id, min(label) FILTER (WHERE s >= top - 1e-9) AS label, round(1 / sum(exp(s - top)), {digits}) AS score FROM {p}sc JOIN {p}tp USING (doc_id) GROUP BY doc_id)"""


HELD_OUT = "('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::BIGINT % 10 < 2"


def evaluate(labels: str, features) -> str:
    """SQL of evaluate()."""
    return f"""WITH lall AS ({labels}), {naive_bayes(f"SELECT doc_id, label FROM lall WHERE NOT ({HELD_OUT})", features)},
te AS (SELECT pr.label AS said, lall.label AS label FROM pr JOIN lall USING (doc_id) WHERE {HELD_OUT}),
a AS (SELECT label, count(*) AS docs, count(*) FILTER (WHERE said = label) AS r FROM te GROUP BY label), b AS (SELECT said AS label, count(*) AS said FROM te GROUP BY said)
SELECT coalesce(a.label, b.label) AS label, coalesce(docs, 0) AS docs, coalesce(r, 0) AS "right", coalesce(said, 0) AS said FROM a FULL JOIN b ON a.label = b.label"""
