"""Document rules as metric columns with predicates on top; ratios are compared in whole numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell import lexicons as X
from siftwell.functions import text as T

GOPHER = ("n_tokens", "token_chars", "alpha_tokens", "symbol_tokens", "stop_hits", "n_lines", "ellipsis_lines")
SUPER = ("distinct_tokens", "n_words", "noise_words", "punctuation_chars", "n_chars_all", "digit_tokens", "domain_hits")


def _n(c: Column) -> Column:
    return c.cast("bigint")


def _gopher(t: Column, tok: Column, lin: Column, stop_words) -> dict[str, Column]:
    return {
        "n_tokens": F.size(tok),
        "token_chars": F.length(F.array_join(tok, "")),
        "alpha_tokens": F.size(F.filter(tok, lambda x: x.rlike(r"\p{L}"))),
        "symbol_tokens": F.size(F.filter(tok, lambda x: x.isin("#", "..."))),
        "stop_hits": F.size(F.filter(tok, lambda x: F.lower(x).isin(*stop_words))),
        "n_lines": F.size(lin),
        "ellipsis_lines": F.size(F.filter(lin, lambda x: T.strip(x).endswith("..."))),
    }


def _super(t: Column, tok: Column, terms) -> dict[str, Column]:
    low = F.lower(t)
    # Bound once: written out for each term, the text would be lower-cased anew for every one.
    hits = F.element_at(F.transform(F.array(low), lambda x: sum((x.contains(term).cast("int") for term in terms), F.lit(0))), 1)
    words = T.words(t)
    return {
        "distinct_tokens": F.size(F.array_distinct(tok)),
        "n_words": F.size(words),
        "noise_words": F.size(F.filter(words, lambda x: x.rlike(X.HTML_NOISE))),
        "punctuation_chars": T.count_class(t, r"[^\p{L}\p{N}\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"),
        "n_chars_all": F.length(t),
        "digit_tokens": F.size(F.filter(tok, lambda x: x.rlike(r"\p{Nd}"))),
        "domain_hits": hits if terms else F.lit(0),
    }


def metrics(df: DataFrame, column: str = "text", stop_words=X.STOP_WORDS, terms=X.DOMAIN_TERMS) -> DataFrame:
    """The frame with the counts that the rules rest on; a null text counts as empty.

    The counts are one struct of one generated row, with tokens and lines bound
    once: a filter above it is not pushed through, which would write the whole
    tokenizer into each of its conditions.
    """
    t = F.coalesce(F.col(column), F.lit(""))
    bound = F.array(F.struct(t.alias("t"), T.tokens(t).alias("tok"), T.lines(t).alias("lin")))
    counts = lambda b: {**_gopher(b["t"], b["tok"], b["lin"], stop_words), **_super(b["t"], b["tok"], terms)}
    rows = F.transform(bound, lambda b: F.struct(*[_n(c).alias(k) for k, c in counts(b).items()]))
    kept = [c for c in df.columns if c not in GOPHER + SUPER]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.explode(rows).alias("_m")).select(*[F.col(f"`{c}`") for c in kept], "_m.*")


def gopher_rules() -> dict[str, Column]:
    """Predicates over the metrics, by the name of the reason for which a document fails."""
    n = F.col("n_tokens")
    return {
        "length": (n >= 50) & (n <= 100_000),
        "mean_length": (F.col("token_chars") >= 3 * n) & (F.col("token_chars") <= 10 * n),
        "alphabetic": 10 * F.col("alpha_tokens") >= 8 * n,
        "symbols": 10 * F.col("symbol_tokens") <= n,
        "stop_words": F.col("stop_hits") >= 2,
        "ellipsis": (F.col("n_lines") > 0) & (10 * F.col("ellipsis_lines") <= 3 * F.col("n_lines")),
    }


def all_of(rules: dict[str, Column]) -> Column:
    out = F.lit(True)
    for r in rules.values():
        out = out & r
    return out


def reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules that fail, joined by commas."""
    return F.concat_ws(",", *[F.when(~r, F.lit(k)) for k, r in rules.items()])


def super_rules() -> dict[str, Column]:
    n = F.col("n_tokens")
    return {
        "diversity": 10 * F.col("distinct_tokens") >= 3 * n,
        "html_noise": 1000 * F.col("noise_words") < 5 * F.greatest(F.col("n_words"), F.lit(1)),
        "punctuation": (F.col("n_chars_all") > 0) & (10 * F.col("punctuation_chars") <= 2 * F.col("n_chars_all")),
        "numeric": 10 * F.col("digit_tokens") <= n,
        "domain": F.col("domain_hits") >= 2,
    }


def gopher_filter(df: DataFrame, column: str = "text") -> DataFrame:
    """Documents that keep all Gopher rules, without the metrics."""
    return metrics(df, column, terms=()).where(all_of(gopher_rules())).select(*[F.col(f"`{c}`") for c in df.columns])


def super_quality_filter(df: DataFrame, column: str = "text", terms=X.DOMAIN_TERMS) -> DataFrame:
    """Documents that keep the Gopher rules and the stricter ones."""
    return metrics(df, column, terms=terms).where(all_of(gopher_rules()) & all_of(super_rules())).select(*[F.col(f"`{c}`") for c in df.columns])
