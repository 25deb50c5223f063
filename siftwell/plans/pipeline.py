"""The stages: filter and clean, deduplicate, encode; with an audit of what was kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell import lexicons as X
from siftwell.config import DedupConfig, Stage1Config
from siftwell.functions import masking
from siftwell.functions import text as T
from siftwell.operators import classify, dedup, lines, quality

STEPS = ("not_blank", "language", "gopher", "super_quality", "nsfw", "toxicity", "quality", "not_empty")


@dataclass(frozen=True)
class Models:
    """The classifiers of the stage.  A step whose classifier is missing has to be switched off in the configuration."""

    language: classify.Model | None = None
    nsfw: classify.Model | None = None
    toxicity: classify.Model | None = None
    quality: classify.Model | None = None


def _needed(config: Stage1Config, models: Models) -> None:
    for name in ("language", "nsfw", "toxicity", "quality"):
        if getattr(config, f"enable_{name}") and getattr(models, name) is None:
            raise ValueError(f"the step {name} is on and has no classifier; give one or set enable_{name}=False")


def _score(df: DataFrame, text: Column, model: classify.Model | None, name: str) -> DataFrame:
    """The frame with the struct ``_name`` of label and score."""
    return df.withColumn(f"_{name}", classify.scored(text, df.sparkSession, model) if model else F.lit(None).cast(f"struct<{classify.FIELDS}>".replace(" ", ":").replace(",:", ",")))


def _is(name: str, on: bool, label: str, threshold: float) -> Column:
    c = F.col(f"_{name}")
    return F.coalesce((c["label"] == label) & (c["score"] >= threshold), F.lit(False)) if on else F.lit(True)


def _passes(config: Stage1Config) -> dict[str, Column]:
    """Condition of each step over the columns that _columns() adds, in order."""
    return {
        "not_blank": F.coalesce(T.strip(F.col("text")) != "", F.lit(False)),
        "language": _is("language", config.enable_language, config.lang, config.confidence),
        "gopher": quality.all_of(quality.gopher_rules()),
        "super_quality": quality.all_of(quality.super_rules()) if config.enable_super_quality else F.lit(True),
        "nsfw": _is("nsfw", config.enable_nsfw, config.safe_label, config.nsfw_threshold),
        "toxicity": _is("toxicity", config.enable_toxicity, config.safe_label, config.toxicity_threshold),
        "quality": _is("quality", config.enable_quality, config.good_label, config.quality_threshold),
        "not_empty": F.coalesce(F.col("clean_text") != "", F.lit(False)),
    }


def _columns(df: DataFrame, config: Stage1Config, models: Models, terms, keep: dict[str, Column] | None) -> DataFrame:
    """Adds what the steps rest on, one after another; with ``keep``, each step sees only what the ones before it kept."""
    _needed(config, models)
    at = lambda d, *names: d.where(_and(keep[n] for n in names)) if keep else d
    d = at(df, "not_blank")
    d = at(_score(d, F.col("text"), models.language if config.enable_language else None, "language"), "language")
    d = at(quality.metrics(d, terms=terms if config.enable_super_quality else ()), "gopher", "super_quality")
    d = at(_score(d, F.col("text"), models.nsfw if config.enable_nsfw else None, "nsfw"), "nsfw")
    d = at(_score(d, F.col("text"), models.toxicity if config.enable_toxicity else None, "toxicity"), "toxicity")
    d = d.withColumn("_filtered", lines.filter_lines(F.col("text"), min_words=config.min_words, max_chars=config.max_chars_per_line))
    d = at(_score(d, F.col("_filtered"), models.quality if config.enable_quality else None, "quality"), "quality")
    clean, counts = masking.mask(F.col("_filtered"))
    d = d.withColumn("clean_text", T.normalize_whitespace(clean))
    for kind, c in counts.items():
        d = d.withColumn(f"masked_{kind}", c)
    return at(d, "not_empty")


def _and(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def flagged(df: DataFrame, config: Stage1Config = Stage1Config(), models: Models = Models(), terms=X.DOMAIN_TERMS) -> DataFrame:
    """Documents with ``clean_text``, counts of masked items and one boolean per step, in order."""
    d = _columns(df, config, models, terms, None)
    counts = [f"masked_{k}" for k, _, _ in X.MASKS]
    return d.select(*[F.col(f"`{c}`") for c in df.columns], "clean_text", *counts, *[c.alias(name) for name, c in _passes(config).items()])


def stage1(df: DataFrame, config: Stage1Config = Stage1Config(), models: Models = Models(), key: str = "doc_id", terms=X.DOMAIN_TERMS, extra: tuple[str, ...] = ()) -> DataFrame:
    """(key, text, counts of masked items) of the documents that pass every step; a step sees only what is left."""
    d = _columns(df, config, models, terms, _passes(config))
    return d.select(key, F.col("clean_text").alias("text"), *[F.col(f"masked_{k}").alias(k) for k, _, _ in X.MASKS], *extra)


def retention(df: DataFrame, by: str, config: Stage1Config = Stage1Config(), models: Models = Models(), terms=X.DOMAIN_TERMS) -> DataFrame:
    """Documents of each group and how many are left after each step."""
    f = flagged(df, config, models, terms)
    keep, aggs = F.lit(True), [F.count("*").alias("docs")]
    for s in STEPS:
        keep = keep & F.col(s)
        aggs.append(F.sum(keep.cast("bigint")).alias(f"after_{s}"))
    return f.groupBy(by).agg(*aggs)


def json_lines(df: DataFrame, config: Stage1Config, models: Models) -> DataFrame:
    """Records of the filtering script: white space first, then language, document rules, both harm classifiers, masking; lines are not filtered."""
    _needed(config, models)
    d = df.withColumn("text", T.normalize_whitespace(F.col("text"))).where(F.col("text") != "")
    d = _score(d, F.col("text"), models.language if config.enable_language else None, "language").where(_is("language", config.enable_language, config.lang, config.confidence))
    d = quality.metrics(d, terms=()).where(quality.all_of(quality.gopher_rules()))
    for name, at in (("nsfw", config.nsfw_threshold), ("toxicity", config.toxicity_threshold)):
        on = getattr(config, f"enable_{name}")
        d = _score(d, F.col("text"), getattr(models, name) if on else None, name).where(_is(name, on, config.safe_label, at))
    masked, counts = masking.mask(F.col("text"))
    counted = F.struct(*[c.cast("int").alias(k) for k, c in counts.items()])
    return d.select(masked.alias("text"), F.col("_language.label").alias("lang"), F.col("_language.score").alias("confidence"), *[c for c in ("url",) if c in df.columns], counted.alias("pii_counts"))


def training_lines(df: DataFrame, config: Stage1Config, models: Models, good: bool, max_len: int = 10_000) -> DataFrame:
    """Labelled lines for the quality classifier: good examples pass the document rules and both harm classifiers, bad ones only the language step."""
    from siftwell.sources.text_files import labelled_line

    _needed(config, models)
    d = df.where(F.coalesce(T.strip(F.col("text")) != "", F.lit(False)))
    d = _score(d, F.col("text"), models.language if config.enable_language else None, "language").where(_is("language", config.enable_language, config.lang, config.confidence))
    if good:
        d = quality.metrics(d, terms=()).where(quality.all_of(quality.gopher_rules()))
        for name, at in (("nsfw", config.nsfw_threshold), ("toxicity", config.toxicity_threshold)):
            on = getattr(config, f"enable_{name}")
            d = _score(d, F.col("text"), getattr(models, name) if on else None, name).where(_is(name, on, config.safe_label, at))
    return d.select(labelled_line(F.lit("good" if good else "bad"), masking.mask(F.col("text"))[0], max_len).alias("value"))


def stage2(df: DataFrame, config: DedupConfig = DedupConfig(), key: str = "doc_id") -> DataFrame:
    """(key, text) after exact line and then fuzzy document deduplication, each document on one line."""
    from siftwell.plans.lineage import cut

    deduped = cut(lines.exact_line_dedup(df, key))
    kw = {"n": config.num_grams, "tenths": config.threshold_tenths}
    found = dedup.clusters(deduped, key=key, **kw) if config.exact else dedup.lsh_clusters(deduped, num_hashes=config.num_hashes, num_bands=config.num_bands, key=key, **kw)
    gone = found.where(F.col(key) != F.col("cluster")).select(key)
    return deduped.join(gone, key, "left_anti").select(key, T.collapse(F.col("text")).alias("text"))
