"""Command line: ``python -m siftwell.cli train|stage1|stage2|stage3 --input PATH --output PATH``."""

from __future__ import annotations

import argparse

from siftwell.config import DedupConfig, Stage1Config
from siftwell.operators import classify, tokens
from siftwell.plans import pipeline
from siftwell.session import session
from siftwell.sources import html, text_files, warc


CLASSIFIERS = ("language", "nsfw", "toxicity", "quality")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftwell")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="stage", required=True)
    zero = sub.add_parser("train", help="fit a classifier on labelled lines")
    one = sub.add_parser("stage1", help="read archives or documents, filter and clean")
    two = sub.add_parser("stage2", help="deduplicate lines and documents")
    three = sub.add_parser("stage3", help="encode into packed files")
    for s in (zero, one, two, three):
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)
    f = classify.WORDS
    zero.add_argument("--kind", choices=("words", "chars"), default=f.kind)
    zero.add_argument("--n", type=int, default=f.n, help="longest run of characters, for chars")
    zero.add_argument("--buckets", type=int, default=f.buckets)
    zero.add_argument("--alpha", type=float, default=f.alpha)
    zero.add_argument("--held_out_tenths", type=int, default=2)
    s1 = Stage1Config()
    for name in CLASSIFIERS:
        one.add_argument(f"--{name}_model", help="file of a fitted classifier; without it the step is off")
        if name != "language":
            one.add_argument(f"--{name}_threshold", type=float, default=getattr(s1, f"{name}_threshold"))
    one.add_argument("--no_super_quality", action="store_true")
    one.add_argument("--format", choices=("parquet", "warc", "wet"), default="parquet")
    one.add_argument("--lang", default=s1.lang)
    one.add_argument("--confidence", type=float, default=s1.confidence)
    one.add_argument("--min_words", type=int, default=s1.min_words)
    s2 = DedupConfig()
    two.add_argument("--num_hashes", type=int, default=s2.num_hashes)
    two.add_argument("--num_bands", type=int, default=s2.num_bands)
    two.add_argument("--num_grams", type=int, default=s2.num_grams)
    two.add_argument("--jaccard_threshold", type=float, default=s2.threshold_tenths / 10)
    return p


def read_archives(spark, path: str, format: str):
    """Every record of the archives with its text, and the rows that tell of broken files."""
    from pyspark.sql import functions as F

    warc.register(spark)
    kind = "response" if format == "warc" else "conversion"
    rows = spark.read.format("warc").option("types", kind).load(path)
    if format == "warc":
        rows = rows.where(F.col("error").isNotNull() | F.col("http_content_type").isNull() | F.col("http_content_type").contains("text/html"))
        return html.extract_text(rows, "content")
    return rows.withColumn("text", F.decode(F.expr("make_valid_utf8(cast(content as string))").cast("binary"), "UTF-8"))


def read_documents(spark, path: str, format: str):
    """Documents with keys; archives get a stable key from their file and the place in it."""
    from pyspark.sql import functions as F

    if format == "parquet":
        return spark.read.parquet(path)
    rows = read_archives(spark, path, format).where("error is null")
    return rows.select(F.xxhash64("source_file", "record_no").alias("doc_id"), "text", "url", "source_file")


def stage1(spark, a) -> None:
    found = {name: getattr(a, f"{name}_model") for name in CLASSIFIERS}
    on = {f"enable_{name}": path is not None for name, path in found.items()}
    thresholds = {f"{name}_threshold": getattr(a, f"{name}_threshold") for name in CLASSIFIERS if name != "language"}
    config = Stage1Config(lang=a.lang, confidence=a.confidence, min_words=a.min_words, enable_super_quality=not a.no_super_quality, **on, **thresholds)
    models = pipeline.Models(**{name: classify.load(path) for name, path in found.items() if path})
    archives = a.format != "parquet"
    out = pipeline.stage1(read_documents(spark, a.input, a.format), config, models, extra=("source_file",) if archives else ())
    out.write.mode("overwrite").parquet(a.output)
    if archives:
        rows = spark.read.format("warc").load(a.input)
        warc.audit(rows, spark.read.parquet(a.output)).write.mode("overwrite").parquet(a.output.rstrip("/") + "_audit")


def train(spark, a) -> None:
    df, labels = classify.labelled_lines(spark.read.text(a.input))
    features = classify.Features(a.kind, a.n, a.buckets, a.alpha)
    for r in classify.evaluate(df, labels, features, tenths=a.held_out_tenths).orderBy("label").collect():  # a row per label
        print(f"{r['label']}: {r['right']} of {r['docs']} held-out documents found, {r['said']} given the label")
    classify.save(classify.train(df, labels, features), a.output)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = session(a.master)
    if a.stage == "train":
        train(spark, a)
    elif a.stage == "stage1":
        stage1(spark, a)
    elif a.stage == "stage2":
        tenths = round(a.jaccard_threshold * 10)
        if abs(tenths - a.jaccard_threshold * 10) > 1e-9:
            raise SystemExit("the threshold is given in tenths")
        config = DedupConfig(a.num_hashes, a.num_bands, a.num_grams, tenths)
        pipeline.stage2(spark.read.parquet(a.input), config).write.mode("overwrite").parquet(a.output)
        text_files.write_lines(spark.read.parquet(a.output), a.output.rstrip("/") + "_lines")
    else:
        tokens.write_packed(tokens.token_stream(spark.read.parquet(a.input)), a.output)


if __name__ == "__main__":
    main()
