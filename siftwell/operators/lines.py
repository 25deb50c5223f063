"""Line rules and corpus-wide exact line deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell import lexicons as X
from siftwell.functions import text as T

ASCII_WS = r"[\t-\r ]"
SPACES = "\t\n\v\f\r "  # the same, one by one


def _any(low: Column, terms) -> Column:
    import re

    return low.rlike("|".join(re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", t) for t in terms))


def line_rules(line: Column, min_words: int = 3, max_chars: int = 500, blacklist=X.LINE_BLACKLIST) -> dict[str, Column]:
    """Conditions under which a line is dropped, by name."""
    low = F.lower(T.strip(line))
    words = F.size(T.words(low))
    chars = F.greatest(F.length(line), F.lit(1))
    marks = T.count_class(line, r"[^\p{L}\p{N}\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
    return {
        "words": words < min_words,
        "long": F.length(line) > max_chars,
        "blacklist": _any(low, blacklist),
        "tag": line.contains("<"),
        "link": low.contains("http://") | low.contains("https://"),
        "marks": 2 * marks > F.greatest(words, F.lit(1)),
        "digits": 5 * T.count_class(line, r"\p{Nd}") > chars,
        "foreign": 5 * T.count_class(line, r"[^\x{00}-\x{7f}]") > chars,
    }


def dropped(line: Column, **kw) -> Column:
    out = F.lit(False)
    for r in line_rules(line, **kw).values():
        out = out | r
    return out


def filter_lines(c: Column, **kw) -> Column:
    """The lines of a text that no rule drops, joined by line feeds."""
    return F.array_join(F.filter(T.lines(c), lambda x: F.exists(F.array(x), lambda y: ~dropped(y, **kw))), "\n")


def feed_lines(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, line_no from 0, line, stripped) of every line between line feeds."""
    out = df.select(key, F.posexplode(T.feed_lines(F.col(column))).alias("line_no", "line"))
    return out.withColumn("stripped", F.btrim("line", F.lit(SPACES)))


def line_counts(lines: DataFrame) -> DataFrame:
    """(h, cnt): occurrences of each stripped line in the corpus, by hash; summed before the shuffle."""
    return lines.groupBy(F.sha2("stripped", 256).alias("h")).agg(F.count("*").alias("cnt"))


def exact_line_dedup(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, text) without any line that occurs more than once in the corpus.

    Documents whose lines all go stay with an empty text; null texts too.  Only
    hashes and places of lines are shuffled; each document is then joined to the
    places of the lines it keeps.  Blank lines, the hottest of all, are counted
    by one sum instead of by their hash.
    """
    raw = feed_lines(df, key, column)
    places = raw.select(key, "line_no", F.sha2("stripped", 256).alias("h"), (F.col("stripped") == "").alias("blank"))
    filled = places.where(~F.col("blank")).groupBy("h").agg(F.count("*").alias("n"), F.min(key).alias(key), F.min("line_no").alias("line_no")).where("n = 1").select(key, "line_no")
    blank = places.where("blank").agg(F.count("*").alias("n"), F.min(key).alias(key), F.min("line_no").alias("line_no")).where("n = 1").select(key, "line_no")
    kept = filled.unionByName(blank).groupBy(key).agg(F.array_sort(F.collect_list("line_no")).alias("_kept"))
    lines = T.feed_lines(F.col(column))
    # The lines are bound once: written into the inner function, they would be split anew for every line.
    text = F.element_at(F.transform(F.array(lines), lambda bound: F.array_join(F.transform("_kept", lambda i: F.element_at(bound, i + 1)), "\n")), 1)
    return df.select(key, column).join(kept, key, "left").select(key, F.coalesce(text, F.lit("")).alias(column))


def exact_doc_dedup(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, copies) of the smallest key of each text; null texts are one of their own."""
    return df.groupBy(F.sha2(F.col(column), 256).alias("_h")).agg(F.min(key).alias(key), F.count("*").alias("copies")).drop("_h")
