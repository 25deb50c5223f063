"""Per-document statistics of words, symbols and lines, with the structural profile.

Counts are over the whole text, the profile over the body of the page.  A null
text has null statistics, an empty one zeros; neither is prose.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.boilerplate import by_site, fit_templates, site
from siftwell.llm.residue import body_of, is_residue
from siftwell.llm.structure import NAMES, nearest_profiles, structure

FIELDS = "prose_chars int, other_chars int, profile string, residue boolean"


def _profiles(pdf, ts, _):
    bodies = [body_of(x, h, t) if x else [] for x, h, t in zip(pdf["text"], pdf["site"], ts)]
    bodies = [[y for _, y in b] for b in bodies]
    flat = [y for b in bodies for y in b]
    profiles = nearest_profiles(flat)
    rows, at = [], 0
    for d, b in zip(pdf["doc_id"], bodies):
        prose, other, top = structure(b, profiles[at : at + len(b)])
        at += len(b)
        name = None if not prose and not other else NAMES[top] if other > prose else "prose"
        rows.append((d, prose, other, name, is_residue(b)))
    return pd.DataFrame(rows, columns=["doc_id", "prose_chars", "other_chars", "profile", "residue"])


def profiles(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, characters of prose and of other structures in the body, profile, and whether it is residue."""
    rows = documents.select("doc_id", "text", site(F.col("url")).alias("site"))
    return by_site(rows, fit_templates(pages), _profiles, f"doc_id long, {FIELDS}")


def not_prose(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id of documents whose body is for the greater part a list, a table, machine output or junk."""
    rows = profiles(documents, pages)
    return rows.where((F.col("other_chars") > F.col("prose_chars")) & ~F.col("residue")).select("doc_id")


# Common words of the languages at hand.
COMMON_WORDS = r"\b(?:the|of|and|to|in|der|die|und|das|den|la|de|el|que|le|les|et|il|di|che|o|os|da|e|y|и|в|на)\b"


def counts(documents: DataFrame) -> DataFrame:
    """Basic statistics, in built-in expressions: words are runs of letters and digits, lines end at line feeds."""
    t = F.col("text")
    words = F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    n = F.size(words)
    chars = F.length(t)
    lines = F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "\n", -1))
    filled = F.filter(lines, lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != "")
    ended = F.size(F.filter(filled, lambda x: x.rlike(r"[.!?…][\"')»“”]*\s*$")))
    ratio = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(F.lit(0.0)), 6)
    letters = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]+", ""))
    symbols = F.length(F.regexp_replace(t, r"[\p{L}\p{N}\s]+", ""))
    common = F.size(F.regexp_extract_all(F.lower(t), F.lit(f"({COMMON_WORDS})"), F.lit(1)))
    some = F.when(t.isNull(), F.lit(None))
    return documents.select(
        "doc_id",
        some.otherwise(n).cast("bigint").alias("n_words"),
        some.otherwise(ratio(letters, n)).alias("mean_word_length"),
        some.otherwise(ratio(symbols, chars)).alias("symbol_ratio"),
        some.otherwise(F.size(filled)).cast("bigint").alias("n_lines"),
        some.otherwise(ratio(ended, F.size(filled))).alias("ended_line_share"),
        some.otherwise(ratio(common, n)).alias("common_word_share"),
    )


def statistics(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """counts() with the profile of each document and whether it is natural prose."""
    p = profiles(documents, pages)
    prose = (F.col("prose_chars") > 0) & (F.col("prose_chars") >= F.col("other_chars")) & ~F.col("residue")
    return counts(documents).join(p, "doc_id").withColumn("is_prose", prose).drop("residue")
