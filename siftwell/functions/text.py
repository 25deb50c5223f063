"""Column functions on text; null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell import lexicons as X


def strip(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, rf"\A{X.WS}+|{X.WS}+\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{NO_SPACE}{X.WS}+", " "))


# Most characters are told by a few ranges, which costs less than the whole class.
NO_SPACE = r"(?![!-\x{84}\x{a1}-\x{167f}\x{3001}-\x{10ffff}])"


def lines(c: Column) -> Column:
    """Lines at every Unicode line break; a break at the end opens no further line, an empty text has none."""
    parts = F.split(F.regexp_replace(c, rf"(?:{X.BREAK})\z", ""), X.BREAK, -1)
    return F.when(c == "", F.array().cast("array<string>")).when(c.isNotNull(), parts)


def feed_lines(c: Column) -> Column:
    """Lines at line feeds only, without the empty piece after a last one."""
    parts = F.split(F.regexp_replace(c, r"\n\z", ""), "\n", -1)
    return F.when(c == "", F.array().cast("array<string>")).when(c.isNotNull(), parts)


def normalize_whitespace(c: Column) -> Column:
    """Stripped lines that are not empty, joined by line feeds."""
    return F.array_join(F.filter(F.transform(lines(c), strip), lambda x: x != ""), "\n")


def flatten(c: Column) -> Column:
    """Line feeds as blanks."""
    return F.translate(c, "\n", " ")


def truncate(c: Column, n: int = 10_000) -> Column:
    """The first n characters."""
    return F.substring(c, 1, n)


def tokens(c: Column) -> Column:
    """Word and symbol tokens, in a form that Java and RE2 read alike."""
    return F.regexp_extract_all(c, F.lit(X.WORD_TOKEN), F.lit(0))


def words(c: Column) -> Column:
    """Pieces between white space."""
    return F.filter(F.split(collapse(c), " "), lambda x: x != "")


def count_class(c: Column, regex_class: str) -> Column:
    """How many characters belong to a class."""
    return (F.length(c) - F.length(F.regexp_replace(c, regex_class, ""))).cast("bigint")


def normalize_for_grams(c: Column, literal: bool = False) -> Column:
    """Lower case, no accents, no control characters, no ASCII punctuation, single blanks.

    White space is collapsed first, so that words at line ends stay apart;
    ``literal`` deletes control characters first instead.
    """
    out = F.lower(c)
    if not literal:
        out = F.regexp_replace(out, f"{X.WS}+", " ")
    out = unaccent(out)
    out = F.regexp_replace(out, r"[\p{Mn}\p{C}]+", "")
    out = F.translate(out, X.ASCII_PUNCTUATION, "")
    return F.trim(F.regexp_replace(out, f"{X.WS}+", " "))


def _accents() -> tuple[str, str]:
    import unicodedata

    src, dst = [], []
    for i in range(0xC0, 0x10000):
        if 0xAC00 <= i < 0xD800:  # composed syllables come apart into several letters
            continue
        c = chr(i)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if base != c and len(base) == 1:
            src.append(c)
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, PLAIN = _accents()


def unaccent(c: Column) -> Column:
    """Letters without their marks, for those that come apart into one letter and marks."""
    return F.translate(c, ACCENTED, PLAIN)


def ngrams(c: Column, n: int) -> Column:
    """Distinct n-word shingles of a text whose words stand between single blanks; none of fewer words."""
    some = F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda x: x != "")

    def shingles(w: Column) -> Column:
        last = F.size(w) - n + 1
        grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(last < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))

    # The words are bound once: written into the inner function, they would be split anew for every shingle.
    return F.element_at(F.transform(F.array(some), shingles), 1)
