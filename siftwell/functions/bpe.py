"""Byte-pair token counts and ids with the vocabulary files of a public tokenizer."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
EOS = 50256
# Fixed value: the published pattern that cuts a text into pieces before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 400_000


def read_vocabulary(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> bytes:
    with open(os.path.join(folder, vocabulary), "rb") as f:
        return f.read()


@lru_cache(2)
def encoding(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The encoding of a vocabulary of ranks, from its file."""
    return encoding_of(vocabulary, read_vocabulary(folder, vocabulary))


@lru_cache(2)
def encoding_of(name: str, content: bytes):
    """The encoding of the ranks in the content of a file."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def shipped(folder: str, vocabulary: str):
    """A function that gives the encoding on any executor: the file is read on the driver and broadcast (about a megabyte)."""
    held = SparkSession.active().sparkContext.broadcast((vocabulary, read_vocabulary(folder, vocabulary)))
    return lambda: encoding_of(*held.value)


_pieces = regex.compile(PATTERN)
_counts: dict[str, dict[str, int]] = {}


def count_with(enc, text: str) -> int:
    """Tokens of a text.  Merges never cross pieces, so counts of pieces are kept."""
    known = _counts.setdefault(enc.name, {})
    total = 0
    for p in _pieces.findall(text):
        n = known.get(p)
        if n is None:
            if len(known) > CACHE:
                known.clear()
            n = len(enc.encode_ordinary(p))
            if len(p) < 64:
                known[p] = n
        total += n
    return total


def count(text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> int:
    """Tokens of a text."""
    return count_with(encoding(folder, vocabulary), text)


def token_counts(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """Arrow UDF: tokens of each text; 0 for null."""
    give = shipped(folder, vocabulary)

    def run(texts: pd.Series) -> pd.Series:
        enc = give()
        return pd.Series([count_with(enc, x) if x else 0 for x in texts], dtype="int64")

    return F.pandas_udf(run, "bigint")


def token_ids(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, eos: int | None = EOS):
    """Arrow UDF: token ids of each text, with an end mark; null for null."""
    give = shipped(folder, vocabulary)

    def run(texts: pd.Series) -> pd.Series:
        enc = give()
        end = [] if eos is None else [eos]
        return pd.Series([None if x is None else enc.encode_ordinary(x) + end for x in texts], dtype=object)

    return F.pandas_udf(run, "array<int>")
