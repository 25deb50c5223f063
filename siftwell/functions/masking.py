"""Masking of mail addresses, phone numbers and network addresses by patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell import lexicons as X


def mask_one(c: Column, kind: str) -> tuple[Column, Column]:
    """(masked text, number of matches) for ``email``, ``phone_numbers`` or ``ip_address``."""
    pattern, token = next((p, t) for k, p, t in X.MASKS if k == kind)
    return F.regexp_replace(c, pattern, token), F.size(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))).cast("bigint")


def mask(c: Column, masks=X.MASKS) -> tuple[Column, dict[str, Column]]:
    """Masked text and counts; each pattern sees what the ones before it left."""
    counts: dict[str, Column] = {}
    for kind, pattern, token in masks:
        counts[kind] = F.when(c.isNotNull(), F.size(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)))).cast("bigint")
        c = F.regexp_replace(c, pattern, token)
    return c, counts
