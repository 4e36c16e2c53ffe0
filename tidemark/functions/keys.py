"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_RANGE = 10_000_000


def hash_key(value) -> Column:
    """MD5 of the text as a 128-bit number, modulo 10 million.

    The digest does not fit a long, so its four 32-bit pieces are folded in
    with the remainder carried along: exact, and inside generated code.
    """
    digest = F.md5(F.col(value) if isinstance(value, str) else value)
    total = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        piece = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        total = (total * F.lit(2**32) + piece) % F.lit(KEY_RANGE)
    return total


def row_key(*columns: str) -> Column:
    """A repeatable id for rows without one, from their content."""
    return F.xxhash64(*[F.col(c) for c in columns])
