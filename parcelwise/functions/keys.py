"""Deterministic pseudo-random draws from row keys.

Draws depend on the key's content alone, so they do not change with the
partitioning, a retried task or the cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_text(columns: list[str]) -> Column:
    """Integer key columns joined by '|'; a null part is written as '~'."""
    return F.concat_ws(
        "|", *[F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit("~")) for c in columns]
    )


def draw(key: Column, modulus: int, seed: int) -> Column:
    """An integer in [0, modulus), from the first 32 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % modulus).cast("int")


def unit_draw(*columns: Column) -> Column:
    """A double in [0, 1), from the upper 53 bits of a 64-bit hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return bits.cast("double") / F.lit(float(2**53))
