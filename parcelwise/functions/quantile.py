"""Exact quantiles of a column too large to sort or to hold in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import stage

BINS = 4096
# The sketch's ranks are right to one part in ACCURACY of all rows.
ACCURACY = 10_000


def _histogram(counted: DataFrame, value: Column, low: float, high: float) -> list:
    """Rows per bin with the bin's own extremes: at most ``BINS`` small rows."""
    position = F.floor((value - F.lit(low)) / F.lit(high - low) * BINS)
    return (
        counted.filter(value.between(low, high))
        .groupBy(F.least(position, F.lit(BINS - 1)).alias("bin"))
        .agg(F.sum("n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        .orderBy("bin")
        .collect()
    )


def _bracket(known: DataFrame, value: Column, share: float) -> tuple:
    """Two values around the quantile, from a sketch; the extremes; and the rows counted."""
    margin = 2 / ACCURACY
    ends = F.array(F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin)))
    low, high, n, ends = known.agg(
        F.min(value), F.max(value), F.count("*"), F.percentile_approx(value, ends, ACCURACY)
    ).first()
    # Ranks of few rows are closer to each other than the margin's rounding.
    wide = n <= ACCURACY
    first = low if wide or share <= margin else ends[0]
    last = high if wide or share >= 1 - margin else ends[1]
    return first, last, low, high, n


def _counts(known: DataFrame, value: Column, first: float, last: float) -> tuple[DataFrame, int, int]:
    """The values from ``first`` to ``last`` with their numbers of rows, stored; how many rows
    are below them, and how many among them. All rows below are one group of each task."""
    inside = F.when(value >= F.lit(first), value)
    counted = known.filter(value <= F.lit(last)).groupBy(inside.alias("value")).agg(F.count("*").alias("n"))
    counted = stage(counted, "bracket")
    sums = counted.agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    ).first()
    return counted.filter("value IS NOT NULL"), sums[0] or 0, sums[1] or 0


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """Quantile with linear interpolation between the two neighbouring values.

    Two scans of ``df``: a mergeable sketch of ranks brackets the wanted ones, then the
    values in the bracket, some four in ``ACCURACY``, are counted and stored, and all others
    below it only counted. Should a rank lie outside, the bracket becomes the whole range
    and takes a third scan, so the result never depends on the sketch. Rounds of histograms
    of the stored values then narrow the bracket at least ``BINS``-fold each; only bin counts
    reach the driver. NaN counts as missing.
    """
    value = F.col(column)
    known = df.filter(value.isNotNull() & ~F.isnan(value.cast("double"))).select(column)
    low, high, least, most, n = _bracket(known, value, share)
    if not n:
        return None
    rank = share * (n - 1)
    first = math.floor(rank)
    second = min(first + 1, n - 1)
    counted, below, inside = _counts(known, value, low, high)
    if not below <= first <= second < below + inside:
        low, high = least, most
        counted, below, inside = _counts(known, value, low, high)
    value = F.col("value")
    while low < high:
        start, found = below, {}
        for row in _histogram(counted, value, low, high):
            for wanted in (first, second):
                if start <= wanted < start + row["n"]:
                    found[wanted] = (start, row)
            start += row["n"]
        (start_first, bin_first), (start_second, bin_second) = found[first], found[second]
        if start_first != start_second:
            # Neighbouring ranks in two bins: the end of one, the start of the next.
            low, high = bin_first["high"], bin_second["low"]
            return low + (high - low) * (rank - first)
        below, low, high = start_first, bin_first["low"], bin_first["high"]
        if bin_first["n"] == 2 and first != second:
            return low + (high - low) * (rank - first)
    return float(low)
