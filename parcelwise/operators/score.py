"""Disruption score of each region-month, 0 to 100.

Half the scaled late share, three tenths of the scaled anomaly rate and a
constant floor of 20. The forecast is not part of the score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import round_half_even

# Weights, floor, value of a constant column, tier bounds.
LATE_WEIGHT = 0.5
ANOMALY_WEIGHT = 0.3
FLOOR = 20
CONSTANT_NORM = 50.0
HIGH_FROM = 70
MEDIUM_FROM = 40

KEYS = ["year_month", "region_name"]


def join_anomaly_rate(monthly: DataFrame, anomalies: DataFrame) -> DataFrame:
    rates = anomalies.select(*KEYS, "anomaly_rate_pct")
    return monthly.join(rates, KEYS, "left").fillna(0.0, ["anomaly_rate_pct"])


def minmax_normalize(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Scale columns to 0..100 over all rows; ``columns`` maps source to new name.

    The extremes are one aggregate row, attached as a scalar subquery, so ``df`` is
    evaluated twice: pass a stored table when it is costly.
    """
    extremes = df.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_low") for c in columns],
            *[F.max(c).alias(f"{c}_high") for c in columns],
        ).alias("extremes")
    )

    def scaled(c: str) -> Column:
        low, high = F.col(f"_extremes.{c}_low"), F.col(f"_extremes.{c}_high")
        return F.when(low == high, F.lit(CONSTANT_NORM)).otherwise(
            (F.col(c) - low) / (high - low) * 100
        )

    return (
        df.withColumn("_extremes", extremes.scalar())
        .withColumns({new: scaled(c) for c, new in columns.items()})
        .drop("_extremes")
    )


def disruption_score(df: DataFrame) -> DataFrame:
    raw = (
        F.col("late_risk_norm") * LATE_WEIGHT + F.col("anomaly_norm") * ANOMALY_WEIGHT + FLOOR
    )
    # ``least`` and ``greatest`` skip nulls, a missing score must stay missing.
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(100.0), round_half_even(raw, 1)))
    return df.withColumn("disruption_score", F.when(raw.isNotNull(), bounded))


def risk_tier(df: DataFrame) -> DataFrame:
    score = F.col("disruption_score")
    return df.withColumn(
        "risk_tier",
        F.when(score >= HIGH_FROM, "High").when(score >= MEDIUM_FROM, "Medium").otherwise("Low"),
    )


def build_risk_scores(monthly: DataFrame, anomalies: DataFrame) -> DataFrame:
    base = join_anomaly_rate(monthly, anomalies)
    scaled = minmax_normalize(
        base, {"late_risk_pct": "late_risk_norm", "anomaly_rate_pct": "anomaly_norm"}
    )
    return risk_tier(disruption_score(scaled))


def top_risk_scores(scores: DataFrame, n: int = 10) -> DataFrame:
    return (
        scores.select(*KEYS, "late_risk_pct", "disruption_score", "risk_tier")
        .orderBy(F.desc_nulls_last("disruption_score"), *[F.asc_nulls_last(k) for k in KEYS])
        .limit(n)
    )
