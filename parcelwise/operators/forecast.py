"""Three-month forecast of each region's late share: ARIMA(1,1,1), no constant.

The parameters maximise the exact Gaussian likelihood of the differenced series,
computed with the innovations recursion for ARMA(1,1) (Brockwell & Davis, Time
Series: Theory and Methods, section 5.3). The search runs over a grid of steps of
0.05 and then over steps of 0.005 around the best point. Everything is a column
expression over one array per region, so regions and grid points run in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import round_half_even

MIN_MONTHS = 12
STEPS = 3
Z_95 = 1.959963984540054

# Grid points are whole numbers of 1/200: exact, and equal in every engine.
GRID = 200
COARSE_STEP = 10
COARSE_REACH = 190
FINE_REACH = 199


def region_series(monthly: DataFrame) -> DataFrame:
    """The late shares of each region in month order, as one array.

    A region has one value a month, so an array is as long as the calendar.
    """
    points = F.array_sort(F.collect_list(F.struct("year_month", "late_risk_pct")))
    return (
        monthly.filter(F.col("region_name").isNotNull() & F.col("year_month").isNotNull())
        .groupBy("region_name")
        .agg(points.alias("points"))
        .select(
            "region_name",
            F.size("points").alias("months"),
            F.col("points.late_risk_pct").alias("y"),
        )
    )


def forecast_eligibility(series: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    return series.select(
        "region_name", "months", (F.col("months") >= min_months).alias("is_eligible")
    )


def _likelihood(w: Column, p: Column, phi: Column, point: Column) -> Column:
    """One grid point: the objective first, so that ``min`` finds the best fit.

    ``point`` holds q, theta and theta squared. State of the recursion: the next
    prediction and its relative variance ``r``, the sum of squared scaled errors,
    and the product of all ``r``.
    """
    q, theta, theta2 = point["q"], point["theta"], point["theta2"]
    one = F.lit(1.0)
    start = F.struct(
        F.lit(0.0).alias("ahead"),
        ((one + F.lit(2.0) * phi * theta + theta2) / (one - phi * phi)).alias("r"),
        F.lit(0.0).alias("squares"),
        one.alias("product"),
    )

    def advance(state: Column, value: Column) -> Column:
        r = state["r"]
        error = value - state["ahead"]
        return F.struct(
            (phi * value + theta / r * error).alias("ahead"),
            (one + theta2 - theta2 / r).alias("r"),
            (state["squares"] + error * error / r).alias("squares"),
            (state["product"] * r).alias("product"),
        )

    def finish(state: Column) -> Column:
        m = F.size(w).cast("double")
        # A perfect fit has no error at all; nothing can be better.
        spread = F.when(state["squares"] > 0, F.ln(state["squares"] / m)).otherwise(F.lit(-1e6))
        objective = m * spread + F.ln(state["product"])
        return F.struct(
            F.round(objective, 8).alias("objective"),
            F.abs(p).alias("abs_p"),
            F.abs(q).alias("abs_q"),
            p.alias("p"),
            q.alias("q"),
            state["ahead"].alias("ahead"),
            state["r"].alias("r"),
            (state["squares"] / m).alias("sigma2"),
        )

    return F.aggregate(w, start, advance, finish)


def _best_point(df: DataFrame, p_range: Column, q_range: Column, carry: list[str]) -> DataFrame:
    """Try every (p, q); one row per region and p, spread over all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism

    def point(q: Column) -> Column:
        theta = q / F.lit(float(GRID))
        names = [F.lit(name) for name in ("q", "theta", "theta2")]
        return F.named_struct(names[0], q, names[1], theta, names[2], theta * theta)

    rows = (
        df.select("*", F.explode(p_range).alias("p"), F.transform(q_range, point).alias("points"))
        .withColumn("phi", F.col("p") / F.lit(float(GRID)))
        .repartition(cores, "region_name", "p")
    )
    tried = F.transform(
        "points", lambda q: _likelihood(F.col("w"), F.col("p"), F.col("phi"), q)
    )
    return (
        rows.select(*carry, F.array_min(tried).alias("best"))
        .groupBy("region_name")
        .agg(F.min("best").alias("best"), *[F.first(c).alias(c) for c in carry[1:]])
    )


def arima_fit(series: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """Fitted parameters and end-of-series state of each region with enough months."""
    carry = ["region_name", "months", "y", "w"]
    differenced = series.filter(F.col("months") >= min_months).select(
        *carry[:-1],
        F.zip_with(
            F.slice("y", 2, F.size("y") - 1),
            F.slice("y", 1, F.size("y") - 1),
            lambda later, earlier: later - earlier,
        ).alias("w"),
    )
    coarse_range = F.sequence(F.lit(-COARSE_REACH), F.lit(COARSE_REACH), F.lit(COARSE_STEP))
    coarse = _best_point(differenced, coarse_range, coarse_range, carry)

    def around(point: str) -> Column:
        centre = F.col(f"best.{point}")
        return F.sequence(
            F.greatest(centre - COARSE_STEP, F.lit(-FINE_REACH)),
            F.least(centre + COARSE_STEP, F.lit(FINE_REACH)),
        )

    ranged = coarse.select(*carry, around("p").alias("p_range"), around("q").alias("fine_q"))
    fine = _best_point(ranged, F.col("p_range"), F.col("fine_q"), carry)
    return fine.select(
        "region_name",
        "months",
        (F.col("best.p") / F.lit(float(GRID))).alias("phi"),
        (F.col("best.q") / F.lit(float(GRID))).alias("theta"),
        F.col("best.sigma2").alias("sigma2"),
        F.element_at("y", -1).alias("last_value"),
        F.col("best.ahead").alias("next_change"),
        F.col("best.r").alias("next_r"),
    )


def _is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def _usable() -> Column:
    return (
        _is_finite(F.col("sigma2")) & _is_finite(F.col("last_value")) & _is_finite(F.col("next_change"))
    )


def forecast_failures(fits: DataFrame) -> DataFrame:
    """Regions whose fit has no finite result; they do not stop the others."""
    return fits.filter(~_usable()).select(
        "region_name", "months", F.lit("fit is not finite").alias("reason")
    )


def forecast_from_fit(fits: DataFrame) -> DataFrame:
    """Three steps ahead with a 95% interval.

    The forecast is clamped to [0, 100]; the lower bound only at 0 and the upper
    bound only at 100.
    """
    phi, theta, r1 = F.col("phi"), F.col("theta"), F.col("next_r")
    one = F.lit(1.0)
    r2 = one + theta * theta - theta * theta / r1
    r3 = one + theta * theta - theta * theta / r2
    # Effect of the first and second future error on the changes that follow them.
    first, second = phi + theta / r1, phi + theta / r2
    two_on = one + first
    three_on = one + first + phi * first
    changes = [one, one + phi, one + phi + phi * phi]
    variances = [
        r1,
        two_on * two_on * r1 + r2,
        three_on * three_on * r1 + (one + second) * (one + second) * r2 + r3,
    ]
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("forecast_step"),
                F.lit(f"T+{i + 1}").alias("forecast_month"),
                (F.col("last_value") + F.col("next_change") * changes[i]).alias("centre"),
                (F.lit(Z_95) * F.sqrt(F.col("sigma2") * variances[i])).alias("reach"),
            )
            for i in range(STEPS)
        ]
    )
    zero, hundred = F.lit(0.0), F.lit(100.0)
    centre, reach = F.col("centre"), F.col("reach")
    return (
        fits.filter(_usable())
        .select("region_name", F.inline(steps))
        .select(
            "region_name",
            "forecast_step",
            "forecast_month",
            round_half_even(F.greatest(zero, F.least(hundred, centre)), 2).alias("predicted_risk"),
            round_half_even(F.greatest(zero, centre - reach), 2).alias("lower_bound"),
            round_half_even(F.least(hundred, centre + reach), 2).alias("upper_bound"),
        )
    )


def forecast_risk_by_region(monthly: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    return forecast_from_fit(arima_fit(region_series(monthly), min_months))
