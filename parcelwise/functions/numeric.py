"""Aggregates over double columns whose result does not depend on row order.

Adding doubles gives a different last digit for every partitioning. Here each value is
taken apart into a whole number and two fractions in units of 2^-40 and 2^-80. The three
are whole numbers, so their sums are exact in any order, and only the three totals are
turned back into a double. What a value has below 2^-80 is added as doubles: no part of a
value is lost, and order can change a last digit only where whole sums are that small.
Values beyond 38 digits and values that are not finite take a plain sum, which they
decide alone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNIT = float(1 << 40)
WHOLE = "decimal(28,0)"


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parts(x: Column) -> tuple[Column, Column, Column, Column]:
    x = x.cast("double")
    whole = F.rint(x)
    fine = (x - whole) * UNIT
    finest = (fine - F.rint(fine)) * UNIT
    rest = finest - F.rint(finest)
    return whole.try_cast("decimal(38,0)"), F.rint(fine).try_cast(WHOLE), F.rint(finest).try_cast(WHOLE), rest


def _joined(whole: Column, fine: Column, finest: Column, rest: Column, plain: Column, sound: Column) -> Column:
    small = (fine.cast("double") + (finest.cast("double") + rest) / UNIT) / UNIT
    return F.coalesce(F.when(sound, whole.cast("double") + small), plain)


def exact_sum(c: Column | str) -> Column:
    x = _as_column(c)
    whole, fine, finest, rest = _parts(x)
    sound = F.bool_and(x.isNull() | whole.isNotNull())
    sums = [F.try_sum(part) for part in (whole, fine, finest)]
    return _joined(*sums, F.sum(rest), F.sum(x.cast("double")), sound)


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double to decimals, ties away from zero, on the scaled binary value.

    ``round(x, digits)`` works on the printed digits instead: it takes 4.225,
    stored as 4.22499..., to 4.23 where SQL engines with binary rounding give 4.22.
    """
    scale = float(10**digits)
    # From 2^53 on a scaled double has no fraction left to round.
    return F.when(F.abs(x * scale) >= float(1 << 53), x).otherwise(F.round(x * scale) / scale)


def round_half_even(x: Column, digits: int) -> Column:
    """As ``round_half_away``, ties to the even neighbour."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def money_sum(c: Column | str) -> Column:
    """Total rounded half away from zero to cents."""
    return round_half_away(exact_sum(c), 2)


def exact_avg(c: Column | str, times: int = 1) -> Column:
    """Mean of the non-null values, multiplied by ``times`` before the division."""
    x = _as_column(c)
    return F.try_divide(exact_sum(x) * F.lit(times), F.count(x))


def share_true(condition: Column) -> Column:
    """Share of rows meeting a condition; null counts as not met, no rows gives null."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


class WeightedTotal:
    """A money total built in two steps, for sums taken on both sides of a join.

    ``partial`` aggregates before the join; ``combine`` adds the partial totals
    up after it, each multiplied by the number of rows it met.
    """

    def __init__(self, column: str):
        self.column = column
        self._names = [f"_{column}_{part}" for part in ("whole", "fine", "finest", "rest", "plain", "sound")]

    def partial(self) -> list[Column]:
        x = F.col(self.column)
        whole, fine, finest, rest = _parts(x)
        sums = [F.try_sum(part) for part in (whole, fine, finest)]
        sums += [F.sum(rest), F.sum(x.cast("double")), F.bool_and(x.isNull() | whole.isNotNull())]
        return [part.alias(name) for part, name in zip(sums, self._names)]

    def combine(self, weight: str) -> Column:
        *exact, rest, plain, sound = [F.col(name) for name in self._names]
        w = F.col(weight)
        sums = [F.try_sum(F.try_multiply(part, w.cast("decimal(10,0)"))) for part in exact]
        return round_half_away(_joined(*sums, F.sum(rest * w), F.sum(plain * w), F.bool_and(sound)), 2)
