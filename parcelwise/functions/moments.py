"""Order and shipping moments.

They carry no time zone, so they are ``timestamp_ntz``: results do not change
with the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MOMENT = "timestamp_ntz"
SLASH_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?:\s+(\d{1,2}:\d{2}(?::\d{2})?))?\s*$"


def parse_moment(c: Column) -> Column:
    """ISO text or ``M/d/yyyy H:mm`` text to a moment; anything else is null.

    The regular expression runs only for text that is not ISO already.
    """
    slashed = F.regexp_replace(c, SLASH_DATE, "$3-$1-$2 $4")
    return F.coalesce(c.try_cast(MOMENT), slashed.try_cast(MOMENT))


def whole_days(start: Column, end: Column) -> Column:
    """Full days from start to end, rounded down: one hour early is -1."""
    dates_apart = F.datediff(end, start)
    overshoots = start + F.make_dt_interval(days=dates_apart) > end
    return dates_apart - overshoots.cast("int")


def month_label(c: Column) -> Column:
    """``yyyy-MM``. The years that have four digits are put together from numbers, which costs
    a fraction of the formatter that the others take."""
    year, month = F.year(c), F.month(c)
    digits = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return F.when(year.between(1, 9999), digits).otherwise(F.date_format(F.to_date(c), "yyyy-MM"))
