"""Calendar helpers built from Spark date expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recent_months(end: Column, n: int) -> Column:
    """Array of the last ``n`` complete months before the month of ``end``, as yyyyMM."""
    first = F.trunc(end, "MM")
    months = F.sequence(
        F.add_months(first, -n), F.add_months(first, -1), F.expr("interval 1 month")
    )
    return F.transform(months, lambda d: F.date_format(d, "yyyyMM"))


def lagged_months(today: Column, n: int) -> Column:
    """Same window for a feed published one month late: it ends two months back."""
    return recent_months(F.add_months(today, -1), n)


def latest(df: DataFrame, day: str) -> Column:
    """The last day of the whole table, as a scalar subquery."""
    return df.agg(F.max(day)).scalar()


def look_back(df: DataFrame, day: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days, boundary day included (so ``days + 1`` dates).

    The newest day is taken over the whole table. Pass a staged or stored table: the
    subquery then reads one small column instead of repeating the scan behind it.
    """
    return df.filter(F.col(day) >= F.date_sub(latest(df, day), days))
