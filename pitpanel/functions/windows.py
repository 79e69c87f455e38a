"""Window expressions over the observed rows of one code.

Callers guarantee one row per code and date, so a window partition is never
longer than the trading calendar.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from pitpanel.functions.scalars import pct

ANNUAL = math.sqrt(252)


def by_code(order: str = "session_no") -> WindowSpec:
    return Window.partitionBy("thscode").orderBy(order)


def scope(sessions: int | None, order: str = "session_no") -> WindowSpec:
    """The rows of the last ``sessions`` market sessions, or all rows so far."""
    if sessions is None:
        return by_code(order).rowsBetween(Window.unboundedPreceding, 0)
    return by_code(order).rangeBetween(-(sessions - 1), 0)


def last_rows(n: int, order: str = "session_no") -> WindowSpec:
    return by_code(order).rowsBetween(-(n - 1), 0)


def full(value: Column, n: int, result: Column) -> Column:
    """``result`` only where all ``n`` rows of the frame carry a value."""
    return F.when(F.count(value).over(last_rows(n)) == n, result)


def rolling_mean(value: Column, n: int) -> Column:
    return full(value, n, F.avg(value).over(last_rows(n)))


def rolling_z(value: Column, n: int) -> Column:
    """Distance from the rolling mean in population deviations."""
    frame = last_rows(n)
    deviation = F.stddev_pop(value).over(frame)
    return full(value, n, F.try_divide(value - F.avg(value).over(frame), deviation))


def change_over(value: Column, periods: int) -> Column:
    return pct(value, F.lag(value, periods).over(by_code()))


def annual_volatility(daily_return: Column, n: int) -> Column:
    sample = F.stddev_samp(daily_return).over(last_rows(n))
    return full(daily_return, n, sample * F.lit(ANNUAL))


def below_high(value: Column, n: int) -> Column:
    return full(value, n, pct(value, F.max(value).over(last_rows(n))))
