"""Figures over a symbol's trading rows: moving averages, returns, volatility and trend. Frames count rows, not days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

def by_symbol() -> WindowSpec:
    return Window.partitionBy("Symbol").orderBy("Date")


def last_rows(n: int) -> WindowSpec:
    return by_symbol().rowsBetween(1 - n, 0)


def when_full(value: Column, column: str, n: int) -> Column:
    """value where the last n rows all have the column."""
    return F.when(F.count(column).over(last_rows(n)) == n, value)


def moving_average(column: str, n: int, places: int = 4) -> Column:
    return when_full(F.round(F.avg(column).over(last_rows(n)), places), column, n)


def previous(column: str) -> Column:
    return F.lag(column, 1).over(by_symbol())


def change_pct(now: Column, then: Column) -> Column:
    return F.round(F.try_divide(now - then, then) * 100, 4)


def cumulative_pct(column: str) -> Column:
    start = F.first(column).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    return change_pct(F.col(column), start)


def volatility(column: str, n: int = 30) -> Column:
    """Sample deviation of the last n values, where there are n."""
    return when_full(F.stddev_samp(column).over(last_rows(n)), column, n)


def trend(short: str, long: str) -> Column:
    a, b = F.col(short), F.col(long)
    return F.when(a.isNull() | b.isNull(), None).when(a > b, "BULLISH").when(a < b, "BEARISH").otherwise("NEUTRAL")
