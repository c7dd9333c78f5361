"""Report measures over the daily summary in any grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def measures(summary: DataFrame, by: list[str]) -> DataFrame:
    """The measures for each group. The latest close is the greatest of the group's last day. A blank average counts as 0
    in the trend, as in the report language, so a group without any is NEUTRAL."""
    short, long = F.avg("ma_close_7d"), F.avg("ma_close_30d")
    a, b = F.coalesce(short, F.lit(0.0)), F.coalesce(long, F.lit(0.0))
    high, low = F.max("high"), F.min("low")
    return summary.groupBy(*by).agg(
        F.max(F.struct("Date", "close"))["close"].alias("latest_close"), F.avg("intraday_return_pct").alias("avg_intraday_return_pct"),
        (F.sum("total_volume") / 1e6).alias("total_volume_m"), high.alias("all_time_high"), low.alias("all_time_low"),
        F.try_divide(high - low, low).alias("price_range"), F.when(a > b, "BULLISH").when(a < b, "BEARISH").otherwise("NEUTRAL").alias("trend_signal"),
        short.alias("avg_ma_close_7d"), long.alias("avg_ma_close_30d"),
    )


def by_calendar(summary: DataFrame, calendar: DataFrame, by: list[str]) -> DataFrame:
    """Measures by columns of the date dimension; days that it lacks go to a null group."""
    return measures(summary.join(calendar, "Date", "left"), by)
