"""Silver bars to gold: detail with all windowed figures, and the daily summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater import schema
from brightwater.operators import windows as w

KEYS = ["Symbol", "Date"]


def detail(silver: DataFrame) -> DataFrame:
    """All figures share one partitioning and order: one exchange, one sort, one window."""
    close = F.col("Close")
    figures = silver.withColumns({
        "ma_close_7d": w.moving_average("Close", 7),
        "ma_close_30d": w.moving_average("Close", 30),
        "ma_volume_7d": w.moving_average("Volume", 7, 0).cast("long"),
        "prev_close": w.previous("Close"),
        "day_over_day_return_pct": w.change_pct(close, w.previous("Close")),
        "cumulative_return_pct": w.cumulative_pct("Close"),
    })
    present = [c for c in schema.GOLD_DETAIL.names if c != "_gold_created_at"]
    return figures.select(*present, F.current_timestamp().alias("_gold_created_at"))


def summary(gold_detail: DataFrame) -> DataFrame:
    """One row for each symbol and day, as reports read it."""
    lower = [F.col(c).alias(c.lower()) for c in ("Open", "High", "Low", "Close")]
    return gold_detail.select("Symbol", "Date", *lower, F.col("Volume").alias("total_volume"), "intraday_return_pct", "ma_close_7d", "ma_close_30d", "day_over_day_return_pct", "cumulative_return_pct")
