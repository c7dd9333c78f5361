"""Market bars: typing, rules, and the figures of a single day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.operators.rules import Rule

COLUMNS = ["Date", "Symbol", "Open", "High", "Low", "Close", "Volume", "OpenInt"]
KEYS = ["Symbol", "Date"]
TYPED = "_typed"


def typed(df: DataFrame) -> DataFrame:
    """df with the struct _typed beside the raw text; what can't be read is null there."""
    number = lambda c: F.expr(f"try_cast({c} AS DOUBLE)").alias(c)
    whole = lambda c: F.expr(f"try_cast({c} AS BIGINT)").alias(c)
    day = F.to_date(F.try_to_timestamp("Date", F.lit("yyyy-MM-dd"))).alias("Date")
    return df.withColumn(TYPED, F.struct(day, F.upper(F.trim("Symbol")).alias("Symbol"), *map(number, ("Open", "High", "Low", "Close")), *map(whole, ("Volume", "OpenInt"))))


def _price(name: str) -> Rule:
    return Rule(f"{name.lower()}_invalid", f"_typed.{name} IS NULL OR _typed.{name} <= 0")


RULES = [
    Rule("schema_drift", "_rescued_data IS NOT NULL"),
    Rule("date_invalid", "_typed.Date IS NULL"),
    Rule("symbol_missing", "_typed.Symbol IS NULL OR _typed.Symbol = ''"),
    *map(_price, ("Open", "Close", "High", "Low")),
    Rule("high_below_low", "_typed.High < _typed.Low"),
    Rule("ohlc_inconsistent", "_typed.High < greatest(_typed.Open, _typed.Close) OR _typed.Low > least(_typed.Open, _typed.Close)"),
    Rule("volume_invalid", "_typed.Volume IS NULL OR _typed.Volume < 0"),
]


def day_figures(df: DataFrame) -> DataFrame:
    """df with return, range and spread of the day, rounded to four places; prices above 0 are taken for granted."""
    percent = lambda part: F.round(part / F.col("Open") * 100, 4)
    width = F.col("High") - F.col("Low")
    return df.withColumns({"intraday_return_pct": percent(F.col("Close") - F.col("Open")), "intraday_range": F.round(width, 4), "price_spread_pct": percent(width)})
