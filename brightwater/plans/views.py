"""The analytics views over gold, silver, quarantine and batch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.operators import windows as w


def latest_price(summary: DataFrame) -> DataFrame:
    """A symbol's last day and close, with its average return and total volume: one aggregation, no join."""
    return summary.groupBy("Symbol").agg(
        F.max("Date").alias("latest_date"), F.max_by("close", "Date").alias("latest_close"),
        F.avg("intraday_return_pct").alias("avg_intraday_return_pct"), F.sum("total_volume").alias("total_volume_all_time"),
    )


def rolling_volatility(summary: DataFrame) -> DataFrame:
    return summary.select(
        "Symbol", "Date", "close", "intraday_return_pct", "day_over_day_return_pct", "cumulative_return_pct", "ma_close_7d", "ma_close_30d",
        w.volatility("day_over_day_return_pct").alias("volatility_30d_pct"), w.trend("ma_close_7d", "ma_close_30d").alias("trend_signal"),
    )


def symbol_performance(summary: DataFrame) -> DataFrame:
    """A symbol's whole period, ranked by total return. The rank sees one row a symbol, and nulls last."""
    per = summary.groupBy("Symbol").agg(
        F.min("Date").alias("period_start"), F.max("Date").alias("period_end"), F.min_by("close", "Date").alias("start_price"), F.max_by("close", "Date").alias("end_price"),
        F.max("high").alias("period_high"), F.min("low").alias("period_low"), F.avg("intraday_return_pct").alias("avg_intraday_return_pct"),
        F.stddev_samp("day_over_day_return_pct").alias("stdev_daily_return_pct"), F.sum("total_volume").alias("total_volume"), F.count("*").alias("trading_days"),
    )
    per = per.withColumn("total_return_pct", F.try_divide(F.col("end_price") - F.col("start_price"), F.col("start_price")) * 100)
    return per.withColumn("return_rank", F.rank().over(Window.orderBy(F.desc("total_return_pct"))).cast("long"))


def layer_reconciliation(bronze: DataFrame, silver: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows, symbols and days of each layer side by side."""

    def layer(name: str, df: DataFrame, day) -> DataFrame:
        return df.select("Symbol", day.alias("__day")).agg(F.count("*").alias("total_rows"), F.count_distinct("Symbol").alias("distinct_symbols"), F.min("__day").alias("min_date"), F.max("__day").alias("max_date")).select(F.lit(name).alias("layer"), "*")

    return layer("bronze", bronze, F.expr("try_cast(Date AS DATE)")).unionByName(layer("silver", silver, F.col("Date"))).unionByName(layer("gold", summary, F.col("Date")))


def dq_daily(metrics: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("rows_in", "rows_valid", "rows_quarantined", "rows_deduplicated")]
    days = metrics.groupBy("table_name", F.to_date("measured_at").alias("measured_date")).agg(F.count("*").alias("batches"), *sums)
    return days.withColumn("quarantine_rate", F.try_divide(F.col("rows_quarantined").cast("double"), F.col("rows_in")))


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    """Rejected rows for each reason and day; a row counts once for each of its reasons."""
    each = quarantine.select(F.explode(F.split("_rejection_reason", ";")).alias("rejection_reason"), F.to_date("_quarantined_at").alias("quarantined_date"))
    return each.groupBy("rejection_reason", "quarantined_date").agg(F.count("*").alias("rows_rejected"))
