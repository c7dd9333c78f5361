"""The generated date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def describe(days: DataFrame, column: str = "Date") -> DataFrame:
    """Days with year, quarter, month and week; weeks count from January 1 and begin on Sunday."""
    d = F.col(column)
    week = F.floor((F.dayofyear(d) - 1 + F.dayofweek(F.trunc(d, "year")) - 1) / 7) + 1
    return days.select(
        d.alias("Date"), F.year(d).cast("long").alias("Year"), F.quarter(d).cast("long").alias("Quarter"), F.month(d).cast("long").alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"), week.cast("long").alias("Week"), F.date_format(d, "EEEE").alias("DayOfWeek"),
    )


def dates(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Each day from first to last, both ISO dates."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("Date"))
    return describe(span)
