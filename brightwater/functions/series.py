"""Rate series: code from the path, name, typing and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.operators.rules import Rule

KEYS = ["series_code", "ref_date"]
COLUMNS = ["series_code", "data", "valor"]
# The known series codes and their names.
NAMES = {1: "usd_brl_ptax_venda", 11: "selic_diaria", 12: "cdi_diario", 432: "selic_meta"}


def code_of(path: Column) -> Column:
    """The digits after series_code= in a path; null without any."""
    return F.nullif(F.regexp_extract(path, r"series_code=(\d+)", 1), F.lit(""))


def name_of(code: Column) -> Column:
    """The series' name; null for an unknown code."""
    return F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))[code]


def typed(df: DataFrame) -> DataFrame:
    """df with the struct _typed beside the raw text."""
    code = F.expr("try_cast(series_code AS INT)")
    day = F.to_date(F.try_to_timestamp("data", F.lit("dd/MM/yyyy")))
    return df.withColumn("_typed", F.struct(code.alias("series_code"), name_of(code).alias("series_name"), day.alias("ref_date"), F.expr("try_cast(valor AS DECIMAL(20, 8))").alias("value")))


RULES = [
    Rule("schema_drift", "_rescued_data IS NOT NULL"),
    Rule("series_unknown", "_typed.series_name IS NULL"),
    Rule("date_invalid", "_typed.ref_date IS NULL"),
    Rule("value_invalid", "_typed.value IS NULL"),
]
