"""Bronze to silver: type and judge each row once, keep the latest valid version of each key, and set the rest aside."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwater import schema
from brightwater.functions import bars, series
from brightwater.operators import rules
from brightwater.operators.merge import latest


class Silver(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame


class Refinery(NamedTuple):
    """How a source's bronze becomes silver. Judged rows are bronze with ``_typed`` and the bits of the broken rules."""

    typed: Callable[[DataFrame], DataFrame]
    rules: list[rules.Rule]
    key: list[str]
    bronze: T.StructType
    silver: T.StructType
    quarantined: T.StructType
    figures: Callable[[DataFrame], DataFrame] = lambda df: df

    def judge(self, bronze: DataFrame) -> DataFrame:
        return rules.judge(self.typed(schema.conform(bronze, self.bronze, "bronze")), self.rules)

    def valid(self, judged: DataFrame) -> DataFrame:
        """Rules come before the choice of the latest, so a broken newest version doesn't hide a good older one."""
        good = rules.split(judged, self.rules).valid.select("_typed.*", "_ingestion_key", "_source_file", "_ingested_at")
        return schema.conform(self.figures(latest(good, self.key)).withColumn("_transformed_at", F.current_timestamp()), self.silver, "silver")

    def rejected(self, judged: DataFrame) -> DataFrame:
        return schema.conform(rules.split(judged, self.rules).rejected.drop("_typed"), self.quarantined, "quarantine")

    def layers(self, bronze: DataFrame) -> Silver:
        judged = self.judge(bronze)
        return Silver(self.valid(judged), self.rejected(judged))


BARS = Refinery(bars.typed, bars.RULES, bars.KEYS, schema.BRONZE_BARS, schema.SILVER_BARS, schema.QUARANTINE_BARS, bars.day_figures)
SERIES = Refinery(series.typed, series.RULES, series.KEYS, schema.BRONZE_SERIES, schema.SILVER_SERIES, schema.QUARANTINE_SERIES)
bars_to_silver, series_to_silver = BARS.layers, SERIES.layers
