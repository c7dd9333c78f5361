"""The sources that the engine knows, and the tables that each layer's contract gives them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwater import schema
from brightwater.functions import bars, series
from brightwater.plans import silver
from brightwater.sources import landing
from brightwater.streaming.vtable import TableSpec


class Source:
    """A kind of file: where it lands, how it is read and refined. Its tables follow from ``place`` and the contracts:
    bronze and quarantine take rows by their content's key, silver holds one row for each business key and tells changes."""

    def __init__(self, name: str, place: str, files: str, landed: T.StructType, refinery: silver.Refinery, content: list[str], spread: list[str], read: Callable):
        self.name, self.files, self.landed, self.refinery, self.content, self._read = name, files, landed, refinery, content, read
        once = ("_ingestion_key",)
        self.bronze = TableSpec(f"bronze.{name}", f"bronze/{place}", refinery.bronze, once)
        self.quarantine = TableSpec(f"silver.{name}_quarantine", f"silver/_quarantine/{place}", refinery.quarantined, once)
        self.silver = TableSpec(f"silver.{name}", f"silver/{place}", refinery.silver, tuple(spread), cluster_by=tuple(refinery.key), change_feed=True)

    def read(self, spark, paths: list[str]) -> DataFrame:
        """Rows of files with all columns of the content; a series' code is in its file's path."""
        rows = self._read(spark, paths, self.landed)
        return rows if "series_code" not in self.content else rows.withColumn("series_code", series.code_of(F.col("_source_file")))


BARS = Source("ohlcv", "financial_data", "financial-data/*.csv", schema.RAW_BARS, silver.BARS, bars.COLUMNS, ["Symbol"], landing.read_csv)
RATES = Source("bcb_sgs", "bcb_sgs", "bcb_sgs/*.json", schema.RAW_SERIES, silver.SERIES, series.COLUMNS, series.KEYS, landing.read_json)
GOLD = {
    name: TableSpec(f"gold.{name}", f"gold/{place}", contract, ("Symbol",), cluster_by=("Symbol", "Date"))
    for name, place, contract in (("ohlcv_detail", "financial_data", schema.GOLD_DETAIL), ("ohlcv_daily_summary", "daily_summary", schema.GOLD_SUMMARY))
}
METRICS = TableSpec("ops.dq_metrics", "silver/_ops/dq_metrics", schema.DQ_METRICS)
SOURCES = {source.name: source for source in (BARS, RATES)}


def named(name: str) -> Source:
    try:
        return SOURCES[name]
    except KeyError:
        raise ValueError(f"no source is called {name!r}; known: {', '.join(SOURCES)}") from None


def tables() -> list[TableSpec]:
    """All tables of the engine, layer by layer."""
    by_layer = ([getattr(source, layer) for source in SOURCES.values()] for layer in ("bronze", "silver", "quarantine"))
    return [*sum(by_layer, []), *GOLD.values(), METRICS]
