"""Columns that a row gets on its way in: content key, run and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The separator of fields and the mark of null inside an ingestion key.
UNIT_SEPARATOR, NULL_MARK = "\x1f", "\x00"


def ingestion_key(columns: list[str]) -> Column:
    """SHA-256 of the source file and the row's content; null and empty differ, and so do differently cut fields."""
    fields = (F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in ("_source_file", *columns))
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *fields), 256)


def with_ingestion(df: DataFrame, columns: list[str], run_id: str, at: Column | None = None) -> DataFrame:
    """df with _ingested_at, _run_id and _ingestion_key over ``columns`` and the rescued data."""
    stamp = F.current_timestamp() if at is None else at
    return df.withColumns({"_ingested_at": stamp, "_run_id": F.lit(run_id), "_ingestion_key": ingestion_key([*columns, "_rescued_data"])})
