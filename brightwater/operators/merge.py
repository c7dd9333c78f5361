"""Idempotent merges as plans over frames: new rows only, latest version, and whole slices; and the latest row of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What makes a version the latest; the content's hash comes last, so the order is total.
LATEST = ("_ingested_at", "_source_file", "_ingestion_key")


def latest(df: DataFrame, keys: list[str], order: tuple[str, ...] = LATEST) -> DataFrame:
    """One row for each key: the greatest by ``order``, whatever the rows' arrangement.

    A maximum of a struct, so versions of a hot key are reduced before the shuffle; rows that tie on all of ``order``
    are told apart by their other columns.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    best = F.max(F.struct(*order, *rest)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*(F.col(c) if c in keys else F.col(f"__best.`{c}`") for c in df.columns))


def same_key(a: str, b: str, keys: list[str]) -> Column:
    """Whether the keys of two aliased frames are equal, null being equal to null."""
    return reduce(Column.__and__, (F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys))


def newer(a: str, b: str, order: list[str]) -> Column:
    """Whether a's order columns are lexicographically greater than b's; with a null among those that decide, false."""
    out = F.lit(False)
    for i, column in enumerate(order):
        tie = reduce(Column.__and__, (F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in order[:i]), F.lit(True))
        out = out | (tie & (F.col(f"{a}.{column}") > F.col(f"{b}.{column}")))
    return F.coalesce(out, F.lit(False))


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of source, one for each key, whose key the target lacks."""
    return source.dropDuplicates(keys).alias("s").join(target.select(*keys).alias("t"), same_key("s", "t", keys), "left_anti")


def upsert_latest(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows after the merge, with _action: insert, update or keep; and for updates the row before it in _before.

    A source row takes the place of the target's if it is newer. The source must have one row for each key.
    """
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    both = t.join(s, same_key("t", "s", keys), "full_outer")
    action = F.when(F.col("t.__t").isNull(), "insert").when(F.col("s.__s").isNotNull() & newer("s", "t", order), "update").otherwise("keep")
    names = target.columns
    both = both.withColumn("_action", action)
    pick = lambda c: F.when(F.col("_action") == "keep", F.col(f"t.`{c}`")).otherwise(F.col(f"s.`{c}`")).alias(c)
    before = F.when(F.col("_action") == "update", F.struct(*(F.col(f"t.`{c}`") for c in names))).alias("_before")
    return both.select(*map(pick, names), "_action", before)


def replace_slice(target: DataFrame, source: DataFrame, keys: list[str], slices: DataFrame) -> DataFrame:
    """The target after its rows of the slices (the values of the one column of ``slices``) became those of the source.

    Rows of other slices stay, but for those whose key the source has: there the source's row takes their place.
    """
    column = slices.columns[0]
    kept = target.alias("t").join(slices.distinct().alias("s"), same_key("t", "s", [column]), "left_anti")
    kept = kept.alias("t").join(source.select(*keys).alias("s"), same_key("t", "s", keys), "left_anti")
    return kept.unionByName(source)


def changes(merged: DataFrame) -> DataFrame:
    """The change feed of a merge: inserts, and updates before and after, by _change_type."""
    names = [c for c in merged.columns if c not in ("_action", "_before")]
    after = merged.where("_action <> 'keep'").select(*names, F.when(F.col("_action") == "insert", "insert").otherwise("update_postimage").alias("_change_type"))
    before = merged.where("_action = 'update'").select(*(F.col(f"_before.`{c}`") for c in names), F.lit("update_preimage").alias("_change_type"))
    return after.unionByName(before)


def changed(feed: DataFrame, column: str) -> DataFrame:
    """The values of a column in rows that were inserted or updated."""
    return feed.where(F.col("_change_type").isin("insert", "update_postimage")).select(column).distinct()
