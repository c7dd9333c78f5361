"""Registered queries of the medallion engine and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightwater.functions import bars as bar_rules
from brightwater.functions import series as series_rules
from brightwater.operators import merge, rules
from brightwater.plans import bi, gold, silver, views
from brightwater.schema import GOLD_DETAIL, contract
from brightwater.sources import calendar, driver, landing
from brightwater.streaming.vtable import TableSpec, VersionedTable

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


_DETAIL = [n for n in GOLD_DETAIL.names if n != "_gold_created_at"]


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _from_detail(name: str, columns: list[str]) -> None:
    query(name, f"WITH {driver.DETAIL_SQL} SELECT {_quoted(columns)} FROM detail")(lambda spark, d: driver.detail(spark, d).select(*columns))


_from_detail("gold_detail", _DETAIL)
_from_detail("moving_averages", ["Symbol", "Date", "ma_close_7d", "ma_close_30d", "ma_volume_7d"])
_from_detail("returns", ["Symbol", "Date", "prev_close", "day_over_day_return_pct", "cumulative_return_pct"])
_from_detail("derived_metrics", ["Symbol", "Date", "intraday_return_pct", "intraday_range", "price_spread_pct"])
query("daily_summary", f"WITH {driver.SUMMARY_SQL} SELECT * FROM summary")(driver.summary)
query("summary_preview", f'WITH {driver.SUMMARY_SQL} SELECT * FROM summary ORDER BY "Symbol", "Date" LIMIT 10')(lambda s, d: driver.summary(s, d).orderBy("Symbol", "Date").limit(10))


@query("scan_filter_isin", f"""WITH {driver.BARS_SQL} SELECT * FROM bars WHERE "Symbol" IN ('Brand#11', 'Brand#23')""")
def scan_filter_isin(spark, d):
    return driver.bars(spark, d).where(F.col("Symbol").isin("Brand#11", "Brand#23"))


@query("latest_price", f"""
WITH {driver.SUMMARY_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY "Symbol" ORDER BY "Date" DESC) AS rn FROM summary),
totals AS (SELECT "Symbol", round(avg(intraday_return_pct), 6) AS avg_intraday_return_pct, CAST(sum(total_volume) AS BIGINT) AS total_volume_all_time FROM summary GROUP BY 1)
SELECT "Symbol", "Date" AS latest_date, close AS latest_close, avg_intraday_return_pct, total_volume_all_time FROM ranked JOIN totals USING ("Symbol") WHERE rn = 1""")
def latest_price(spark, d):
    return views.latest_price(driver.summary(spark, d)).withColumn("avg_intraday_return_pct", F.round("avg_intraday_return_pct", 6))


@query("rolling_volatility", f"""
WITH {driver.SUMMARY_SQL}
SELECT "Symbol", "Date", close, intraday_return_pct, day_over_day_return_pct, cumulative_return_pct, ma_close_7d, ma_close_30d,
       CASE WHEN count(day_over_day_return_pct) OVER w = 30 THEN round(stddev_samp(day_over_day_return_pct) OVER w, 6) END AS volatility_30d_pct,
       CASE WHEN ma_close_7d > ma_close_30d THEN 'BULLISH' WHEN ma_close_7d < ma_close_30d THEN 'BEARISH' WHEN ma_close_7d = ma_close_30d THEN 'NEUTRAL' END AS trend_signal
FROM summary WINDOW w AS (PARTITION BY "Symbol" ORDER BY "Date" ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_volatility(spark, d):
    return views.rolling_volatility(driver.summary(spark, d)).withColumn("volatility_30d_pct", F.round("volatility_30d_pct", 6))


@query("symbol_performance", f"""
WITH {driver.SUMMARY_SQL},
b AS (
  SELECT "Symbol", min("Date") AS period_start, max("Date") AS period_end, max(high) AS period_high, min(low) AS period_low,
         round(avg(intraday_return_pct), 6) AS avg_intraday_return_pct, round(stddev_samp(day_over_day_return_pct), 6) AS stdev_daily_return_pct,
         CAST(sum(total_volume) AS BIGINT) AS total_volume, count(*) AS trading_days
  FROM summary GROUP BY 1),
p AS (
  SELECT b.*, s.close AS start_price, e.close AS end_price, (e.close - s.close) / nullif(s.close, 0) * 100 AS r
  FROM b JOIN summary s ON s."Symbol" = b."Symbol" AND s."Date" = period_start JOIN summary e ON e."Symbol" = b."Symbol" AND e."Date" = period_end)
SELECT * EXCLUDE (r), round(r, 6) AS total_return_pct, rank() OVER (ORDER BY r DESC NULLS LAST) AS return_rank FROM p""")
def symbol_performance(spark, d):
    rounded = ("avg_intraday_return_pct", "stdev_daily_return_pct", "total_return_pct")
    return views.symbol_performance(driver.summary(spark, d)).withColumns({c: F.round(c, 6) for c in rounded})


@query("typed_cast", f'WITH {driver.RAW_BARS_SQL} SELECT _ingestion_key, t_date AS "Date", t_symbol AS "Symbol", t_open AS "Open", t_high AS "High", t_low AS "Low", t_close AS "Close", t_volume AS "Volume", t_openint AS "OpenInt" FROM typed')
def typed_cast(spark, d):
    return bar_rules.typed(driver.raw_bars(spark, d)).select("_ingestion_key", "_typed.*")


@query("ingestion_key", f"WITH {driver.RAW_BARS_SQL} SELECT _source_file, _ingestion_key FROM raw")
def ingestion_key(spark, d):
    return driver.raw_bars(spark, d).select("_source_file", "_ingestion_key")


@query("rejection_reasons", f"WITH {driver.RAW_BARS_SQL} SELECT _ingestion_key, reason AS rejection_reason FROM judged")
def rejection_reasons(spark, d):
    return rules.with_reasons(bar_rules.typed(driver.raw_bars(spark, d)), bar_rules.RULES).select("_ingestion_key", F.col("_rejection_reason").alias("rejection_reason"))


@query("quarantine_split", f"WITH {driver.RAW_BARS_SQL} SELECT {_quoted(bar_rules.COLUMNS)}, _rescued_data, reason AS rejection_reason FROM judged WHERE reason <> ''")
def quarantine_split(spark, d):
    return silver.bars_to_silver(driver.raw_bars(spark, d)).quarantine.select(*bar_rules.COLUMNS, "_rescued_data", F.col("_rejection_reason").alias("rejection_reason"))


@query("silver_valid", f"""
WITH {driver.RAW_BARS_SQL} SELECT *, round(("Close" - "Open") / "Open" * 100, 4) AS intraday_return_pct, round("High" - "Low", 4) AS intraday_range,
round(("High" - "Low") / "Open" * 100, 4) AS price_spread_pct FROM silver""")
def silver_valid(spark, d):
    return silver.bars_to_silver(driver.raw_bars(spark, d)).valid.drop("_ingested_at", "_transformed_at")


@query("dedup_latest", f"""
WITH {driver.RAW_BARS_SQL} SELECT "Symbol", "Date", _ingestion_key FROM (
  SELECT *, row_number() OVER (PARTITION BY "Symbol", "Date" ORDER BY _ingested_at DESC, _source_file DESC, _ingestion_key DESC) AS n FROM raw) WHERE n = 1""")
def dedup_latest(spark, d):
    return merge.latest(driver.raw_bars(spark, d), ["Symbol", "Date"]).select("Symbol", "Date", "_ingestion_key")


@query("quarantine_reasons", f"""
WITH {driver.RAW_BARS_SQL}, r AS (SELECT unnest(string_split(reason, ';')) AS rejection_reason, CAST(ts AS DATE) AS quarantined_date FROM judged WHERE reason <> '')
SELECT rejection_reason, quarantined_date, count(*) AS rows_rejected FROM r GROUP BY 1, 2""")
def quarantine_reasons(spark, d):
    judged = rules.judge(bar_rules.typed(driver.raw_bars(spark, d)), bar_rules.RULES)
    return views.quarantine_reasons(rules.split(judged, bar_rules.RULES, at=F.col("_source_modified_at")).rejected)


@query("series_code_extract", f"WITH {driver.RAW_SERIES_SQL} SELECT _source_file, series_code FROM raw")
def series_code_extract(spark, d):
    return driver.raw_series(spark, d).select("_source_file", series_rules.code_of(F.col("_source_file")).alias("series_code"))


@query("series_lookup", f"WITH {driver.RAW_SERIES_SQL} SELECT code AS series_code, series_name, count(*) AS n FROM typed GROUP BY 1, 2")
def series_lookup(spark, d):
    return series_rules.typed(driver.raw_series(spark, d)).groupBy("_typed.series_code", "_typed.series_name").agg(F.count("*").alias("n"))


@query("sgs_rules", f"WITH {driver.RAW_SERIES_SQL} SELECT _ingestion_key, reason AS rejection_reason FROM judged")
def sgs_rules(spark, d):
    return rules.with_reasons(series_rules.typed(driver.raw_series(spark, d)), series_rules.RULES).select("_ingestion_key", F.col("_rejection_reason").alias("rejection_reason"))


@query("sgs_silver", f"""
WITH {driver.RAW_SERIES_SQL} SELECT code AS series_code, series_name, ref_date, value, _ingestion_key, _source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY code, ref_date ORDER BY _ingested_at DESC, _source_file DESC, _ingestion_key DESC) AS n FROM judged WHERE reason = '') WHERE n = 1""")
def sgs_silver(spark, d):
    return silver.series_to_silver(driver.raw_series(spark, d)).valid.drop("_ingested_at", "_transformed_at")


# Merges: a base of orders and a delta that overlaps it; versions by price, then key.
_BASE = "base AS (SELECT o_orderkey AS k, o_custkey AS slice, o_totalprice AS version, o_orderstatus AS payload FROM orders WHERE o_orderkey % 3 <> 0)"
_DELTA = "delta AS (SELECT o_orderkey AS k, o_custkey AS slice, o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS version, 'new' AS payload FROM orders WHERE o_orderkey % 3 <> 1)"


def _versions(spark, d):
    o = driver.table(spark, d, "orders").groupBy("o_orderkey").agg(F.min_by(F.struct("o_custkey", "o_totalprice", "o_orderstatus"), F.struct("o_custkey", "o_totalprice", "o_orderstatus")).alias("o"))
    base = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o.o_custkey").alias("slice"), F.col("o.o_totalprice").alias("version"), F.col("o.o_orderstatus").alias("payload"))
    shift = F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)
    delta = o.where("o_orderkey % 3 <> 1").select(F.col("o_orderkey").alias("k"), F.col("o.o_custkey").alias("slice"), (F.col("o.o_totalprice") + shift).alias("version"), F.lit("new").alias("payload"))
    return base, delta


_VERSIONS_SQL = f"WITH orders AS (SELECT * FROM main.orders QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey, o_totalprice, o_orderstatus) = 1), {_BASE}, {_DELTA}"


_ORDERS = contract("k long!; slice long; version double; payload string")


def _table(spark, name: str, base, bucket_by: tuple[str, ...], feed: bool = False) -> VersionedTable:
    """A new table of orders in the shared folder, with base as its first rows."""
    table = VersionedTable(spark, TableSpec(name, name, _ORDERS, bucket_by, change_feed=feed), landing.scratch(spark, "tables")).ensure()
    table.insert_new(base, ["k", "slice"])
    return table


@query("merge_insert_new", f"{_VERSIONS_SQL} SELECT * FROM base UNION ALL SELECT * FROM delta WHERE k NOT IN (SELECT k FROM base)")
def merge_insert_new(spark, d):
    base, delta = _versions(spark, d)
    table = _table(spark, "orders", base, ("k",))
    table.insert_new(delta, ["k"])
    return table.read()


_UPSERT_SQL = f"""{_VERSIONS_SQL}, m AS (
  SELECT coalesce(b.k, s.k) AS k, b.k IS NULL AS is_new, b.k IS NOT NULL AND s.k IS NOT NULL AND s.version > b.version AS is_newer, b.slice AS b_slice, b.version AS b_version,
         b.payload AS b_payload, s.slice AS s_slice, s.version AS s_version, s.payload AS s_payload FROM base b FULL JOIN delta s ON b.k = s.k)"""


@query("merge_upsert_latest", f"""{_UPSERT_SQL} SELECT k, CASE WHEN is_new OR is_newer THEN s_slice ELSE b_slice END AS slice,
  CASE WHEN is_new OR is_newer THEN s_version ELSE b_version END AS version, CASE WHEN is_new OR is_newer THEN s_payload ELSE b_payload END AS payload,
  CASE WHEN is_new THEN 'insert' WHEN is_newer THEN 'update' ELSE 'keep' END AS action FROM m""")
def merge_upsert_latest(spark, d):
    base, delta = _versions(spark, d)
    table = _table(spark, "orders", base, ("k",), feed=True)
    table.upsert_latest(delta, ["k"], ["version"])
    action = table.read_feed("changes").select("k", "_change_type").where("_change_type <> 'update_preimage'")
    action = action.select("k", F.when(F.col("_change_type") == "insert", "insert").otherwise("update").alias("action"))
    return table.read().join(action, "k", "left").withColumn("action", F.coalesce("action", F.lit("keep")))


@query("change_feed", f"""{_UPSERT_SQL} SELECT k, s_version AS version, CASE WHEN is_new THEN 'insert' ELSE 'update_postimage' END AS change_type FROM m WHERE is_new OR is_newer
UNION ALL SELECT k, b_version, 'update_preimage' FROM m WHERE is_newer""")
def change_feed(spark, d):
    base, delta = _versions(spark, d)
    table = _table(spark, "orders", base, ("k",), feed=True)
    table.upsert_latest(delta, ["k"], ["version"])
    return table.read_feed("changes").select("k", "version", F.col("_change_type").alias("change_type"))


_SLICES = "(1, 2, 4, 5, 7, 8, 10, 11, 13, 14)"


@query("merge_replace_slice", f"{_VERSIONS_SQL} SELECT * FROM base WHERE slice NOT IN {_SLICES} UNION ALL SELECT * FROM delta WHERE slice IN {_SLICES}")
def merge_replace_slice(spark, d):
    base, delta = _versions(spark, d)
    values = spark.createDataFrame([(v,) for v in (1, 2, 4, 5, 7, 8, 10, 11, 13, 14)], "slice long")
    table = _table(spark, "orders", base, ("slice",))
    table.replace_slice(delta.join(F.broadcast(values), "slice", "left_semi"), ["k", "slice"], values)
    return table.read()


@query("gold_incremental", f"""
WITH {driver.DETAIL_SQL} SELECT "Symbol", "Date", "Close", CASE WHEN "Symbol" < 'Brand#20' THEN cumulative_return_pct END AS cumulative_return_pct FROM detail""")
def gold_incremental(spark, d):
    """Only symbols below Brand#20 changed: their slices are recomputed, the others stay as they were (without the figure)."""
    bars = driver.silver_bars(spark, d)
    spec = TableSpec("figures", "figures", contract("Symbol string!; Date date!; Close double; cumulative_return_pct double"), ("Symbol",), cluster_by=("Symbol", "Date"))
    table = VersionedTable(spark, spec, landing.scratch(spark, "tables")).ensure()
    table.insert_new(bars.select("Symbol", "Date", "Close", F.lit(None).cast("double").alias("cumulative_return_pct")), gold.KEYS)
    feed = bars.select("Symbol", F.when(F.col("Symbol") < "Brand#20", "update_postimage").otherwise("update_preimage").alias("_change_type"))
    affected = merge.changed(feed, "Symbol")
    fresh = gold.detail(bars.join(affected, "Symbol", "left_semi")).select(*spec.contract.names)
    table.replace_slice(fresh, gold.KEYS, affected)
    return table.read()


@query("dq_metrics", f"WITH {driver.METRICS_SQL} SELECT *, rows_in - rows_valid - rows_quarantined AS rows_deduplicated, round(rows_quarantined / rows_in, 6) AS quarantine_rate FROM metrics")
def dq_metrics(spark, d):
    m = driver.metrics(spark, d).withColumns({"measured_date": F.to_date("measured_at"), "quarantine_rate": F.round("quarantine_rate", 6)})
    return m.drop("measured_at", "batch_id", "run_id")


@query("dq_daily", f"""
WITH {driver.METRICS_SQL} SELECT table_name, measured_date, count(*) AS batches, CAST(sum(rows_in) AS BIGINT) AS rows_in, CAST(sum(rows_valid) AS BIGINT) AS rows_valid,
  CAST(sum(rows_quarantined) AS BIGINT) AS rows_quarantined, CAST(sum(rows_in - rows_valid - rows_quarantined) AS BIGINT) AS rows_deduplicated,
  round(sum(rows_quarantined) / nullif(sum(rows_in), 0), 6) AS quarantine_rate FROM metrics GROUP BY 1, 2""")
def dq_daily(spark, d):
    return views.dq_daily(driver.metrics(spark, d)).withColumn("quarantine_rate", F.round("quarantine_rate", 6))


@query("layer_reconciliation", f"""
WITH {driver.RAW_BARS_SQL}
SELECT 'bronze' AS layer, count(*) AS total_rows, count(DISTINCT "Symbol") AS distinct_symbols, min(t_date) AS min_date, max(t_date) AS max_date FROM typed
UNION ALL SELECT 'silver', count(*), count(DISTINCT "Symbol"), min("Date"), max("Date") FROM silver
UNION ALL SELECT 'gold', count(*), count(DISTINCT "Symbol"), min("Date"), max("Date") FROM silver""")
def layer_reconciliation(spark, d):
    raw = driver.raw_bars(spark, d)
    clean = silver.BARS.valid(silver.BARS.judge(raw))
    return views.layer_reconciliation(raw, clean, gold.summary(gold.detail(clean)))


_DAYS_SQL = """SELECT CAST(d AS DATE) AS "Date" FROM generate_series(DATE '1992-01-01', DATE '1998-12-31', INTERVAL 1 DAY) AS g(d)"""
_CALENDAR_SQL = f"""
calendar AS (SELECT "Date", year("Date") AS "Year", quarter("Date") AS "Quarter", month("Date") AS "Month", monthname("Date") AS "MonthName",
  CAST(floor((dayofyear("Date") - 1 + dayofweek(date_trunc('year', "Date"))) / 7) + 1 AS BIGINT) AS "Week", dayname("Date") AS "DayOfWeek" FROM ({_DAYS_SQL}))"""


@query("date_dimension", f"WITH {_CALENDAR_SQL} SELECT * FROM calendar")
def date_dimension(spark, d):
    return calendar.dates(spark, "1992-01-01", "1998-12-31")


_MEASURES_SQL = """
  arg_max(close, row("Date", close)) AS latest_close, round(avg(intraday_return_pct), 6) AS avg_intraday_return_pct, round(sum(total_volume) / 1e6, 6) AS total_volume_m,
  max(high) AS all_time_high, min(low) AS all_time_low, round((max(high) - min(low)) / nullif(min(low), 0), 6) AS price_range,
  CASE WHEN coalesce(avg(ma_close_7d), 0) > coalesce(avg(ma_close_30d), 0) THEN 'BULLISH' WHEN coalesce(avg(ma_close_7d), 0) < coalesce(avg(ma_close_30d), 0) THEN 'BEARISH' ELSE 'NEUTRAL' END AS trend_signal,
  round(avg(ma_close_7d), 6) AS avg_ma_close_7d, round(avg(ma_close_30d), 6) AS avg_ma_close_30d"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("avg_intraday_return_pct", "total_volume_m", "price_range", "avg_ma_close_7d", "avg_ma_close_30d")})


@query("bi_measures", f'WITH {driver.SUMMARY_SQL} SELECT "Symbol", {_MEASURES_SQL} FROM summary GROUP BY 1')
def bi_measures(spark, d):
    return _rounded(bi.measures(driver.summary(spark, d), ["Symbol"]))


@query("bi_by_calendar", f'WITH {driver.SUMMARY_SQL}, {_CALENDAR_SQL} SELECT "Year", "Quarter", {_MEASURES_SQL} FROM summary LEFT JOIN calendar USING ("Date") GROUP BY 1, 2')
def bi_by_calendar(spark, d):
    return _rounded(bi.by_calendar(driver.summary(spark, d), calendar.dates(spark, "1992-01-01", "1998-12-31"), ["Year", "Quarter"]))


@query("ingest_windows", """
WITH w AS (SELECT d AS window_end FROM generate_series(TIMESTAMP '2026-01-01 23:00:00', TIMESTAMP '2026-01-31 23:00:00', INTERVAL 1 DAY) AS g(d)), c AS (SELECT unnest([1, 11, 12, 432]) AS series_code)
SELECT CAST(series_code AS INTEGER) AS series_code, strftime(window_end - INTERVAL 7 DAY, '%d/%m/%Y') AS date_from, strftime(window_end, '%d/%m/%Y') AS date_to,
       'bcb_sgs/series_code=' || series_code || '/' || strftime(window_end, '%Y-%m-%d') || '.json' AS file FROM w, c""")
def ingest_windows(spark, d):
    return landing.fetch_windows(spark, "2026-01-01 23:00:00", "2026-01-31 23:00:00")


def _landed(spark, d, kind: str):
    return landing.round_trip(spark, driver.bars(spark, d), kind)


_CONTRACT = {"Date": "date", "Symbol": "string", "Open": "double", "High": "double", "Low": "double", "Close": "double", "Volume": "bigint", "OpenInt": "string"}


def _contract(rows, *more):
    """The contract's columns as the types that were landed: text of a double comes back as that double."""
    return rows.select(*(F.col(c).cast(t).alias(c) for c, t in _CONTRACT.items()), *more)


@query("scan_csv_by_name", f"""WITH {driver.BARS_SQL} SELECT "Date", "Symbol", "Open", "High", "Low", "Close", "Volume", '0' AS "OpenInt",
  CASE WHEN "Volume" % 2 = 1 THEN '{{"Dividend":"' || CAST("Volume" AS VARCHAR) || '"}}' END AS rescued FROM bars""")
def scan_csv_by_name(spark, d):
    return _contract(_landed(spark, d, "csv"), F.col("_rescued_data").alias("rescued"))


@query("scan_json_array", f"""WITH {driver.BARS_SQL} SELECT "Date", "Symbol", "Open", "High", "Low", "Close", "Volume", '0' AS "OpenInt" FROM bars""")
def scan_json_array(spark, d):
    return _contract(_landed(spark, d, "json"))


@query("rescued_data", f"""WITH {driver.BARS_SQL} SELECT "Symbol", CAST("Date" AS VARCHAR) AS "Date",
  CASE WHEN "Volume" % 2 = 1 THEN '{{"Dividend":"' || CAST("Volume" AS VARCHAR) || '"}}' END AS rescued FROM bars""")
def rescued_data(spark, d):
    return _landed(spark, d, "csv").select("Symbol", "Date", F.col("_rescued_data").alias("rescued"))
