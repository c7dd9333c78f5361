"""The driver's tables as inputs of the engine: daily bars, raw text rows with planted defects, and raw series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.functions.bars import day_figures
from brightwater.functions.ingestion import ingestion_key
from brightwater.plans import gold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar for each brand and ship day; the first and last price go by the lines' full order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("Symbol"))
    order, price = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), F.col("l_extendedprice")
    joined = lines.join(parts, "l_partkey").withColumn("Date", F.to_date("l_shipdate"))
    return joined.groupBy("Symbol", "Date").agg(
        F.min_by(price, order).alias("Open"), F.max(price).alias("High"), F.min(price).alias("Low"), F.max_by(price, order).alias("Close"), F.sum("l_quantity").cast("long").alias("Volume")
    )


BARS_SQL = """
bars AS (
  SELECT p_brand AS "Symbol", CAST(l_shipdate AS DATE) AS "Date",
         first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS "Open",
         max(l_extendedprice) AS "High", min(l_extendedprice) AS "Low",
         last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS "Close",
         CAST(sum(l_quantity) AS BIGINT) AS "Volume"
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def silver_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_figures(bars(spark, sf_dir))


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.detail(silver_bars(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.summary(detail(spark, sf_dir))


_FIGURES = ", ".join(f'"{c}"' for c in ("Open", "High", "Low", "Close", "Volume"))
DETAIL_SQL = f"""{BARS_SQL},
day AS (
  SELECT *, round(("Close" - "Open") / "Open" * 100, 4) AS intraday_return_pct, round("High" - "Low", 4) AS intraday_range,
         round(("High" - "Low") / "Open" * 100, 4) AS price_spread_pct FROM bars),
detail AS (
  SELECT "Date", "Symbol", {_FIGURES}, intraday_return_pct, intraday_range, price_spread_pct,
         CASE WHEN count("Close") OVER w7 = 7 THEN round(avg("Close") OVER w7, 4) END AS ma_close_7d,
         CASE WHEN count("Close") OVER w30 = 30 THEN round(avg("Close") OVER w30, 4) END AS ma_close_30d,
         CASE WHEN count("Volume") OVER w7 = 7 THEN CAST(round(avg("Volume") OVER w7, 0) AS BIGINT) END AS ma_volume_7d,
         lag("Close") OVER w AS prev_close,
         round(("Close" - lag("Close") OVER w) / lag("Close") OVER w * 100, 4) AS day_over_day_return_pct,
         round(("Close" - first_value("Close") OVER w) / first_value("Close") OVER w * 100, 4) AS cumulative_return_pct
  FROM day
  WINDOW w AS (PARTITION BY "Symbol" ORDER BY "Date"),
         w7 AS (PARTITION BY "Symbol" ORDER BY "Date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY "Symbol" ORDER BY "Date" ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""
SUMMARY_SQL = f"""{DETAIL_SQL},
summary AS (
  SELECT "Symbol", "Date", "Open" AS open, "High" AS high, "Low" AS low, "Close" AS close, "Volume" AS total_volume, intraday_return_pct,
         ma_close_7d, ma_close_30d, day_over_day_return_pct, cumulative_return_pct FROM detail)"""


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bronze bars: all text, several versions of each (type, day), and a defect of each kind by event_id % 40."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    kind, value, text = F.col("event_id") % 40, F.col("value"), lambda c: c.cast("string")
    close = F.when(F.col("event_id") % 3 == 0, value).when(F.col("event_id") % 3 == 1, value * 2).otherwise(value / 2)
    columns = {
        "Date": F.when(kind == 1, "02/01/2024").otherwise(F.date_format("ts", "yyyy-MM-dd")),
        "Symbol": F.when(kind == 2, "  ").when(F.col("event_id") % 2 == 0, F.concat(F.lit(" "), F.col("event_type"))).otherwise(F.col("event_type")),
        "Open": F.when(kind == 3, "-1").otherwise(text(value)),
        "High": F.when(kind == 5, "x1").when(kind == 7, text(value / 4)).otherwise(text(value * 2)),
        "Low": F.when(kind != 6, text(value / 2)),
        "Close": F.when(kind.isin(4, 10), "abc").otherwise(text(close)),
        "Volume": F.when(kind.isin(8, 10), "-5").otherwise(text(F.col("user_id"))),
        "OpenInt": F.when(kind == 11, "n/a").otherwise("0"),
        "_rescued_data": F.when(kind == 9, '{"Dividend":"0.2"}'),
        "_source_file": F.concat(F.lit("landing/part-"), text(F.col("event_id") % 10), F.lit(".csv")),
        "_source_modified_at": F.col("ts").cast("timestamp"),
        "_ingested_at": (F.col("ts") + F.make_interval(days=(F.col("event_id") % 5).cast("int"))).cast("timestamp"),
        "_run_id": F.lit("run"),
    }
    rows = e.select(*(c.alias(n) for n, c in columns.items()))
    return rows.withColumn("_ingestion_key", ingestion_key(["Date", "Symbol", "Open", "High", "Low", "Close", "Volume", "OpenInt", "_rescued_data"]))


_RAW = ["Date", "Symbol", "Open", "High", "Low", "Close", "Volume", "OpenInt"]
RAW_BARS_SQL = f"""
raw0 AS (
  SELECT CASE WHEN event_id % 40 = 1 THEN '02/01/2024' ELSE strftime(ts, '%Y-%m-%d') END AS "Date",
         CASE WHEN event_id % 40 = 2 THEN '  ' WHEN event_id % 2 = 0 THEN ' ' || event_type ELSE event_type END AS "Symbol",
         CASE WHEN event_id % 40 = 3 THEN '-1' ELSE CAST(value AS VARCHAR) END AS "Open",
         CASE WHEN event_id % 40 = 5 THEN 'x1' WHEN event_id % 40 = 7 THEN CAST(value / 4 AS VARCHAR) ELSE CAST(value * 2 AS VARCHAR) END AS "High",
         CASE WHEN event_id % 40 <> 6 THEN CAST(value / 2 AS VARCHAR) END AS "Low",
         CASE WHEN event_id % 40 IN (4, 10) THEN 'abc' ELSE CAST(CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN value * 2 ELSE value / 2 END AS VARCHAR) END AS "Close",
         CASE WHEN event_id % 40 IN (8, 10) THEN '-5' ELSE CAST(user_id AS VARCHAR) END AS "Volume",
         CASE WHEN event_id % 40 = 11 THEN 'n/a' ELSE '0' END AS "OpenInt",
         CASE WHEN event_id % 40 = 9 THEN '{{"Dividend":"0.2"}}' END AS _rescued_data,
         'landing/part-' || event_id % 10 || '.csv' AS _source_file, ts, ts + to_days(CAST(event_id % 5 AS INTEGER)) AS _ingested_at
  FROM events),
raw AS (
  SELECT *, sha256(concat_ws(chr(31), _source_file, {', '.join(f'coalesce("{c}", chr(0))' for c in _RAW)}, coalesce(_rescued_data, chr(0)))) AS _ingestion_key
  FROM raw0),
typed AS (
  SELECT *, CASE WHEN regexp_full_match("Date", '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST("Date" AS DATE) END AS t_date, upper(trim("Symbol")) AS t_symbol,
         {', '.join(f'try_cast("{c}" AS DOUBLE) AS t_{c.lower()}' for c in ("Open", "High", "Low", "Close"))},
         {', '.join(f'try_cast("{c}" AS BIGINT) AS t_{c.lower()}' for c in ("Volume", "OpenInt"))}
  FROM raw),
judged AS (
  SELECT *, concat_ws(';',
    CASE WHEN _rescued_data IS NOT NULL THEN 'schema_drift' END, CASE WHEN t_date IS NULL THEN 'date_invalid' END,
    CASE WHEN t_symbol IS NULL OR t_symbol = '' THEN 'symbol_missing' END,
    {', '.join(f"CASE WHEN t_{c} IS NULL OR t_{c} <= 0 THEN '{c}_invalid' END" for c in ("open", "close", "high", "low"))},
    CASE WHEN t_high < t_low THEN 'high_below_low' END,
    CASE WHEN t_high < greatest(t_open, t_close) OR t_low > least(t_open, t_close) THEN 'ohlc_inconsistent' END,
    CASE WHEN t_volume IS NULL OR t_volume < 0 THEN 'volume_invalid' END) AS reason
  FROM typed),
silver AS (
  SELECT t_date AS "Date", t_symbol AS "Symbol", t_open AS "Open", t_high AS "High", t_low AS "Low", t_close AS "Close", t_volume AS "Volume",
         t_openint AS "OpenInt", _ingestion_key, _source_file
  FROM (SELECT *, row_number() OVER (PARTITION BY t_symbol, t_date ORDER BY _ingested_at DESC, _source_file DESC, _ingestion_key DESC) AS n FROM judged WHERE reason = '')
  WHERE n = 1)"""


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bronze series: the code from the path, one unknown code, and dates and values that can't be read."""
    from brightwater.functions.series import code_of

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    code = F.element_at(F.array(*map(F.lit, ("1", "11", "12", "432", "99999"))), (F.col("o_custkey") % 5 + 1).cast("int"))
    file = F.concat(F.lit("raw/bcb_sgs/series_code="), code, F.lit("/"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".json"))
    rows = o.select(
        F.when(F.col("o_orderkey") % 50 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("data"),
        F.when(F.col("o_orderkey") % 60 == 2, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("valor"),
        F.lit(None).cast("string").alias("_rescued_data"), file.alias("_source_file"), F.col("o_orderdate").cast("timestamp").alias("_source_modified_at"),
        (F.col("o_orderdate") + F.make_interval(days=(F.col("o_orderkey") % 7).cast("int"))).cast("timestamp").alias("_ingested_at"), F.lit("run").alias("_run_id"),
    )
    rows = rows.withColumn("series_code", code_of(F.col("_source_file")))
    return rows.withColumn("_ingestion_key", ingestion_key(["series_code", "data", "valor", "_rescued_data"]))


RAW_SERIES_SQL = """
raw0 AS (
  SELECT CASE WHEN o_orderkey % 50 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS data,
         CASE WHEN o_orderkey % 60 = 2 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS valor,
         'raw/bcb_sgs/series_code=' || (['1', '11', '12', '432', '99999'])[o_custkey % 5 + 1] || '/' || strftime(o_orderdate, '%Y%m') || '.json' AS _source_file,
         o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) AS _ingested_at
  FROM orders),
raw1 AS (SELECT *, nullif(regexp_extract(_source_file, 'series_code=(\\d+)', 1), '') AS series_code FROM raw0),
raw AS (SELECT *, sha256(concat_ws(chr(31), _source_file, series_code, data, valor, chr(0))) AS _ingestion_key FROM raw1),
typed AS (
  SELECT *, try_cast(series_code AS INTEGER) AS code,
         CASE try_cast(series_code AS INTEGER) WHEN 1 THEN 'usd_brl_ptax_venda' WHEN 11 THEN 'selic_diaria' WHEN 12 THEN 'cdi_diario' WHEN 432 THEN 'selic_meta' END AS series_name,
         CASE WHEN regexp_full_match(data, '\\d{2}/\\d{2}/\\d{4}') THEN CAST(strptime(data, '%d/%m/%Y') AS DATE) END AS ref_date,
         try_cast(valor AS DECIMAL(20,8)) AS value
  FROM raw),
judged AS (
  SELECT *, concat_ws(';', CASE WHEN series_name IS NULL THEN 'series_unknown' END, CASE WHEN ref_date IS NULL THEN 'date_invalid' END,
                      CASE WHEN value IS NULL THEN 'value_invalid' END) AS reason
  FROM typed)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch metrics as if each (event type, day) of raw bars were a batch."""
    from brightwater.functions import bars as b
    from brightwater.operators.rules import with_reasons

    judged = with_reasons(b.typed(raw_bars(spark, sf_dir)), b.RULES).withColumn("day", F.to_date("_source_modified_at"))
    good = F.when(F.col("_rejection_reason") == "", F.col("_typed.Symbol"))
    per = judged.groupBy(F.lower(F.trim("Symbol")).alias("table_name"), "day").agg(
        F.count("*").alias("rows_in"), F.count_distinct(good).alias("rows_valid"), F.count_if(F.col("_rejection_reason") != "").alias("rows_quarantined")
    )
    return per.withColumns({
        "batch_id": F.datediff("day", F.lit("2024-01-01").cast("date")).cast("long"), "run_id": F.lit("run"), "measured_at": F.col("day").cast("timestamp"),
        "rows_deduplicated": F.col("rows_in") - F.col("rows_valid") - F.col("rows_quarantined"), "quarantine_rate": F.try_divide(F.col("rows_quarantined").cast("double"), F.col("rows_in")),
    }).drop("day")


METRICS_SQL = f"""{RAW_BARS_SQL},
metrics AS (
  SELECT lower(trim("Symbol")) AS table_name, CAST(ts AS DATE) AS measured_date, count(*) AS rows_in,
         count(DISTINCT CASE WHEN reason = '' THEN t_symbol END) AS rows_valid, count(*) FILTER (WHERE reason <> '') AS rows_quarantined
  FROM judged GROUP BY 1, 2)"""
