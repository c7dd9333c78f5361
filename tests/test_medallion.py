"""The layers end to end over versioned tables: replay, late data, breaker, changes, contracts."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from brightwater import schema
from brightwater.functions import bars
from brightwater.operators import merge
from brightwater.operators import rules
from brightwater.operators.rules import QualityError, with_reasons
from brightwater.plans import gold, silver
from brightwater.streaming import datasets as ds
from brightwater.streaming import medallion as m
from brightwater.streaming.vtable import CommitConflict, TableSpec, VersionedTable

GOOD = {"Date": "2023-11-07", "Symbol": "KELP", "Open": "40.0", "High": "48.5", "Low": "39.0", "Close": "47.0", "Volume": "7300", "OpenInt": "12"}


def raw(spark, *rows, day=3):
    at = datetime.datetime(2024, 1, day, 6)
    data = [GOOD | {"_rescued_data": None, "_source_file": "f.csv", "_source_modified_at": at, "_ingested_at": at, "_run_id": "r"} | r for r in rows]
    df = spark.createDataFrame(data, schema.contract("; ".join(f"{f.name} {'timestamp' if f.name.endswith('_at') else 'string'}" for f in schema.BRONZE_BARS.fields if f.name != "_ingestion_key")))
    from brightwater.functions.ingestion import ingestion_key

    return df.withColumn("_ingestion_key", ingestion_key([*bars.COLUMNS, "_rescued_data"]))


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"Close": None}, "close_invalid"), ({"Close": "0"}, "close_invalid;ohlc_inconsistent"), ({"Close": "abc"}, "close_invalid"), ({"Open": "-1"}, "open_invalid;ohlc_inconsistent"),
        ({"Date": "07/11/2023"}, "date_invalid"), ({"Date": None}, "date_invalid"), ({"Symbol": "  "}, "symbol_missing"), ({"High": "38.0", "Low": "39.0"}, "high_below_low;ohlc_inconsistent"),
        ({"High": "46.0"}, "ohlc_inconsistent"), ({"Low": "41.0"}, "ohlc_inconsistent"), ({"Volume": "-5"}, "volume_invalid"), ({"Close": "abc", "Volume": "-1"}, "close_invalid;volume_invalid"),
        ({"_rescued_data": '{"Dividend":"0.2"}'}, "schema_drift"), ({"OpenInt": "x"}, ""), ({}, ""),
    ],
)
def test_rules(spark, change, reason):
    row = with_reasons(bars.typed(raw(spark, change)), bars.RULES).first()
    assert row["_rejection_reason"] == reason and row["Close"] == (GOOD | change)["Close"]


def test_contract_differences():
    want, found = schema.contract("a string; b long"), lambda text: [tuple(d) for d in schema.differences(schema.contract(text), want)]
    assert found("b long; a string!") == []
    assert found("a string") == [("b", "bigint", None)]
    assert found("a string; b string; c int") == [("b", "bigint", "string"), ("c", None, "int")]
    with pytest.raises(schema.ContractError, match=r"x: b \(string\) should be bigint, c \(int\) isn't in the contract"):
        schema.require(schema.contract("a string; b string; c int"), want, "x")
    assert "`a` string NOT NULL" in schema.create_table("t", schema.contract("a string!"), "/x", {"k": "v"})


def test_tables_have_names_and_places_of_their_own():
    assert len({t.name for t in ds.tables()}) == len({t.path for t in ds.tables()}) == len(ds.tables()) == 9
    with pytest.raises(ValueError, match="ohlcv"):
        ds.named("nothing")


def test_breaker_passes_at_the_limit(spark):
    counts = spark.createDataFrame([("t", 1, 4, 1, 1), ("t", 2, 0, 0, 0)], "table_name string, batch_id long, rows_in long, rows_valid long, rows_quarantined long")
    rates = rules.with_rates(counts)
    assert [(r["rows_deduplicated"], r["quarantine_rate"]) for r in rates.orderBy("batch_id").collect()] == [(2, 0.25), (0, 0.0)]
    rules.breaker(rates, 0.25)
    with pytest.raises(QualityError, match="1 of 4 in batch 1"):
        rules.breaker(rates, 0.2)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_typed_and_judged_once(spark):
    bronze = raw(spark, {})
    layers = silver.bars_to_silver(bronze)
    for df in (layers.valid, layers.quarantine):
        plan = plan_of(df)
        assert max(plan.count(f"cast({c}#") for c in ("Open", "Close", "Volume")) == 1


def test_keys_tell_contents_apart(spark):
    rows = [{"Open": None}, {"Open": ""}, {"_source_file": "g.csv"}, {"Open": "1", "High": "23"}, {"Open": "12", "High": "3"}, {"_rescued_data": "{}"}, {}]
    assert len({r[0] for r in raw(spark, *rows).select("_ingestion_key").collect()}) == len(rows)


def test_latest_doesnt_depend_on_arrangement(spark):
    df = raw(spark, {"Close": "101.0"}, {"Close": "102.0"}, {"Close": "103.0"})
    found = {merge.latest(x, ["Symbol", "Date"]).first()["Close"] for x in (df, df.orderBy(F.desc("Close")), df.repartition(5))}
    assert len(found) == 1


def test_newer_never_wins_with_null(spark):
    t = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    s = spark.createDataFrame([("a", None), ("b", 2), ("c", None)], "k string, v int")
    rows = {r["k"]: r["_action"] for r in merge.upsert_latest(t, s, ["k"], ["v"]).collect()}
    assert rows == {"a": "keep", "b": "keep", "c": "insert"}


def test_layers(spark, tmp_path):
    tables = m.bootstrap(spark, str(tmp_path))
    write = lambda df, n=0, rate=1.0: m.silver_batch(df, n, ds.BARS, tables, "r", rate)
    counts = write(raw(spark, {}, {"_source_file": "a.csv"}, {"Close": "47.5", "_source_file": "z.csv"}, {"Close": "abc", "Symbol": "DUNE"}))
    assert [counts[c] for c in ("rows_in", "rows_valid", "rows_quarantined", "rows_deduplicated")] == [4, 1, 1, 2]
    silver_ = tables["silver.ohlcv"]
    assert [r["Close"] for r in silver_.read().collect()] == [47.5]
    version, rejected = silver_.manifest()["version"], tables["silver.ohlcv_quarantine"].manifest()["version"]
    write(raw(spark, {"Close": "47.5", "_source_file": "z.csv"}, {"Close": "abc", "Symbol": "DUNE"}))  # a replay
    write(raw(spark, {"Close": "44.5"}, day=1))  # an older version that comes late
    assert silver_.manifest()["version"] == version and tables["silver.ohlcv_quarantine"].manifest()["version"] == rejected
    with pytest.raises(QualityError):
        write(raw(spark, {"Symbol": "X", "Close": "no"}), 7, 0.05)
    assert silver_.manifest()["version"] == version and tables["silver.ohlcv_quarantine"].read().count() == 2
    assert tables["ops.dq_metrics"].read().where("batch_id = 7").first()["quarantine_rate"] == 1.0
    assert m.gold_batch(silver_.read_feed("changes"), tables) == 1
    before = tables["gold.ohlcv_detail"].read().first()
    write(raw(spark, {"Symbol": "DUNE"}, day=5), 8)
    last = silver_.read_feed("changes", since=version)
    assert last.count() == 1 and m.gold_batch(last, tables) == 1
    assert m.gold_batch(last.withColumn("_change_type", F.lit("update_preimage")), tables) == 0
    after = {r["Symbol"]: r for r in tables["gold.ohlcv_detail"].read().collect()}
    assert after["KELP"] == before and set(after) == {"KELP", "DUNE"}
    assert tables["gold.ohlcv_daily_summary"].read().count() == 2
    rows, changes = silver_.read().orderBy("Symbol").collect(), silver_.read_feed("changes").count()
    silver_.compact(buckets=3)
    assert silver_.read().orderBy("Symbol").collect() == rows and silver_.read_feed("changes").count() == changes and silver_.manifest()["buckets"] == 3
    write(raw(spark, {"Symbol": "DUNE", "Close": "41.0"}, day=6), 9)
    assert silver_.read(version).count() == 1 and {r["Close"] for r in silver_.read().collect()} == {47.5, 41.0}
    assert silver_._names(f"{silver_.at}/staging") == []


def small(spark, root, text="k string!; slice string; v long", **more):
    return VersionedTable(spark, TableSpec("t", "t", schema.contract(text), **more), str(root)).ensure()


def kv(spark, *rows):
    return spark.createDataFrame(rows, "k string, slice string, v long")


def test_tables_refuse_what_breaks_their_contract(spark, tmp_path):
    table = small(spark, tmp_path)
    with pytest.raises(schema.ContractError, match="isn't in the contract"):
        table.insert_new(kv(spark, ("x", "s", 1)).withColumn("c", F.lit(1)), ["k"])
    with pytest.raises(schema.ContractError, match="required"):
        table.insert_new(kv(spark, (None, "s", 1)), ["k"])
    assert table.read().count() == 0 and table.versions() == [0]
    with pytest.raises(schema.ContractError):
        small(spark, tmp_path, "k string!; slice string; v int")
    assert table.insert_new(kv(spark, ("x", "s", 1)), ["k"]) == 1
    assert table.insert_new(kv(spark, ("x", "s", 2), ("y", "s", 3)), ["k"]) == 1
    assert sorted(map(tuple, table.read().collect())) == [("x", "s", 1), ("y", "s", 3)]
    with pytest.raises(ValueError, match="part of the key"):
        small(spark, tmp_path / "b", bucket_by=("slice",)).insert_new(kv(spark, ("x", "s", 1)), ["k"])


def test_versions_are_whole_or_not_there(spark, tmp_path):
    table = small(spark, tmp_path)
    table.insert_new(kv(spark, ("x", "s", 1)), ["k"])
    log = tmp_path / "t/_log"
    with pytest.raises(CommitConflict):
        table._commit(table.manifest() | {"data": {}})
    assert table.read().count() == 1
    (log / ".half.tmp").write_text('{"version": 2, "da')  # a writer that broke off
    assert table.versions() == [0, 1] and sorted(p.name for p in log.glob("0*")) == ["00000000.json", "00000001.json"]
    table.insert_new(kv(spark, ("y", "s", 2)), ["k"])
    assert table.read().count() == 2


def test_nothing_new_makes_no_version(spark, tmp_path):
    table = small(spark, tmp_path, bucket_by=("k",))
    rows = kv(spark, *((f"k{i}", "s", i) for i in range(40)))
    assert table.insert_new(rows, ["k"]) == 40 and table.insert_new(rows, ["k"]) == 0
    table.upsert_latest(rows, ["k"], ["v"])
    assert table.versions() == [0, 1]


@pytest.mark.parametrize("bucket_by", [("slice",), ()])
def test_replace_slice_loses_no_row(spark, tmp_path, bucket_by):
    table = small(spark, tmp_path, bucket_by=bucket_by)
    table.insert_new(kv(spark, *((f"k{i}", f"s{i % 32}", i) for i in range(64))), ["k", "slice"])
    # Of slice s1 one row is revised, one is gone and one new; the source also has a row of s9 that is there, and one that isn't.
    source = kv(spark, ("k1", "s1", 100), ("new", "s1", 101), ("k9", "s9", 102), ("stray", "s9", 103))
    table.replace_slice(source, ["k", "slice"], spark.createDataFrame([("s1",), ("s1",), ("none",)], "slice string"))
    want = {(f"k{i}", f"s{i % 32}"): i for i in range(64) if i not in (1, 33)} | {("k1", "s1"): 100, ("new", "s1"): 101, ("k9", "s9"): 102, ("stray", "s9"): 103}
    assert {(r["k"], r["slice"]): r["v"] for r in table.read().collect()} == want and table.read().count() == len(want)


def test_feeds_hold_committed_rows_once(spark, tmp_path):
    table = small(spark, tmp_path / "root")
    seen = []

    def follow():
        return m._drain(table, "added", str(tmp_path / "check"), lambda rows, n: seen.extend(r["k"] for r in rows.collect()) or rows.count())

    table.insert_new(kv(spark, ("a", "s", 1), ("b", "s", 2)), ["k"])
    kv(spark, ("lost", "s", 0)).write.parquet(f"{table.at}/data/never-committed")
    table.insert_new(kv(spark, ("c", "s", 3)), ["k"])
    assert follow() == m.Taken(1, 3)
    table.compact()
    assert follow().rows == 0
    table.insert_new(kv(spark, ("d", "s", 4)), ["k"])
    assert follow() == m.Taken(1, 1) and sorted(seen) == ["a", "b", "c", "d"]
    assert table.vacuum(keep=1) >= 3 and table.read().count() == 4


def test_a_merge_reads_touched_buckets_only(spark, tmp_path):
    table = small(spark, tmp_path, bucket_by=("k",))
    table.insert_new(kv(spark, *((f"k{i}", "s", i) for i in range(200))), ["k"])
    old = table.manifest()["data"]
    table.upsert_latest(kv(spark, ("k7", "s", 1000)), ["k"], ["v"])
    new = table.manifest()["data"]
    assert len(old) == 16 and sum(old[b] != new[b] for b in old) == 1
    assert len(table.read_matching(spark.createDataFrame([("k7",)], "k string")).inputFiles()) == 1
    assert [r["v"] for r in table.read_matching(spark.createDataFrame([("k7",)], "k string")).collect()] == [1000]


def test_runs_exclude_each_other_and_try_again(spark, tmp_path):
    config = m.Config(str(tmp_path), str(tmp_path))
    with m._only_run(spark, config), pytest.raises(m.RunConflict), m._only_run(spark, config):
        pass
    with m._only_run(spark, config):
        pass
    calls = []

    def work():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return "done"

    assert m.attempt(work, 3, 0.0) == "done" and len(calls) == 3
    with pytest.raises(QualityError):
        m.attempt(lambda: (_ for _ in ()).throw(QualityError("bad")), 3, 100.0)


def test_a_run_is_due_after_quiet(spark):
    at = lambda minute: datetime.datetime(2024, 1, 1, 0, minute, tzinfo=datetime.timezone.utc)
    files = spark.createDataFrame([("a", datetime.datetime(2024, 1, 1, 0, 10))], "path string, modified timestamp").withColumn("modified", F.to_timestamp(F.lit("2024-01-01 00:10:00")))
    local = lambda t: t.replace(tzinfo=None)
    assert not m.due(files, local(at(12)), None) and m.due(files, local(at(16)), None)
    assert not m.due(files, local(at(16)), local(at(5))) and m.due(files, local(at(30)), local(at(5))) and not m.due(files, local(at(50)), local(at(20)))
    assert not m.due(files.limit(0), local(at(30)), None)


def test_namespaces(spark, tmp_path):
    tables = m.bootstrap(spark, str(tmp_path))
    m.silver_batch(raw(spark, {}), 0, ds.BARS, tables, "r", 1.0)
    m.create_namespaces(spark, tables)
    assert spark.sql("SELECT Close FROM silver.ohlcv").first()[0] == 47.0 and spark.sql("SELECT * FROM gold.ohlcv_detail").count() == 0
    for layer in ("bronze", "silver", "gold", "ops"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_run_from_files(spark, tmp_path):
    land, root = tmp_path / "landing", tmp_path / "root"
    (land / "financial-data").mkdir(parents=True)
    (land / "bcb_sgs/series_code=11").mkdir(parents=True)
    days = [f"2024-01-{d:02d}" for d in range(2, 12)]
    head = "Date,Symbol,Open,High,Low,Close,Volume,OpenInt"
    (land / "financial-data/a.csv").write_text("\n".join([head, *(f"{d},KELP,100.0,120.0,90.0,{100 + i}.0,{1000 * (i + 1)},0" for i, d in enumerate(days))]) + "\n")
    (land / "financial-data/b.csv").write_text("Symbol,Date,Close,Open,High,Low,Volume,OpenInt,Dividend\ndune,2024-01-02,10.0,10.0,11.0,9.0,5,0,\n")
    (land / "financial-data/licence.txt").write_text("nothing")
    (land / "bcb_sgs/series_code=11/2024-01-05.json").write_text(json.dumps([{"data": "02/01/2024", "valor": "4.9"}, {"data": "03/01/2024", "valor": "4.95"}]))
    config = m.Config(str(root), str(land))
    first = m.run(spark, config)
    assert (first["bronze_ohlcv"], first["bronze_bcb_sgs"], first["silver_ohlcv"]) == (2, 1, m.Taken(1, 11))
    tables = m.bootstrap(spark, str(root))
    detail = tables["gold.ohlcv_detail"].read().where("Symbol = 'KELP'").orderBy("Date").collect()
    assert [r["ma_close_7d"] for r in detail[:7]] == [None] * 6 + [103.0] and detail[6]["ma_volume_7d"] == 4000
    assert detail[0]["cumulative_return_pct"] == 0.0 and detail[1]["day_over_day_return_pct"] == 1.0 and detail[0]["prev_close"] is None
    assert tables["silver.bcb_sgs"].read().count() == 2
    again = m.run(spark, config)
    assert again["bronze_ohlcv"] == 0 and tables["gold.ohlcv_detail"].read().count() == 11
    path = land / "financial-data/b.csv"
    path.write_text(path.read_text().replace("10.0,10.0", "10.5,10.0"))
    os.utime(path, (path.stat().st_mtime + 60,) * 2)
    assert m.run(spark, config)["bronze_ohlcv"] == 1
    assert tables["silver.ohlcv"].read().where("Symbol = 'DUNE'").first()["Close"] == 10.5
    m.register_views(tables)
    assert spark.sql("SELECT count(*) FROM silver_ohlcv").first()[0] == 11


def test_tasks_come_in_order():
    assert m.order(m.TASKS).index("silver_ohlcv") < m.order(m.TASKS).index("gold")
    with pytest.raises(ValueError):
        m.order({"a": ("b",), "b": ("a",)})


def test_gold_windows_share_one_exchange(spark):
    df = spark.createDataFrame([("A", datetime.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, 0.0)], "Symbol string, Date date, Open double, High double, Low double, Close double, Volume long, intraday_return_pct double, intraday_range double, price_spread_pct double")
    plan = gold.detail(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1
