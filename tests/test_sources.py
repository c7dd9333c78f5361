"""Landing helpers, windows, calendar and the sample."""

import datetime
import zipfile

import pytest
from pyspark.sql import functions as F

from brightwater.functions import bars
from brightwater.operators.rules import with_reasons
from brightwater.plans import catalog
from brightwater.schema import RAW_BARS
from brightwater.sources import calendar, driver, landing, sample


def test_request_for_a_window():
    address, file = landing.request(11, datetime.date(2026, 1, 8))
    assert address.endswith("sgs.11/dados?formato=json&dataInicial=01/01/2026&dataFinal=08/01/2026") and file == "bcb_sgs/series_code=11/2026-01-08.json"


def test_zip_and_copy(spark, tmp_path):
    for d in ("zip", "from/deep", "to"):
        (tmp_path / d).mkdir(parents=True)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.csv", "a\n1\n")
        z.writestr("x/readme.txt", "no")
    assert landing.unzip(spark, f"file://{tmp_path}/a.zip", str(tmp_path / "zip")) == [f"{tmp_path}/zip/one.csv"]
    assert (tmp_path / "zip/one.csv").read_text() == "a\n1\n" and not (tmp_path / "zip/readme.txt").exists()
    (tmp_path / "from/deep/two.csv").write_text("b\n2\n")
    for _ in range(2):
        assert len(landing.land_files(spark, str(tmp_path / "from"), str(tmp_path / "to"))) == 1
    assert (tmp_path / "to/two.csv").read_text() == "b\n2\n"


def test_csv_by_name_with_odd_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Symbol,Date,Close.raw,Symbol\nA,2024-01-02,1,B\n")
    (tmp_path / "b.csv").write_text("Date,Symbol\n2024-01-03,C\n")
    rows = {r["Date"]: r for r in landing.read_csv(spark, [str(tmp_path / f) for f in ("a.csv", "b.csv")], RAW_BARS).collect()}
    assert rows["2024-01-02"]["Symbol"] == "A" and rows["2024-01-02"]["_rescued_data"] == '{"Close.raw":"1","Symbol_3":"B"}'
    assert rows["2024-01-03"]["_rescued_data"] is None and rows["2024-01-03"]["Close"] is None
    assert landing.read_csv(spark, [str(tmp_path / "b.csv")], RAW_BARS).count() == 1


def test_csv_headers_come_from_files_beginnings(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text("\ufeffDate,Symbol\n2024-01-02,A\n")
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"Date,Symbol\r\n2024-01-03,B\r\n"))
    (tmp_path / "c.csv").write_text("")
    paths = [f"{tmp_path}/{n}" for n in ("a.csv", "b.csv.gz", "c.csv")]
    assert landing.headers(spark, paths) == {"Date,Symbol": paths[:2]}
    assert {(r["Date"], r["Symbol"]) for r in landing.read_csv(spark, paths, RAW_BARS).collect()} == {("2024-01-02", "A"), ("2024-01-03", "B")}
    assert landing.read_csv(spark, paths[2:], RAW_BARS).count() == 0


def test_json_keeps_values_as_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"Date": "2024-01-02", "Symbol": "A", "Close": 1.50, "Extra": "007"}, {"Date": null, "Symbol": "B"}]')
    a, b = landing.read_json(spark, [str(tmp_path / "a.json")], RAW_BARS).orderBy("Symbol").collect()
    assert a["_rescued_data"] == '{"Extra":"007"}' and a["Open"] is None and b["_rescued_data"] is None and b["Date"] is None


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_round_trip_keeps_all_columns(spark, kind):
    day = datetime.date(2024, 1, 2)
    bars_ = spark.createDataFrame([(day, "Brand#11", 1.5, 3.25, 1.0, 2.0, 7), (day, "Brand#55", 10.0, 12.5, 9.75, 11.0, 8)], "Date date, Symbol string, Open double, High double, Low double, Close double, Volume long")
    rows = sorted(map(tuple, landing.round_trip(spark, bars_, kind).select(*RAW_BARS.names).collect()))
    assert rows == [("2024-01-02", "Brand#11", "1.5", "3.25", "1.0", "2.0", "7", "0"), ("2024-01-02", "Brand#55", "10.0", "12.5", "9.75", "11.0", "8", "0")]


@pytest.mark.parametrize("name, kind", [("scan_csv_by_name", "csv"), ("scan_json_array", "json"), ("rescued_data", "csv")])
def test_queries_land_all_bars(spark, monkeypatch, name, kind):
    sf, seen, trip = "/root/testdata/sf0.001", [], landing.round_trip
    monkeypatch.setattr(landing, "round_trip", lambda s, b, k: seen.append((b.count(), k)) or trip(s, b, k))
    out = catalog.QUERIES[name](spark, sf)
    assert seen == [(driver.bars(spark, sf).count(), kind)] and out.count() == seen[0][0]


def test_files_written_again_are_new(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    found = landing.listing(spark, str(tmp_path), "*.csv")
    assert landing.unseen(found, found).count() == 0 and landing.unseen(found, found.withColumn("modified", F.col("modified") - F.expr("INTERVAL 1 SECOND"))).count() == 1


def test_weeks_begin_on_sunday(spark):
    rows = {str(r["Date"]): r for r in calendar.dates(spark, "2020-01-01", "2022-12-31").collect()}
    assert (rows["2020-01-04"]["Week"], rows["2020-01-05"]["Week"], rows["2022-12-31"]["Week"]) == (1, 2, 53)
    assert (rows["2020-02-29"]["MonthName"], rows["2020-02-29"]["DayOfWeek"], rows["2020-02-29"]["Quarter"]) == ("February", "Saturday", 1)


def test_sample_breaks_no_rule(spark):
    rows = sample.rows()
    assert rows == sample.rows() and len({(r["Symbol"], r["Date"]) for r in rows}) == len(rows) == 500
    judged = with_reasons(bars.typed(spark.createDataFrame(rows).withColumn("_rescued_data", F.lit(None).cast("string"))), bars.RULES)
    assert judged.where("_rejection_reason <> ''").count() == 0
