"""The landing folder: files in, rows by column name with what is unexpected rescued, and which files are new."""

from __future__ import annotations

import csv
import datetime
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwater.schema import RAW_BARS

# Fixed value: what the source's address takes, in this order.
SERIES_ADDRESS = "/dados/serie/bcdata.sgs.{code}/dados?formato=json&dataInicial={first}&dataFinal={last}"
SERIES_CODES = (1, 11, 12, 432)
WINDOW_DAYS = 7
#: Files whose headers are read at the same time.
THREADS = 16


def _fs(spark: SparkSession, at: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder in the one that all machines share, deleted when the session's JVM ends.

    That is spark.checkpoint.dir; only a local master may do without it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        shared = "/tmp/brightwater-scratch"
    at = f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    fs, path = _fs(spark, at)
    fs.deleteOnExit(path)
    return at


def request(code: int, end: datetime.date) -> tuple[str, str]:
    """The address of a series' window that ends on a day, and where its answer lands."""
    first = end - datetime.timedelta(days=WINDOW_DAYS)
    address = SERIES_ADDRESS.format(code=code, first=f"{first:%d/%m/%Y}", last=f"{end:%d/%m/%Y}")
    return address, f"bcb_sgs/series_code={code}/{end:%Y-%m-%d}.json"


def fetch_windows(spark: SparkSession, first_end: str, last_end: str, codes: tuple[int, ...] = SERIES_CODES) -> DataFrame:
    """The daily windows of each series whose end lies between two times: what to fetch, and the file it goes to."""
    ends = F.explode(F.sequence(F.lit(first_end).cast("timestamp"), F.lit(last_end).cast("timestamp"), F.expr("INTERVAL 1 DAY"))).alias("end")
    rows = spark.range(1).select(ends).select(F.explode(F.array(*map(F.lit, codes))).alias("series_code"), "end")
    day = lambda c: F.date_format(c, "dd/MM/yyyy")
    file = F.concat(F.lit("bcb_sgs/series_code="), F.col("series_code").cast("string"), F.lit("/"), F.date_format("end", "yyyy-MM-dd"), F.lit(".json"))
    return rows.select("series_code", day(F.col("end") - F.expr(f"INTERVAL {WINDOW_DAYS} DAYS")).alias("date_from"), day(F.col("end")).alias("date_to"), file.alias("file"))


def unzip(spark: SparkSession, archive: str, to: str, suffix: str = ".csv") -> list[str]:
    """The CSV members of a ZIP file, by their bare names, below a folder; overwrites. Both may lie in any store; bytes go
    from stream to stream in the driver's JVM, one member at a time."""
    jvm, (fs, source), out = spark.sparkContext._jvm, _fs(spark, archive), []
    members = jvm.java.util.zip.ZipInputStream(fs.open(source))
    try:
        while (entry := members.getNextEntry()) is not None:
            name = PurePosixPath(entry.getName()).name
            if name.lower().endswith(suffix):
                target, path = _fs(spark, f"{to.rstrip('/')}/{name}")
                sink = target.create(path, True)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(members, sink, 1 << 16, False)
                sink.close()
                out.append(path.toString())
    finally:
        members.close()
    return out


def land_files(spark: SparkSession, source: str, to: str, pattern: str = "*.csv") -> list[str]:
    """Copies the files below a folder that fit a pattern into another, by their bare names; overwrites. Both may lie in any store."""
    out = []
    for path in files_below(spark, source, pattern):
        fs, here = _fs(spark, path)
        target_fs, there = _fs(spark, f"{to.rstrip('/')}/{here.getName()}")
        spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, here, target_fs, there, False, True, spark.sparkContext._jsc.hadoopConfiguration())
        out.append(there.toString())
    return sorted(out)


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, modified, length) of all files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def unseen(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that are new, or were written again, since the ledger of (path, modified) was kept."""
    return found.join(ledger.select("path", "modified"), ["path", "modified"], "left_anti")


def _rescued(columns: list[str]):
    """The unexpected fields as JSON; null if all are null."""
    if not columns:
        return F.lit(None).cast("string")
    field = lambda c: F.col(f"`{c}`")
    return F.when(F.coalesce(*map(field, columns)).isNotNull(), F.to_json(F.struct(*(field(c).alias(c) for c in columns))))


def _lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_source_modified_at": F.col("_metadata.file_modification_time")})


def headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each header. Just the beginning of each file is read, by several threads of the driver; callers
    give so many files at once as the driver may hold names of."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(at: str) -> str:
        fs, path = _fs(spark, at)
        stream, codec = fs.open(path), codecs.getCodec(path)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            return (reader.readLine() or "").lstrip("\ufeff")
        finally:
            stream.close()

    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(THREADS) as pool:
        for path, line in zip(paths, pool.map(first_line, paths), strict=True):
            if line:  # an empty file has no rows
                found.setdefault(line, []).append(path)
    return found


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """CSV files with headers, by column name: files with the same header are read together, all as text; a missing
    column is null, and what the schema lacks goes to _rescued_data."""
    groups = headers(spark, paths).items()
    out = None
    for header, own in groups:
        names = next(csv.reader([header]))
        unique = [n if names.index(n) == i else f"{n}_{i}" for i, n in enumerate(names)]
        flat = T.StructType([T.StructField(n, T.StringType()) for n in unique])
        rows = _lineage(spark.read.schema(flat).option("header", "true").option("enforceSchema", "true").csv(own))
        extra = [n for n in unique if n not in schema.names]
        columns = [(F.col(f"`{n}`") if n in unique else F.lit(None).cast("string")).alias(n) for n in schema.names]
        rows = rows.select(*columns, _rescued(extra).alias("_rescued_data"), "_source_file", "_source_modified_at")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        empty = T.StructType([*schema.fields, T.StructField("_rescued_data", T.StringType()), T.StructField("_source_file", T.StringType()), T.StructField("_source_modified_at", T.TimestampType())])
        return spark.createDataFrame([], empty)
    return out


def read_json(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files of one JSON array each: its objects as rows of text, with further keys in _rescued_data."""
    files = _lineage(spark.read.text(paths, wholetext=True))
    rows = files.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("m"), "_source_file", "_source_modified_at")
    known = F.array(*map(F.lit, schema.names))
    extra = F.map_filter("m", lambda k, v: ~F.array_contains(known, k) & v.isNotNull())
    return rows.select(*(F.try_element_at("m", F.lit(n)).alias(n) for n in schema.names), F.when(F.size(extra) > 0, F.to_json(extra)).alias("_rescued_data"), "_source_file", "_source_modified_at")


def files_below(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    return [r["path"] for r in listing(spark, folder, pattern).select("path").collect()]


def round_trip(spark: SparkSession, bars: DataFrame, kind: str) -> DataFrame:
    """Bars landed as files below the shared folder in several layouts, and read back by name: for CSV one with the
    contract's columns, and one with another order and a further column; for JSON one array for each symbol and year.
    All bars and all columns of the contract are landed in either kind."""
    at = scratch(spark, "landing")
    text = bars.withColumns({c: F.col(c).cast("string") for c in ("Date", "Open", "High", "Low", "Close", "Volume")}).withColumn("OpenInt", F.lit("0"))
    if kind == "json":
        arrays = text.groupBy("Symbol", F.substring("Date", 1, 4).alias("year")).agg(F.to_json(F.collect_list(F.struct(*RAW_BARS.names))).alias("value"))
        arrays.select("value", "Symbol", "year").write.partitionBy("Symbol", "year").text(at)
        return read_json(spark, files_below(spark, at, "*.txt"), RAW_BARS)
    odd = F.col("Volume").cast("long") % 2 == 1
    text.where(~odd).select(*RAW_BARS.names).write.option("header", "true").csv(f"{at}/plain")
    text.where(odd).select("Symbol", F.col("Volume").alias("Dividend"), *(n for n in reversed(RAW_BARS.names) if n != "Symbol")).write.option("header", "true").csv(f"{at}/other")
    return read_csv(spark, files_below(spark, at, "*.csv"), RAW_BARS)
