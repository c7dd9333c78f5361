"""Versioned tables of plain Parquet: snapshots by manifest, merges that rewrite only touched buckets, feeds from the log.

A table is a folder. ``_log/<version>.json`` names the data folders of each bucket, and those that the version added or
that hold its changes. A manifest is written under a hidden name and then renamed to its version, which fails if another
writer was first; so it is there in full or not at all, and what a failed writer left is never read. Rows lie in buckets
by the hash of a spec's columns: a merge reads and rewrites the buckets that its source touches and no others. The
number of buckets is the spec's to begin with and can be changed by a compaction.

Consumers follow the log: a stream of manifests is what tells them which folders were committed. Compaction adds and
changes nothing, so it feeds nothing. All files go through Hadoop's file system, so a table can lie wherever Spark reads.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwater import schema
from brightwater.operators import merge

BUCKET = "__bucket"
MANIFEST = re.compile(r"\d{8}\.json")


class CommitConflict(RuntimeError):
    """Another writer made this version first."""


@dataclass(frozen=True)
class TableSpec:
    """A table's logical name, its place below the root, its contract, and how it is laid out."""

    name: str
    path: str
    contract: T.StructType
    bucket_by: tuple[str, ...] = ()
    buckets: int = 16
    cluster_by: tuple[str, ...] = ()
    change_feed: bool = False

    def location(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.path}"


def observed(seen: Observation) -> dict[str, int]:
    """What was counted while writing; nothing if the optimizer saw that there are no rows and left the counting out."""
    try:
        return dict(seen.get)
    except Py4JJavaError:  # the observation holds an empty row, for which Spark has no Python form
        return {}


class Staged:
    """Rows that were written for a while, and their number."""

    def __init__(self, rows: DataFrame, count: int, drop):
        self.rows, self.count, self._drop = rows, count, drop

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *_) -> None:
        self._drop()


class VersionedTable:
    """A table of a spec below a root folder."""

    def __init__(self, spark: SparkSession, spec: TableSpec, root: str):
        self.spark, self.spec, self.at = spark, spec, spec.location(root)
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Files.

    def _path(self, at: str):
        return self._jvm.org.apache.hadoop.fs.Path(at)

    def _names(self, at: str) -> list[str]:
        path = self._path(at)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _read(self, at: str) -> dict:
        stream = self._fs.open(self._path(at))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        name = f"{manifest['version']:08d}.json"
        hidden, path = (self._path(f"{self.at}/_log/{n}") for n in (f".{uuid.uuid4().hex}.tmp", name))
        stream = self._fs.create(hidden, False)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        keep = self.spark.sparkContext._gateway.new_array(kinds, 1)
        keep[0] = kinds.NONE  # never over a file that is there
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(hidden), self._fs.makeQualified(path), keep)
        except Exception as e:
            self._fs.delete(hidden, False)
            raise CommitConflict(f"{self.spec.name}: version {manifest['version']} exists") from e

    # Versions.

    def versions(self) -> list[int]:
        return [int(n[:8]) for n in self._names(f"{self.at}/_log") if MANIFEST.fullmatch(n)]

    def manifest(self, version: int | None = None) -> dict:
        found = self.versions()
        if not found:
            raise LookupError(f"{self.spec.name} doesn't exist; call ensure()")
        return self._read(f"{self.at}/_log/{found[-1] if version is None else version:08d}.json")

    def ensure(self) -> VersionedTable:
        """Makes the table if it is missing; raises ContractError if it has another contract."""
        if not self.versions():
            self._commit({"version": 0, "contract": self.spec.contract.jsonValue(), "buckets": self.spec.buckets, "data": {}, "added": [], "changes": []})
        schema.require(T.StructType.fromJson(self.manifest()["contract"]), self.spec.contract, self.spec.name)
        return self

    def read(self, version: int | None = None) -> DataFrame:
        """The current rows, or those of an older version."""
        return self._frame(sum(self.manifest(version)["data"].values(), []))

    def read_matching(self, values: DataFrame) -> DataFrame:
        """The current rows whose columns have one of the combinations in ``values``; of a table that has its buckets by
        just these columns only those buckets are read."""
        now = self.manifest()
        buckets = self._touched(values, now) if self.spec.bucket_by == tuple(values.columns) else list(now["data"])
        rows = self._frame(self._paths(now, buckets)).alias("t")
        return rows.join(values.distinct().alias("v"), merge.same_key("t", "v", values.columns), "left_semi")

    @staticmethod
    def _paths(manifest: dict, buckets: list[str]) -> list[str]:
        return [p for b in buckets for p in manifest["data"].get(b, [])]

    def _frame(self, paths: list[str]) -> DataFrame:
        # NOT NULL is checked when rows are written; readers take all columns as they are.
        loose = T.StructType([T.StructField(f.name, f.dataType) for f in self.spec.contract.fields])
        return self.spark.read.schema(loose).parquet(*paths) if paths else self.spark.createDataFrame([], loose)

    def _write(self, df: DataFrame, buckets: int) -> tuple[dict[str, list[str]], int]:
        """Rows as new data folders by bucket, and their number; raises ContractError, before anything is committed, if a required value is null."""
        df = schema.conform(df, self.spec.contract, self.spec.name)
        seen = Observation()
        df = df.observe(seen, F.count("*").alias("__rows"), *schema.required_nulls(self.spec.contract))
        at = f"{self.at}/data/{uuid.uuid4().hex}"
        if self.spec.bucket_by:
            # A rebalance lets a large bucket be written by several tasks.
            rows = df.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET)
            if self.spec.cluster_by:
                rows = rows.sortWithinPartitions(BUCKET, *self.spec.cluster_by)
            rows.write.partitionBy(BUCKET).parquet(at)
        else:
            df.write.parquet(at)
        found = observed(seen)
        n = found.pop("__rows", 0)
        if nulls := {k: v for k, v in found.items() if v}:
            self._fs.delete(self._path(at), True)
            raise schema.ContractError(f"{self.spec.name}: nulls in required columns: {nulls}")
        if not n:
            self._fs.delete(self._path(at), True)
            return {}, 0
        if not self.spec.bucket_by:
            return {"": [at]}, n
        return {name.split("=")[1]: [f"{at}/{name}"] for name in self._names(at) if name.startswith(f"{BUCKET}=")}, n

    def _bucket(self, buckets: int):
        return F.pmod(F.hash(*self.spec.bucket_by), F.lit(buckets))

    def _touched(self, source: DataFrame, manifest: dict) -> list[str]:
        """Buckets of the source's rows; a table's number of buckets at most."""
        if not self.spec.bucket_by:
            return list(manifest["data"])
        return sorted(str(r[0]) for r in source.select(self._bucket(manifest["buckets"])).distinct().collect())

    def _by_key(self, keys: list[str]) -> None:
        if not set(self.spec.bucket_by) <= set(keys):
            raise ValueError(f"{self.spec.name} has buckets by {self.spec.bucket_by}, which isn't part of the key {keys}")

    def _next(self, old: dict, data: dict, added: dict | None = None, changes: list[str] | None = None, buckets: int | None = None) -> None:
        feed = {"added": sum((added or {}).values(), []), "changes": changes or []}
        self._commit({"version": old["version"] + 1, "contract": old["contract"], "buckets": buckets or old["buckets"], "data": data, **feed})

    def staged(self, df: DataFrame) -> Staged:
        """df written below the table for the time of a with block: what several writes need is computed once."""
        at, seen = f"{self.at}/staging/{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count("*").alias("n")).write.parquet(at)
        return Staged(self.spark.read.schema(df.schema).parquet(at), observed(seen).get("n", 0), lambda: self._fs.delete(self._path(at), True))

    # Feeds.

    def change_schema(self) -> T.StructType:
        return T.StructType([*(T.StructField(f.name, f.dataType) for f in self.spec.contract.fields), T.StructField("_change_type", T.StringType())])

    def feed(self, kind: str, versions_at_once: int = 1000) -> DataFrame:
        """The log as a stream of (version, path): the folders that versions have ``added`` (inserted rows) or that hold
        their ``changes``. ``rows_of`` reads those of a micro-batch."""
        line = T.StructType([T.StructField("version", T.LongType()), T.StructField(kind, T.ArrayType(T.StringType()))])
        log = self.spark.readStream.schema(line).option("maxFilesPerTrigger", versions_at_once).option("pathGlobFilter", "*.json").json(f"{self.at}/_log")
        return log.select("version", F.explode(kind).alias("path"))

    def rows_of(self, feed: DataFrame, kind: str) -> DataFrame:
        """The rows in a micro-batch of the feed; only names of folders come to the driver, ``versions_at_once`` commits' at most."""
        return self._rows(kind, [r["path"] for r in feed.select("path").collect()])

    def read_feed(self, kind: str, since: int = -1) -> DataFrame:
        """The rows of a feed's versions after ``since``."""
        return self._rows(kind, [p for v in self.versions() if v > since for p in self.manifest(v)[kind]])

    def _rows(self, kind: str, paths: list[str]) -> DataFrame:
        if kind == "added":
            return self._frame(paths)
        return self.spark.read.schema(self.change_schema()).parquet(*paths) if paths else self.spark.createDataFrame([], self.change_schema())

    # Writes.

    def insert_new(self, source: DataFrame, keys: list[str]) -> int:
        """Appends the rows whose key the table lacks and returns their number; those that are there stay as they are.
        Nothing new, no version."""
        self._by_key(keys)
        source = schema.conform(source, self.spec.contract, self.spec.name)
        old = self.manifest()
        # Of the target just the keys in touched buckets are read.
        fresh = merge.insert_new(self._frame(self._paths(old, self._touched(source, old))), source, keys)
        added, n = self._write(fresh, old["buckets"])
        if n:
            self._next(old, {b: old["data"].get(b, []) + added.get(b, []) for b in {*old["data"], *added}}, added)
        return n

    def upsert_latest(self, source: DataFrame, keys: list[str], order: list[str]) -> None:
        """Inserts new keys and replaces older versions; the source has one row for each key. Nothing new, no version."""
        self._by_key(keys)
        source = schema.conform(source, self.spec.contract, self.spec.name)
        old = self.manifest()
        buckets = self._touched(source, old) if self.spec.bucket_by else [""]
        staged = f"{self.at}/staging/{uuid.uuid4().hex}"
        # The target is an input, so the merge is written before anything that follows from it.
        merge.upsert_latest(self._frame(self._paths(old, buckets)), source, keys, order).write.parquet(staged)
        merged = self.spark.read.parquet(staged)
        if merged.where("_action <> 'keep'").limit(1).count():
            data, _ = self._write(merged.drop("_action", "_before"), old["buckets"])
            changes = []
            if self.spec.change_feed:
                changes = [f"{self.at}/changes/{uuid.uuid4().hex}"]
                merge.changes(merged).write.parquet(changes[0])
            self._next(old, {b: p for b, p in old["data"].items() if b not in buckets} | data, changes=changes)
        self._fs.delete(self._path(staged), True)

    def replace_slice(self, source: DataFrame, keys: list[str], slices: DataFrame) -> None:
        """Rows of the slices (values of the one column of ``slices``) become those of the source, as one version.

        Source rows of other slices are upserted by their key, so no other row is lost.
        """
        self._by_key(keys)
        source = schema.conform(source, self.spec.contract, self.spec.name)
        old = self.manifest()
        if self.spec.bucket_by == tuple(slices.columns):
            buckets = sorted({*self._touched(slices, old), *self._touched(source, old)})
        else:  # a slice's rows may lie in any bucket
            buckets = list(old["data"])
        data, _ = self._write(merge.replace_slice(self._frame(self._paths(old, buckets)), source, keys, slices), old["buckets"])
        self._next(old, {b: p for b, p in old["data"].items() if b not in buckets} | data)

    def compact(self, buckets: int | None = None) -> None:
        """The same rows in fewer files, in the spec's clustering and, if asked for, another number of buckets; feeds get nothing."""
        old = self.manifest()
        rows = self._frame(sum(old["data"].values(), []))
        if not self.spec.bucket_by and self.spec.cluster_by:
            rows = rows.repartitionByRange(*self.spec.cluster_by).sortWithinPartitions(*self.spec.cluster_by)
        self._next(old, self._write(rows, buckets or old["buckets"])[0], buckets=buckets)

    def vacuum(self, keep: int = 10) -> int:
        """Deletes data folders that none of the last ``keep`` versions names, as data or for its feeds; returns their number.
        A consumer that is further behind than that has to start anew."""
        manifests = [self.manifest(v) for v in self.versions()[-keep:]]
        paths = {p for m in manifests for p in [*sum(m["data"].values(), []), *m["added"], *m["changes"]]}
        named = {p.removeprefix(self.at).split("/")[2] for p in paths}
        gone = [f"{self.at}/{kind}/{n}" for kind in ("data", "changes", "staging") for n in self._names(f"{self.at}/{kind}") if n not in named]
        for at in gone:
            self._fs.delete(self._path(at), True)
        return len(gone)
