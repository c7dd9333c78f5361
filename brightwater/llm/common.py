"""Shared parts of the training-data operators: scratch tables, joins on hot keys, Arrow text buffers, hashing."""

from __future__ import annotations

import ctypes
import gc
import io
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch sent to Python (a longer row is a batch of its own); work inside goes by SLICE_BYTES.
BATCH_ROWS, BATCH_BYTES = 4000, 4 << 20
SLICE_BYTES = 4 << 20
#: Bytes whose words are hashed at once.
PIECE = 1 << 19
#: Used only where the session names no shared folder (tests, local runs).
LOCAL_DIR = "/tmp/brightwater-scratch"
#: At most this many keys count as hot, so the table of hot keys has a fixed size bound.
MAX_HOT = 500
#: Bytes of a hot key's row that may be broadcast.
HOT_BYTES = 1 << 16


def prepare(spark: SparkSession) -> SparkSession:
    """Bounded Arrow batches for the Python stages, and this package's code for the machines that run them.

    Spark reads the batches' bounds when a plan is run, which is after the operator returned it, so they stay set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_brightwater", None) is None:
        context._brightwater = _ship(spark)
    return spark


def _ship(spark: SparkSession) -> str:
    """Gives the executors the package as a ZIP file, so nothing has to be installed there; returns its place."""
    top, packed_ = Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(packed_, "w") as z:
        for file in sorted(top.rglob("*.py")):
            z.writestr(str(file.relative_to(top.parent)), file.read_bytes())
    at = f"{scratch(spark, 'code')}.zip"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(path)
    sink = fs.create(path)
    sink.write(packed_.getvalue())
    sink.close()
    spark.sparkContext.addPyFile(at)
    return at


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir; only a local master may do without it, and gets LOCAL_DIR."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        at = LOCAL_DIR
        spark.conf.set("spark.checkpoint.dir", at) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return at.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder under shared_dir, deleted when the session's JVM ends."""
    at = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return at


def cut(df: DataFrame, what: str, compression: str = "zstd") -> DataFrame:
    """df as a Parquet table in the shared folder: later jobs start from it, and a lost executor costs no recomputation."""
    at = scratch(df.sparkSession, what)
    df.write.option("compression", compression).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def join_keyed(rows: DataFrame, per_key: DataFrame, keys: list[str], count: str, how: str = "inner", weight: Column | None = None, grows: bool = False) -> DataFrame:
    """rows joined with per_key, which has one row for each key and the key's number of rows in column count.

    Keys that hold over 1/MAX_HOT of all rows (so MAX_HOT keys at most) are joined by broadcast where their rows
    lie; only the other keys are shuffled. Where rows of per_key hold lists, ``weight`` is their size in bytes: those over
    HOT_BYTES are shuffled in any case, so what is broadcast has MAX_HOT * HOT_BYTES at most. ``grows`` says that per_key
    grows with the corpus: then the rest is merged at any size, and what a small run moves tells what a large one does.
    Both inputs should be cheap to read twice.
    """
    least = max(100, rows.count() // MAX_HOT)
    is_light = F.lit(True) if weight is None else F.coalesce(weight <= HOT_BYTES, F.lit(True))
    chosen = F.coalesce((F.col(count) > least) & is_light, F.lit(False))
    hot, rest = per_key.where(chosen), per_key.where(~chosen)
    rest = rest.hint("merge") if grows else rest
    is_hot = F.broadcast(hot.select(*keys))
    cold = rows.join(is_hot, keys, "left_anti").join(rest, keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


def refuse(df: DataFrame, *names: str) -> None:
    """ValueError if df has columns named like those that an operator adds."""
    lowered_ = {c.lower() for c in df.columns}
    if found := [n for n in names if n.lower() in lowered_]:
        raise ValueError(f"columns that this operator adds are there already: {found}")


def packed(df: DataFrame) -> Column:
    """All columns of df as the struct __row."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row")


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array, one text after the other, and their n + 1 offsets; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return body, at - at[0]


def release() -> None:
    """Gives freed memory back: a worker stays for later stages, and what it keeps counts there too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


#: What empties the tables that an operator keeps in a worker, by the operator's name.
TABLES: dict[str, Callable[[], None]] = {}
_owner = [""]


def owner(name: str) -> None:
    """Says which operator works in this worker now; those of others give up their tables, as workers outlive stages."""
    if _owner[0] != name:
        _owner[0] = name
        for other, empty in TABLES.items():
            if other != name:
                empty()
        gc.collect()
        release()


def packed_bytes(array: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The data of a large binary array without nulls that begins at its buffers' beginning, and its offsets."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return memoryview(data if data is not None else b"")[: int(at[-1])], at


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array in slices of about ``most`` bytes; a longer text is a slice of its own."""
    _, at = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of the column; a longer text is a slice of its own."""
    for batch in batches:
        first = 0
        for part in slices(batch.column(column), most):
            yield batch.slice(first, len(part))
            first += len(part)
    release()


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in units of about ``most`` bytes of the column, small batches put together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in sliced(batches, column, most):
        n = int(utf8(part.column(column))[1][-1])
        if held and size + n > most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if part.num_rows:
            held.append(part)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held = []
    release()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_RANDOM = np.random.default_rng(20240229)
BYTE_CODE = _RANDOM.integers(1, 2**64, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2**64, n of them at least."""
    found = _powers.get(int(base))
    if found is None or len(found) < n:
        found = np.full(max(1 << 16, 1 << (n - 1).bit_length()), base, np.uint64)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if len(found) <= 2 * PIECE:
            _powers[int(base)] = found
    return found


def lowered() -> np.ndarray:
    """A table of all bytes with A-Z in lower case."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def words_of(body: np.ndarray, at: np.ndarray, is_word: np.ndarray, code: np.ndarray = BYTE_CODE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (maximal run of bytes with is_word) that lies in one text; its 64-bit hash; words before each text.

    code: for each byte, what is hashed (equal for letters that count as equal).
    """
    n = len(body)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    word = is_word[body]
    begin = np.empty(n, bool)
    begin[0] = True
    np.logical_not(word[:-1], out=begin[1:])
    edges = at[:-1][at[:-1] < n]
    begin[edges] = True
    begin &= word
    end = np.empty(n, bool)
    end[-1] = True
    np.logical_not(word[1:], out=end[:-1])
    end[edges[edges > 0] - 1] = True
    end &= word
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    hashes = np.empty(len(first), np.uint64)
    i = 0
    while i < len(first):  # by pieces, so that what is computed for each byte stays small
        j = max(i + 1, int(np.searchsorted(last, first[i] + PIECE, "right")))
        a, b = first[i:j] - first[i], last[i:j] - first[i]
        size = int(b[-1])
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(code[body[first[i] : last[j - 1]]] * powers(BASE, size)[:size], out=total[1:])
        hashes[i:j] = mix((total[b] - total[a]) * powers(UNBASE, size)[a] + (b - a).astype(np.uint64))
        i = j
    return first, last, hashes, np.searchsorted(first, at)

