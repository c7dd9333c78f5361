"""Benchmark decontamination by an FM-index of each training shard.

Words are maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case. A window is ten
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. A shard is a few MB of
whole documents: its runs of benchmark words that are long enough to hold a window are indexed, all windows are
searched backwards at once, their places located, and the words they cover merged into spans.

A benchmark of any size is compiled once, in blocks of BLOCK_BYTES that tasks read one at a time; nothing is broadcast.
With more than one block a task holds GROUP shards and goes through the blocks once for all of them.

Defined cases: null and empty texts and items have no words; repeated items are one item with the same id; items with
a null id count as windows but aren't listed; repeated documents are judged alike; a text of any length is one document
of one shard; an empty benchmark hits nothing; an empty table gives an empty result; other columns pass through,
whatever their names; only those named like a new column are refused with a ValueError.
"""

from __future__ import annotations

import hashlib
import io
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwater.llm import common
from brightwater.llm.fm_index import FmIndex

WINDOW = 10
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 8 << 20
#: Shards that a task holds while it goes through a benchmark of several blocks.
GROUP = 16
_LOWER = common.lowered()
_CODE = common.BYTE_CODE[_LOWER]
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def compiled(items: list, texts: pa.Array, window: int) -> bytes:
    """The windows of some items, as Phrases reads them."""
    body, at = common.utf8(texts)
    _, _, hashes, first = common.words_of(body, at, _WORD, _CODE)
    words = np.unique(hashes)
    number = np.searchsorted(words, hashes) + 2
    lengths = np.diff(first)
    names = sorted({str(x) for x in items if x is not None})
    place = {x: i for i, x in enumerate(names)}
    owner = np.array([-1 if x is None else place[str(x)] for x in items], np.int64)
    found: dict[int, list] = {}
    for i in np.flatnonzero(lengths):
        own = number[first[i] : first[i + 1]]
        width = min(window, len(own))
        rows = np.lib.stride_tricks.sliding_window_view(own, width)
        found.setdefault(width, []).append((rows, np.full(len(rows), owner[i])))
    out = {"words": words, "least": np.array([min((min(n, window) for n in lengths if n), default=0)]), "names": np.frombuffer("\0".join(names).encode(), np.uint8)}
    for width, (rows, owners) in ((w, map(np.concatenate, zip(*x, strict=True))) for w, x in found.items()):
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), owners], axis=1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        out |= {f"rows{width}": distinct.astype(np.int32), f"offsets{width}": np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), f"owners{width}": pairs[:, 1].astype(np.int32)}
    packed = io.BytesIO()
    np.savez(packed, **out)
    return packed.getvalue()


class Phrases:
    """The windows of a block of items: words by number from 2, the distinct windows by length, and their items."""

    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as arrays:
            self.words, self.least = arrays["words"], int(arrays["least"][0])
            self.names = arrays["names"].tobytes().decode().split("\0")
            widths = sorted(int(n[4:]) for n in arrays.files if n.startswith("rows"))
            #: For each length: the windows, and (as offsets and a list) the items of each.
            self.windows = [(arrays[f"rows{w}"].astype(np.int64), arrays[f"offsets{w}"], arrays[f"owners{w}"]) for w in widths]


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range that each is of."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which], which


def search_shard(hashes: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """For a shard's words: whether each is hit; and the pairs (document, item) that share a window."""
    n, hit, pairs = len(hashes), np.zeros(len(hashes), bool), [np.empty((0, 2), np.int64)]
    if not n or not len(phrases.words):
        return hit, pairs[0]
    place = np.minimum(np.searchsorted(phrases.words, hashes), len(phrases.words) - 1)
    known = phrases.words[place] == hashes
    begins = np.zeros(n + 1, bool)
    begins[first[first < n]] = True
    # Runs of known words within a document.
    start = np.flatnonzero(known & (begins[:n] | ~np.concatenate([[False], known[:-1]])))
    end = np.flatnonzero(known & (np.concatenate([begins[1:n], [True]]) | ~np.concatenate([known[1:], [False]]))) + 1
    long = end - start >= phrases.least
    start, end = start[long], end[long]
    if not len(start):
        return hit, pairs[0]
    words, run = _spread(start, end)
    slot = np.arange(len(words)) + run  # one separator (symbol 1) between runs
    text, origin = np.ones(len(words) + len(start), np.int64), np.full(len(words) + len(start), -1)
    text[slot], origin[slot] = place[words] + 2, words
    index = FmIndex(text)
    cover = np.zeros(n + 1, np.int64)
    doc = np.searchsorted(first, np.arange(n), "right") - 1
    for rows, offsets, owners in phrases.windows:
        low, high = index.search(rows)
        rank, which = _spread(low, high)
        if not len(rank):
            continue
        at = origin[index.locate(rank)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + rows.shape[1], -1)
        seen = np.unique(np.stack([doc[at], which], axis=1), axis=0)
        item, of = _spread(offsets[seen[:, 1]], offsets[seen[:, 1] + 1])
        pairs.append(np.stack([seen[of, 0], owners[item]], axis=1))
    return np.cumsum(cover)[:n] > 0, np.unique(np.concatenate(pairs), axis=0)


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> list[str]:
    """The benchmark's windows, compiled once, as Parquet files of about BLOCK_BYTES of items each in the shared folder; their paths."""
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    total = rows.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))))).first()[0] or 0

    def compile_(batches):
        common.owner("decontaminate")
        block = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if block is not None and block.num_rows:
            data = compiled(block.column("item").to_pylist(), block.column("text").combine_chunks(), window)
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.large_binary()).cast(pa.binary())], ["phrases"])

    blocks = rows.repartition(max(1, -(-total // BLOCK_BYTES))).mapInArrow(compile_, "phrases binary")
    return sorted(common.cut(blocks, "benchmark").inputFiles())


_phrases: dict[str, list[Phrases]] = {}
common.TABLES["decontaminate"] = _phrases.clear


def _load(file: str) -> list[Phrases]:
    """A file's blocks; those of the file that was read last are kept."""
    if file not in _phrases:
        _phrases.clear()
        fs, path = pa.fs.FileSystem.from_uri(file)
        with fs.open_input_file(path) as source:
            _phrases[file] = [Phrases(x) for x in pq.read_table(source).column("phrases").to_pylist()]
    return _phrases[file]


class _Shard:
    """Some documents, their words, and what was found in them so far."""

    def __init__(self, rows: pa.RecordBatch, number: int):
        self.rows, self.texts = rows, rows.column(number)
        self.body, self.at = common.utf8(self.texts)
        self.w_first, self.w_last, self.hashes, self.first = common.words_of(self.body, self.at, _WORD, _CODE)
        self.hit, self.listed = np.zeros(len(self.hashes), bool), [set() for _ in range(rows.num_rows)]

    def search(self, phrases: Phrases) -> None:
        own, pairs = search_shard(self.hashes, self.first, phrases)
        self.hit |= own
        for d, i in pairs.tolist():
            self.listed[d].add(phrases.names[i])

    def result(self, clean: bool) -> list[pa.Array]:
        hit, first, at = self.hit, self.first, self.at
        sums = np.concatenate([[0], np.cumsum(hit)])
        begins = np.zeros(len(hit) + 1, bool)
        begins[first[first < len(hit)]] = True
        starts = np.flatnonzero(hit & (begins[:-1] | ~np.concatenate([[False], hit[:-1]]))) if len(hit) else np.empty(0, np.int64)
        ends = np.flatnonzero(hit & (np.concatenate([begins[1:-1], [True]]) | ~np.concatenate([hit[1:], [False]]))) if len(hit) else np.empty(0, np.int64)
        per_doc = np.searchsorted(starts, first)
        byte_start, byte_end = self.w_first[starts], self.w_last[ends]
        spans, cleaned, data = [], [], self.body.tobytes() if clean else b""
        for d in range(self.rows.num_rows):
            own = [(int(a - at[d]), int(b - at[d])) for a, b in zip(byte_start[per_doc[d] : per_doc[d + 1]], byte_end[per_doc[d] : per_doc[d + 1]], strict=True)]
            spans.append([{"start": a, "end": b} for a, b in own])
            if clean:
                whole, parts, last = data[at[d] : at[d + 1]], [], 0
                for a, b in own:
                    parts.append(whole[last:a])
                    last = b
                cleaned.append(b"".join([*parts, whole[last:]]).decode() if self.texts[d].is_valid else None)
        new = [pa.array(np.diff(first), pa.int64()), pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64()), pa.array([len(x) for x in self.listed], pa.int64())]
        new.append(pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in self.listed]))
        new.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
        return [*new, *([pa.array(cleaned, pa.string())] * clean)]


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, clean: bool = True) -> DataFrame:
    """docs with __n_words, __n_hit, __n_items, __items_sha256, __spans (bytes [start, end) to remove) and, if asked for, __clean: the text without them."""
    common.prepare(docs.sparkSession)
    files = benchmark_blocks(benchmark, window=window)
    common.refuse(docs, *(f"__{n}" for n in ("n_words", "n_hit", "n_items", "items_sha256", "spans", "clean")))
    # With several files, each is read once for so many shards.
    group = 1 if len(files) < 2 else GROUP
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    extra = [("__n_words", T.LongType()), ("__n_hit", T.LongType()), ("__n_items", T.LongType()), ("__items_sha256", T.StringType()), ("__spans", span)] + [("__clean", T.StringType())] * clean
    names = [*docs.columns, *(k for k, _ in extra)]
    number = docs.columns.index(text)

    def find(batches):
        common.owner("decontaminate")
        # Columns go by place: their names may be anything, even twice the same.
        numbered = (pa.RecordBatch.from_arrays(b.columns, [f"c{i}" for i in range(b.num_columns)]) for b in batches)
        shards = (_Shard(rows, number) for rows in common.gathered(numbered, f"c{number}", SHARD_BYTES))
        while some := list(itertools.islice(shards, group)):
            for file in files:
                for phrases in _load(file):
                    for shard in some:
                        shard.search(phrases)
            for shard in some:
                yield pa.RecordBatch.from_arrays([*shard.rows.columns, *shard.result(clean)], names)

    schema = T.StructType([*docs.schema.fields, *(T.StructField(k, t) for k, t in extra)])
    return docs.mapInArrow(find, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: its words, those hit, the items that hit it, and whether any did."""
    common.prepare(spark)
    out = annotate(common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "benchmark"), clean=False)
    return out.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"), F.col("__n_items").alias("n_items"), F.col("__items_sha256").alias("items_sha256"), (F.col("__n_hit") > 0).alias("contaminated"))
