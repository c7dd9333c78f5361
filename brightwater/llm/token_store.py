"""Token files: ids in document order, entropy-coded by a static range asymmetric numeral system.

All files share one table of frequencies, counted over the whole corpus and scaled to 2**bits. A file holds blocks of
BLOCK ids; a block is independent of all others and interleaves LANES coders, so a decoder steps through all blocks and
lanes of a file at once. The directory is the checkpoint of parallel decoding: for each block its place, number of ids,
and the checksums of its words and of its ids; the coders' states stand at the block's head.

Documents are ordered by range partitioning and a sort within each partition. A file's place in the whole sequence
follows from the sums of ids of each partition, one number a partition, and from what its own partition wrote before.

Defined cases: a null or empty text is just the end id; rows with equal ids (null first) follow each other in the order
of their tokens' checksum; an id that the table lacks and a damaged file raise TokenFileError; an empty table gives no
file and an empty result; columns besides id and text are left out, so their names can't clash.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

MAGIC = b"BWRANS1\n"
BLOCK, LANES = 1 << 16, 512
#: A file takes whole documents until it has this many ids; a partition has PART_IDS on average.
FILE_IDS, PART_IDS, MAX_PARTS = 1 << 21, 4 << 20, 20_000
LOW = np.uint64(1 << 31)
#: Words, and parts of words, that a worker keeps at most (then it starts over); and how many are encoded in one string.
CACHE, TOGETHER = 700_000, 500
END_ID = 2


class TokenFileError(ValueError):
    """A token file that is damaged, or ids that its table lacks."""


class WordEncoder:
    """The tokenizers library over texts whose words are mostly known.

    It normalises to composed lower case, and its pieces end at blanks, at single digits, and where letters end. So a
    word's letters and the rest are kept apart, letters that aren't known are encoded together with a digit between,
    and texts of plain Latin letters come in lower case at once.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE).search if special else lambda _: None
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        #: Beyond these characters lower case or composition may depend on what stands around.
        self.other = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u012f\u0131-\u017f]").search
        self.blanks = re.compile(r"[\t-\r ]+").split
        self.letters = regex.compile(r"(\p{L}+)(.*)", regex.DOTALL).fullmatch
        zero = self._ids("0")
        self.zero = int(zero[0]) if len(zero) == 1 else None
        #: Words, and letters and rests of words, with their ids.
        self.kept: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width)

    def _many(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.width) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fill(self, words: set[str]) -> None:
        """Encodes the words, none of which is kept."""
        kept = self.kept
        together, apart, cut = set(), set(), []
        for w in words:
            # The normaliser must leave what is encoded together as it is, whatever comes next.
            if self.zero is None or self.other(w) and not (w == w.lower() and unicodedata.is_normalized("NFC", w)):
                apart.add(w)
            elif w.isalpha():
                together.add(w)
            elif (found := self.letters(w)) and found[2][:1].isascii():
                head, rest = found[1], found[2]
                cut.append((w, head, rest))
                if head not in kept:
                    together.add(head)
                if rest not in kept:
                    apart.add(rest)
            else:
                apart.add(w)
        alone = list(apart)
        for w, ids in zip(alone, self._many(alone), strict=True):
            kept[w] = ids.tobytes()
        new = list(together)
        parts = [new[i : i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        for part, ids in zip(parts, self._many([" 0 ".join(part) for part in parts]), strict=True):
            ends = np.flatnonzero(ids == self.zero) * ids.itemsize
            data, first = ids.tobytes(), 0
            for w, end in zip(part, [*ends.tolist(), len(data)], strict=True):
                kept[w] = data[first:end]
                first = end + ids.itemsize
        for w, head, rest in cut:
            kept[w] = kept[head] + kept[rest]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, one after the other in self.width."""
        out: list[bytes | None] = [self._ids(t).tobytes() if self.special(t) else None for t in texts]
        words = [None if o is not None else self.blanks(t) if self.other(t) else t.lower().split() for t, o in zip(texts, out, strict=True)]
        missing = set().union(*(w for w in words if w is not None)).difference(self.kept)
        if missing:
            if len(self.kept) + len(missing) > CACHE:
                self.kept = {"": b""}
                missing = set().union(*(w for w in words if w is not None)) - {""}
            self._fill(missing)
        get = self.kept.__getitem__
        return [b"".join(map(get, w)) if o is None else o for w, o in zip(words, out, strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_encoders: dict[str, WordEncoder] = {}
common.TABLES["token_store"] = _encoders.clear


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Table:
    """Frequencies of ids, scaled to a power of two; every id that occurs has one at least."""

    def __init__(self, counts: np.ndarray):
        used = np.flatnonzero(counts)
        self.bits = int(max(14, np.ceil(np.log2(max(1, len(used)) * 4))))
        total = 1 << self.bits
        f = np.zeros(len(counts), np.int64)
        if len(used):
            f[used] = np.maximum(1, np.floor(counts[used] / counts.sum() * total)).astype(np.int64)
            order = used[np.argsort(-counts[used], kind="stable")]
            left = total - f.sum()
            if left > 0:
                f[order[0]] += left
            for i in order:  # the most frequent give what is too much
                if left >= 0:
                    break
                give = min(f[i] - 1, -left, max(1, f[i] // 2))
                f[i] -= give
                left += give
            if left:
                raise TokenFileError("the frequencies don't fit the table")
        self.freq = f.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(f)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(f), dtype=np.uint32), f)
        self.stamp = zlib.crc32(f.astype("<u4").tobytes())


def _shaped(n: int) -> tuple[int, int]:
    return -(-n // BLOCK), BLOCK // LANES


def encode_blocks(ids: np.ndarray, table: Table) -> list[bytes]:
    """One byte string for each block of ids: the coders' states, then their words in the order of decoding."""
    n = len(ids)
    if not n:
        return []
    if ids.max() >= len(table.freq) or not table.freq[ids].all():
        raise TokenFileError("an id that the table lacks")
    count, steps = _shaped(n)
    grid = np.zeros(count * BLOCK, np.int64)
    grid[:n] = ids
    grid = grid.reshape(count, steps, LANES).transpose(1, 0, 2).reshape(steps, -1)
    valid = (np.arange(count * BLOCK) < n).reshape(count, steps, LANES).transpose(1, 0, 2).reshape(steps, -1)
    state = np.full(count * LANES, LOW, np.uint64)
    words, sent = np.zeros((steps, count * LANES), np.uint32), np.zeros((steps, count * LANES), bool)
    bits, room = np.uint64(table.bits), np.uint64(31 - table.bits + 32)
    for t in range(steps - 1, -1, -1):
        f, live = table.freq[grid[t]], valid[t]
        full = live & (state >> room >= f)
        words[t], sent[t] = state.astype(np.uint32), full
        x = np.where(full, state >> np.uint64(32), state)
        f = np.where(live, f, np.uint64(1))
        high = x // f
        state = np.where(live, (high << bits) + (x - high * f) + table.start[grid[t]], x)
    states, words, sent = state.reshape(count, LANES), words.reshape(steps, count, LANES), sent.reshape(steps, count, LANES)
    return [states[i].astype("<u8").tobytes() + words[:, i][sent[:, i]].astype("<u4").tobytes() for i in range(count)]


def decode_blocks(blocks: list[bytes], sizes: list[int], table: Table) -> np.ndarray:
    """The ids of blocks of ``sizes`` ids."""
    count, steps = len(blocks), BLOCK // LANES
    if not count:
        return np.empty(0, np.uint32)
    state = np.stack([np.frombuffer(b, "<u8", LANES) for b in blocks]).astype(np.uint64)
    stream = [np.frombuffer(b, "<u4", offset=8 * LANES) for b in blocks]
    first = np.concatenate([[0], np.cumsum([len(s) for s in stream])])[:-1]
    data = np.concatenate([*stream, np.zeros(1, "<u4")]).astype(np.uint64)
    at, limit = first.copy(), len(data) - 1
    out = np.empty((steps, count, LANES), np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for t in range(steps):
        live = (t * LANES + np.arange(LANES))[None, :] < np.array(sizes)[:, None]
        slot = state & mask
        ids = table.symbol[slot]
        x = table.freq[ids] * (state >> bits) + slot - table.start[ids]
        state = np.where(live, x, state)
        need = live & (state < LOW)
        place = at[:, None] + np.cumsum(need, axis=1) - 1
        state = np.where(need, state << np.uint64(32) | data[np.minimum(np.maximum(place, 0), limit)], state)
        at = at + need.sum(axis=1)
        out[t] = ids
    return np.concatenate([out[:, i].reshape(-1)[: sizes[i]] for i in range(count)])


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], table: Table) -> bytes:
    """A token file."""
    blocks = encode_blocks(ids, table)
    out, entries = io.BytesIO(), []
    out.write(MAGIC)
    for i, b in enumerate(blocks):
        own = ids[i * BLOCK : (i + 1) * BLOCK]
        entries.append((out.tell(), len(b), len(own), zlib.crc32(b), zlib.crc32(own.astype("<u4").tobytes())))
        out.write(b)
    number = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is None for x in doc_ids], bool).tobytes() + np.array(lengths, "<i8").tobytes()
    directory = b"".join(struct.pack("<QQIII", *e) for e in entries)
    tail = zlib.compress(directory + number, 1)
    foot = struct.pack("<QIIQI", len(tail), table.stamp, len(entries), len(doc_ids), zlib.crc32(tail))
    out.write(tail + foot + struct.pack("<I", zlib.crc32(foot)) + MAGIC)
    return out.getvalue()


def unpack(data: bytes, table: Table) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """The ids of a token file, and its documents' ids and lengths; raises TokenFileError if a checksum doesn't fit."""
    foot = struct.calcsize("<QIIQI") + 4
    if len(data) < foot + 16 or data[:8] != MAGIC or data[-8:] != MAGIC:
        raise TokenFileError("no token file")
    *fields, own = struct.unpack("<QIIQII", data[-8 - foot : -8])
    if zlib.crc32(data[-8 - foot : -12]) != own:
        raise TokenFileError("a damaged footer")
    size, stamp, n_blocks, n_docs, check = fields
    tail = data[-8 - foot - size : -8 - foot]
    if stamp != table.stamp or zlib.crc32(tail) != check:
        raise TokenFileError("another table, or a damaged directory")
    tail = zlib.decompress(tail)
    width = struct.calcsize("<QQIII")
    entries = [struct.unpack_from("<QQIII", tail, width * i) for i in range(n_blocks)]
    blocks = [data[a : a + n] for a, n, *_ in entries]
    if any(zlib.crc32(b) != e[3] for b, e in zip(blocks, entries, strict=True)):
        raise TokenFileError("a damaged block")
    ids = decode_blocks(blocks, [e[2] for e in entries], table)
    for i, e in enumerate(entries):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) != e[4]:
            raise TokenFileError("a block that decodes to other ids")
    rest = tail[width * n_blocks :]
    number, null = np.frombuffer(rest, "<i8", n_docs), np.frombuffer(rest, bool, n_docs, 8 * n_docs)
    return ids, [None if z else int(x) for x, z in zip(number, null, strict=True)], np.frombuffer(rest, "<i8", n_docs, 9 * n_docs)


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, crc, ids): each text's ids with the end id, as a written table, so that texts are encoded once."""
    common.prepare(docs.sparkSession)

    def rows(batches):
        common.owner("token_store")
        own = word_encoder(path)
        end = np.array([end_id], own.width).tobytes()
        for part in common.sliced(batches, "text", 1 << 19):
            ids = [x + end for x in own.encode_all([x or "" for x in part.column("text").to_pylist()])]
            n = [len(x) // np.dtype(own.width).itemsize for x in ids]
            crc = [zlib.crc32(np.frombuffer(x, own.width).astype("<u4").tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.binary())], ["key", "n", "crc", "ids"])

    out = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(rows, "key long, n long, crc long, ids binary")
    return common.cut(out, "tokens")


def frequencies(tokens: DataFrame, size: int, width) -> Table:
    """The table of all ids: one row for each id of the vocabulary comes to the driver."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            body, _ = common.utf8(batch.column("ids"))
            total += np.bincount(body.view(width), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["id", "n"])

    found = tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[found["id"]] = found["n"]
    return Table(counts)


def write(tokens: DataFrame, folder: str, table: Table, width) -> DataFrame:
    """Writes token files in the order of keys; returns (file, part, before, n) of each, before: ids of the same part before it."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    parts = int(min(MAX_PARTS, max(1, total // PART_IDS)))
    ordered = tokens.repartitionByRange(parts, "key", "crc").sortWithinPartitions("key", "crc")

    def save(batches):
        fs, at = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(at, recursive=True)
        part, before = TaskContext.get().partitionId(), 0
        keys, lengths, ids, size = [], [], [], 0

        def close():
            nonlocal before, keys, lengths, ids, size
            name = f"{uuid.uuid4().hex}.rans"
            with fs.open_output_stream(f"{at}/{name}") as sink:
                sink.write(pack(np.concatenate(ids).astype(np.uint32), keys, lengths, table))
            row = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64())], ["file", "part", "before", "n"])
            before += size
            keys, lengths, ids, size = [], [], [], 0
            return row

        for batch in batches:
            body, offsets = common.utf8(batch.column("ids"))
            own = body.view(width)
            for i, (key, n) in enumerate(zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                a = int(offsets[i]) // own.itemsize
                keys.append(key)
                lengths.append(n)
                ids.append(own[a : a + n])
                size += n
                if size >= FILE_IDS:
                    yield close()
        if keys:
            yield close()

    return common.cut(ordered.mapInArrow(save, "file string, part int, before long, n long"), "token-files")


def read(files: DataFrame, table: Table, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document in the files."""
    common.prepare(files.sparkSession)
    ends, sums = 0, {}
    for part, n in sorted(files.groupBy("part").agg(F.sum("n")).collect()):  # MAX_PARTS rows at most
        sums[part] = ends
        ends += n
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def load(batches):
        for batch in batches:
            for name, part, before in zip(*(batch.column(c).to_pylist() for c in ("file", "part", "before")), strict=True):
                fs, path = pa.fs.FileSystem.from_uri(name)
                with fs.open_input_stream(path) as source:
                    found, keys, lengths = unpack(source.read(), table)
                at = np.concatenate([[0], np.cumsum(lengths)])
                own = [found[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in own]
                columns = [pa.array(keys, pa.int64()), pa.array(at[:-1] + sums[part] + before, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(own, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))] * ids, names)

    count = max(1, files.count())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    return files.repartition(min(count, 100_000)).mapInArrow(load, schema)


def store(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Table]:
    """Encodes and writes docs; returns the table of files and the frequencies."""
    own = word_encoder(path)
    tokens = tokenize(docs, path, end_id, key, text)
    table = frequencies(tokens, own.tokenizer.get_vocab_size(), own.width)
    return write(tokens, folder, table, own.width), table


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document, as read back from the files."""
    import public_tokenizers

    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    files, table = store(docs, public_tokenizers.path("word_bpe_49k.json"), common.scratch(spark, "rans"))
    return read(files, table)


def iterate(data: bytes, table: Table) -> Iterator[np.ndarray]:
    """The ids of each document of a token file."""
    ids, _, lengths = unpack(data, table)
    yield from np.split(ids, np.cumsum(lengths)[:-1])
