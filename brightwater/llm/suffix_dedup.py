"""Exact substring dedup: bytes covered by a string of LENGTH bytes that starts anywhere else too are removed.

Equal texts are one content from the start. Every window of LENGTH bytes has an anchor: of its GRAM-byte strings the one
with the smallest hash, the leftmost of equal ones. That depends on the window's bytes alone, so equal windows have
equal anchors at equal offsets; windows whose anchor occurs once aren't repeated. What is left is the stretches of text
around repeated anchors, which meet by the anchor's hash. There a suffix array's buckets are refined as far as
LENGTH bytes: the first buckets are those of 8-byte strings, and each is sorted on the buckets of a later offset, whose
updates are used again, so that the depth doubles; buckets of one leave the work.

An anchor that very many contents share is split: its windows fall into SPLIT classes by their offset, all windows of a
class hold the same longer string around the anchor, and that string's hash takes the anchor's place. Where over CROWD
stretches still meet, as at the ends of a passage that very many contents share, their windows are told apart singly.

Defined cases: a null text is empty; texts shorter than LENGTH keep all their bytes; strings are compared as UTF-8 bytes
and never cross texts, but may overlap in one; repeated rows are copies of each other; ids don't matter, null or equal;
an empty table gives an empty result; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

LENGTH, GRAM = 400, 128
SECTION = 1 << 20
#: Contents that share an anchor from which on it is split, and into how many classes.
SPLIT_FROM, SPLIT = 400, 8
#: Stretches that meet from which on they are compared window by window, each window on its own.
CROWD = 800
#: Bytes of stretches whose buckets are refined together; more only where one anchor has more.
BATCH_BYTES, PART_BYTES = 1 << 20, 16 << 20
#: Words of a passage that counts as repeated, whatever its bytes; and of the strings that stand for it.
PASSAGE, PASSAGE_GRAM = 50, 36
_PLACE = np.uint64(SECTION * 2 - 1)
_WORD_PLACE = np.uint64((1 << 24) - 1)
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, from the minima of blocks' beginnings and ends."""
    n = len(x) - width + 1
    rows = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    rows[: len(x)] = x
    rows = rows.reshape(-1, width)
    begin, end = np.minimum.accumulate(rows, axis=1).ravel(), np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(end[:n], begin[width - 1 : width - 1 + n])


def anchors(body: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each anchor in texts of SECTION bytes together at most."""
    n = len(body)
    none = np.empty(0, np.int64)
    if n < length:
        return none.view(np.uint64), none, none, none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(common.BYTE_CODE[body] * common.powers(common.BASE, n)[:n], out=total[1:])
    hashes = common.mix((total[gram:] - total[:-gram]) * common.powers(common.UNBASE, n)[: n - gram + 1])
    last = np.repeat(at[1:], np.diff(at))  # each byte's end of text
    key = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    key[np.arange(len(hashes)) + gram > last[: len(hashes)]] = np.iinfo(np.uint64).max
    place = (_sliding_min(key, length - gram + 1) & _PLACE).astype(np.int64)
    start = np.flatnonzero(np.arange(n - length + 1) + length <= last[: n - length + 1])
    if not len(start):
        return none.view(np.uint64), none, none, none
    place = place[start]
    new = np.ones(len(start), bool)
    new[1:] = place[1:] != place[:-1]
    first = np.flatnonzero(new)
    return hashes[place[first]], place[first], start[first], start[np.append(first[1:], len(start)) - 1]


def prints(body: np.ndarray, at: np.ndarray, words: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of strings of ``gram`` words, so chosen that each passage of ``words`` words holds a chosen one, by its own words alone."""
    _, _, hashes, first = common.words_of(body, at, _WORD)
    texts, found, width = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], words - gram + 1
    i = 0
    while i < len(at) - 1:  # texts of PIECE words together, or one that is longer in parts that overlap
        j = max(i + 1, int(np.searchsorted(first, first[i] + common.PIECE, "right")) - 1)
        for a in range(int(first[i]), max(int(first[i]) + 1, int(first[j]) - words + 1), 16 * common.PIECE):
            own = hashes[a : min(int(first[j]), a + 16 * common.PIECE + words - 1)]
            if len(own) < words:
                continue
            total = np.zeros(len(own) + 1, np.uint64)
            np.cumsum(own * common.powers(common.BASE, len(own))[: len(own)], out=total[1:])
            strings = common.mix((total[gram:] - total[:-gram]) * common.powers(common.UNBASE, len(own))[: len(own) - gram + 1])
            places = np.arange(len(strings))
            last = first[np.searchsorted(first, a + places, "right")] - a  # where the text of each place ends
            key = (strings & ~_WORD_PLACE) | places.astype(np.uint64)
            key[places + gram > last] = np.iinfo(np.uint64).max
            least = _sliding_min(key, width)
            chosen = np.unique((least[places[: len(least)] + words <= last[: len(least)]] & _WORD_PLACE).astype(np.int64))
            texts.append(np.searchsorted(first, a + chosen, "right") - 1)
            found.append(strings[chosen])
        i = j
    pairs = np.unique(np.stack([np.concatenate(texts).view(np.uint64), np.concatenate(found)], axis=1), axis=0)
    return pairs[:, 0].view(np.int64), pairs[:, 1]


def _sections(texts: pa.Array, length: int):
    """Pieces of up to SECTION bytes: (bytes, offsets, number of the first text, its bytes before); longer texts in parts that overlap."""
    body, at = common.utf8(texts)
    i = 0
    while i < len(at) - 1:
        if at[i + 1] - at[i] > SECTION:
            for a in range(int(at[i]), int(at[i + 1]) - length + 1, SECTION - length + 1):
                b = min(int(at[i + 1]), a + SECTION)
                yield body[a:b], np.array([0, b - a]), i, a - int(at[i])
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(at, at[i] + SECTION, "right")) - 1)
        yield body[at[i] : at[j]], at[i : j + 1] - at[i], i, 0
        i = j


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:16], "big", signed=True)


def contents(docs: DataFrame, key: str, text: str, length: int, gram: int) -> DataFrame:
    """(id, c1, c2, n_bytes, sha256, hashes, places, prints) of each row: c1 and c2 stand for the text; places hold an anchor's place, and its least and greatest offset in a window; written."""

    def find(batches):
        common.owner("suffix_dedup")
        for part in common.sliced(batches, "text"):
            texts = part.column("text")
            body, at = common.utf8(texts)
            data = body.tobytes()
            digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            owner, hashes, places = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for piece, own_at, number, before in _sections(texts, length):
                h, p, s0, s1 = anchors(piece, own_at, length, gram)
                text_of = np.searchsorted(own_at, p, "right") - 1
                owner.append(text_of + number)
                hashes.append(h)
                places.append((p - own_at[text_of] + before) << 20 | (p - s1) << 10 | (p - s0))
            offsets = pa.array(np.searchsorted(np.concatenate(owner), np.arange(part.num_rows + 1)), pa.int32())
            halves = [_halves(d) for d in digests]
            columns = [part.column("id"), *(pa.array([h[i] for h in halves], pa.int64()) for i in (0, 1)), pa.array(np.diff(at), pa.int64()), pa.array([d.hex() for d in digests])]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).view(np.int64))) for x in (hashes, places)]
            of, strings = prints(body, at, PASSAGE, PASSAGE_GRAM)
            lists.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)), pa.int32()), pa.array(strings.view(np.int64))))
            yield pa.RecordBatch.from_arrays(columns + lists, ["id", "c1", "c2", "n_bytes", "sha256", "hashes", "places", "prints"])

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return common.cut(rows.mapInArrow(find, "id long, c1 long, c2 long, n_bytes long, sha256 string, hashes array<long>, places array<long>, prints array<long>"), "contents")


def _stretches(length: int, gram: int, slim: bool):
    """A function of candidates' batches: for each anchor (or class of a split one) the stretch of text that its windows cover."""

    def make(batches):
        names = ["meet", "f1", "f2", "copies", "owned", "body"] if not slim else ["f1", "f2", "c1", "c2", "start"]
        for part in common.sliced(batches, "text", 1 << 20):
            rows, seen = [], {}
            for text, c1, c2, found in zip(*(part.column(c).to_pylist() for c in ("text", "c1", "c2", "found")), strict=True):
                data = text.encode()
                for a in found:
                    place, low, high = a["place"] >> 20, a["place"] >> 10 & 1023, a["place"] & 1023
                    if a["size"] < SPLIT_FROM:
                        classes = [(low, high)]
                    else:
                        width = -(-(length - gram + 1) // SPLIT)
                        classes = [(max(low, k * width), min(high, k * width + width - 1)) for k in range(SPLIT)]
                    for k, (d0, d1) in enumerate(classes):
                        if d0 > d1:
                            continue
                        start = place - d1
                        body = data[start : place - d0 + length]
                        owned = d1 - d0 + 1
                        if len(classes) == 1:
                            meet = a["hash"]
                        else:
                            # What all windows of the class hold: from its least offset before the anchor to what its greatest leaves after it.
                            inner = data[place - k * width : place + length - min(k * width + width - 1, length - gram)]
                            meet = _halves(hashlib.blake2b(inner, digest_size=16, salt=bytes([k])).digest())[0]
                        f1, f2 = _halves(hashlib.blake2b(body, digest_size=16, key=d1.to_bytes(2, "big") + d0.to_bytes(2, "big")).digest())
                        if slim:
                            rows.append((f1, f2, c1, c2, start))
                        elif (f1, f2) in seen:
                            rows[seen[f1, f2]][3] += 1
                        else:
                            seen[f1, f2] = len(rows)
                            rows.append([meet, f1, f2, 1, owned, body])
            if rows:
                kinds = [pa.int64()] * 5 + ([pa.binary()] if not slim else [])
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return make, "meet long, f1 long, f2 long, copies long, owned long, body binary" if not slim else "f1 long, f2 long, c1 long, c2 long, start long"


def repeated(bodies: list[bytes], owned: list[int], length: int) -> list[np.ndarray]:
    """For each stretch which of its first ``owned`` places begin a string of ``length`` bytes that begins at another such place too.

    Bucket-pointer refinement: ``bucket`` holds the bucket of each place at the depth reached. Places alone in theirs, or
    before such a place, are done with; the others are sorted by their bucket and that at their depth's end.
    """
    size = np.array([len(b) for b in bodies])
    at = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
    n = int(at[-1])
    end = np.repeat(at[1:], size)
    gram = np.lib.stride_tricks.sliding_window_view(data, 8)[:n]
    own = np.flatnonzero(np.arange(n) + 8 <= end)
    bucket, shared = np.zeros(n, np.int64), np.zeros(n, bool)

    def refine(places: np.ndarray, keys: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(keys)))
        places = places[order]
        shared[:] = False
        bucket[places] = np.repeat(first, count)
        shared[places] = np.repeat(count > 1, count)

    refine(own, np.ascontiguousarray(gram[own]).view(np.uint64).ravel())
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        places = np.flatnonzero(shared & (np.arange(n) + depth + step <= end))
        places = places[shared[places + step]]
        if depth + step == length:  # only windows count now
            begin = np.zeros(n + 1, np.int64)
            np.add.at(begin, at[:-1], 1)
            np.add.at(begin, at[:-1] + np.array(owned), -1)
            places = places[np.cumsum(begin)[:n][places] > 0]
        refine(places, bucket[places] * n + bucket[places + step])
        depth += step
    return [shared[a : a + k] for a, k in zip(at[:-1], owned, strict=True)]


def _verdicts(length: int):
    """A function of stretches in the order of where they meet: (f1, f2, copies, mask) of those with repeated windows."""

    def judge(batches):
        held, size, last = [], 0, None

        def out():
            bodies: dict[tuple[int, int], list] = {}
            for _, f1, f2, copies, owned, body in held:
                bodies.setdefault((f1, f2), [0, owned, body])[0] += copies
            single = [x for x in bodies.values() if x[0] == 1]
            several = [x for x in bodies.values() if x[0] > 1]
            # One of several equal stretches is enough to compare the others with.
            masks = repeated([x[2] for x in single + several], [x[1] for x in single + several], length)
            verdict = {id(x): m for x, m in zip(single + several, masks, strict=True)}
            rows = []
            for (f1, f2), x in bodies.items():
                mask = verdict[id(x)] if x[0] == 1 else np.ones(x[1], bool)
                if mask.any():
                    rows.append((f1, f2, x[0], np.packbits(mask, bitorder="little").tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.binary()], strict=True)], ["f1", "f2", "copies", "mask"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and size >= BATCH_BYTES:
                    yield from out()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row[0]
        if held:
            yield from out()

    return judge


def _windows(length: int):
    """A function of stretches that meet with very many others: each of their windows by itself, as 128 bits."""

    def make(batches):
        for batch in batches:
            rows = []
            for f1, f2, copies, owned, body in zip(*(batch.column(c).to_pylist() for c in ("f1", "f2", "copies", "owned", "body")), strict=True):
                for i in range(owned):
                    rows.append((f1, f2, i, copies, *_halves(hashlib.blake2b(body[i : i + length], digest_size=16).digest())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["f1", "f2", "i", "copies", "w1", "w2"])

    return make


def _masks(batches):
    """(f1, f2, copies, mask) of stretches with the numbers of their repeated windows."""
    for batch in batches:
        masks = []
        for own in batch.column("repeated").to_pylist():
            bits = np.zeros(max(own) + 1, bool)
            bits[own] = True
            masks.append(np.packbits(bits, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("f1", "f2", "copies")), pa.array(masks, pa.binary())], ["f1", "f2", "copies", "mask"])


def _crowded(stretches: DataFrame, length: int) -> DataFrame:
    """(f1, f2, copies, mask) of stretches of crowded meetings with repeated windows.

    All windows of a meeting have the same string around their anchor, so its stretches differ only in what lies further
    out. Where so many meet, the last refinement is by the windows themselves: equal ones are counted, partly before the
    shuffle, and no task holds a meeting.
    """
    windows = common.cut(stretches.mapInArrow(_windows(length), "f1 long, f2 long, i long, copies long, w1 long, w2 long"), "windows")
    often = common.cut(windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n"), F.count("*").alias("size")).where("n > 1").select("w1", "w2", "size"), "often")
    found = common.join_keyed(windows, often, ["w1", "w2"], "size").groupBy("f1", "f2", "i").agg(F.sum("copies").alias("copies"))
    return found.groupBy("f1", "f2").agg(F.max("copies").alias("copies"), F.collect_list("i").alias("repeated")).mapInArrow(_masks, "f1 long, f2 long, copies long, mask binary")


def _content(text: Column) -> dict[str, Column]:
    sha = F.sha2(text, 256)
    return {"c1": F.conv(F.substring(sha, 1, 16), 16, -10).cast("long"), "c2": F.conv(F.substring(sha, 17, 16), 16, -10).cast("long")}


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans, passage[, kept]) of each row.

    spans are maximal runs [start, end) of removed bytes. passage says whether the text holds a passage of PASSAGE words
    that another row holds too, also if that has fewer bytes than are removed: always found from PASSAGE words on, never
    below PASSAGE_GRAM.
    """
    if not 0 <= length - gram < 1023:
        raise ValueError("length has to be gram or more, by 1022 at most: offsets in a window are held in ten bits")
    spark = common.prepare(docs.sparkSession)
    base = contents(docs, key, text, length, gram)
    classes = base.groupBy("c1", "c2").agg(F.count("*").alias("size"), F.min("id").alias("id"), F.first("n_bytes").alias("n_bytes"), F.first("sha256").alias("sha256"), F.first("hashes").alias("hashes"), F.first("places").alias("places"), F.first(F.size("prints")).alias("n_prints"))
    classes = common.cut(classes, "classes")
    spots = classes.select("c1", "c2", F.explode(F.arrays_zip("hashes", "places")).alias("a")).select("c1", "c2", F.col("a.hashes").alias("hash"), F.col("a.places").alias("place"))
    which = F.xxhash64("c1", "place")
    often = common.cut(spots.groupBy("hash").agg(F.count("*").alias("size"), F.min(which).alias("x"), F.max(which).alias("y")).where("x < y").select("hash", "size"), "anchors")
    found = common.join_keyed(spots, often, ["hash"], "size").groupBy("c1", "c2").agg(F.collect_list(F.struct("hash", "place", "size")).alias("found"))
    wanted = classes.select("c1", "c2", "id").join(found, ["c1", "c2"])
    plain = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    candidates = common.cut(plain.withColumns(_content(F.col("text"))).join(wanted, ["id", "c1", "c2"]).select("c1", "c2", "text", "found"), "candidates")

    make, schema = _stretches(length, gram, slim=False)
    stretches = common.cut(candidates.mapInArrow(make, schema), "stretches")
    crowds = common.cut(stretches.groupBy("meet").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("meet"), "crowds")
    n_bytes = candidates.agg(F.sum(F.size("found"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, n_bytes * (2 * length - gram) // PART_BYTES)
    met = stretches.join(crowds, "meet", "left_anti").repartition(int(parts), "meet").sortWithinPartitions("meet")
    verdicts = met.mapInArrow(_verdicts(length), "f1 long, f2 long, copies long, mask binary")
    verdicts = verdicts.unionByName(_crowded(stretches.join(crowds, "meet", "left_semi"), length))
    verdicts = common.cut(verdicts.groupBy("f1", "f2").agg(F.sum("copies").alias("copies"), F.max("mask").alias("mask")), "verdicts")
    make, schema = _stretches(length, gram, slim=True)
    windows = common.cut(candidates.mapInArrow(make, schema), "windows")
    masks = common.join_keyed(windows, verdicts, ["f1", "f2"], "copies").groupBy("c1", "c2").agg(F.collect_set(F.struct("start", "mask")).alias("masks"))

    def judge(batches):
        for part in common.sliced(batches, "text", 1 << 20):
            rows = []
            for text_, c1, c2, own in zip(*(part.column(c).to_pylist() for c in ("text", "c1", "c2", "masks")), strict=True):
                data = text_.encode()
                cover = np.zeros(len(data) + 1, np.int64)
                for m in own:
                    begin = np.flatnonzero(np.unpackbits(np.frombuffer(m["mask"], np.uint8), bitorder="little")) + m["start"]
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, begin + length, -1)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(cover) > 0])))
                spans = edge.reshape(-1, 2).tolist()
                kept = b"".join(data[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(data)], strict=True))
                rows.append((c1, c2, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in spans], kept if keep_text else None))
            if rows:
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["c1", "c2", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    span = "array<struct<start: long, end: long>>"
    judged = candidates.select("c1", "c2", "text").join(masks, ["c1", "c2"]).mapInArrow(judge, f"c1 long, c2 long, n_removed long, n_spans long, kept_sha256 string, spans {span}, kept binary").dropDuplicates(["c1", "c2"])
    judged = common.cut(judged, "judged")
    copied = (F.col("size") > 1) & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    # Passages that other contents hold too, whether or not they have LENGTH bytes.
    prints_ = base.select("c1", F.explode("prints").alias("print"))
    met_ = common.cut(prints_.groupBy("print").agg(F.min("c1").alias("x"), F.max("c1").alias("y"), F.count("*").alias("n")).where("x < y").select("print", "n"), "prints")
    passages = common.join_keyed(prints_, met_, ["print"], "n").select("c1").distinct().withColumn("in_others", F.lit(True))
    classes = classes.join(passages, "c1", "left")
    columns = {
        "passage": F.coalesce(F.col("in_others"), F.lit(False)) | ((F.col("size") > 1) & (F.col("n_prints") > 0)),
        "n_removed": F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long"),
        "n_spans": F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long"),
        "kept_sha256": F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")),
        "spans": F.when(copied, whole).otherwise(F.coalesce("spans", F.array().cast(span))),
        "kept": F.when(copied, F.lit(b"")).otherwise(F.col("kept")),
    }
    placed = common.cut(classes.select("c1", "c2", "size", "n_bytes", "sha256", "in_others", "n_prints").join(judged, ["c1", "c2"], "left").select("c1", "c2", "size", *(c.alias(k) for k, c in columns.items())), "placed")
    out = common.join_keyed(base.select(F.nullif("id", F.lit(-(2**63))).alias("id"), "c1", "c2", "n_bytes"), placed, ["c1", "c2"], "size")
    return out.select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "passage", *(["kept"] if keep_text else []))


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: its bytes, those removed, their runs, and the digest of what is left; then whether any
    were removed, and whether it holds a passage of 50 words that another document holds too."""
    out = removals(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("any_removed"), F.col("passage").alias("repeated_passage"))
