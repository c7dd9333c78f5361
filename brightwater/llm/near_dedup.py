"""Near-duplicate detection by min-max hashing, confirmed on full sets.

A document's set is its distinct word shingles, as 64-bit hashes. Each permutation gives two values of a signature, its
minimum and its maximum, which halves the hashing. Signatures are cut into bands; the number of bands follows from the
threshold, so that two sets just at it miss all bands with a chance under MISS.

Equal sets are one node from the start. Of nodes that share a band only those can have a link whose shingles are shared
enough: a node with u shingles that no other candidate has is at best (n - u) / n similar to anything. In each band the
node with the fewest such shingles is compared with all others, the links are confirmed on full sets, and components
formed. Where the others of a band are of several components, they are compared across components only, and only if
they share one of their rarest shingles at places that leave room for enough others. So no link of two sets that share a
band is lost, and no group is expanded into all its pairs; links of sets that share none are missed.

Defined cases: null and empty texts and those without words have an empty set, are linked with nothing and kept; rows
with a null id are linked with nothing and kept; rows with the same id are one node that has the links of each; with
fewer words than a shingle has, the sequence of all is the only one; ties go to the smallest id; an empty table gives an
empty result; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.llm import common
from brightwater.llm.components import components

SHINGLE_WORDS = 5
#: Similarity in percent that links two documents.
PERCENT = 80
BAND_VALUES, MISS = 4, 1e-5
_CODE = common.BYTE_CODE[common.lowered()]
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_STEP = np.uint64(0xD6E8FEB86659FD93)


def bands(percent: int) -> int:
    """Bands of BAND_VALUES values that miss a pair at the threshold with a chance under MISS; an even number."""
    n = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** BAND_VALUES)) if percent < 100 else 2
    return n + n % 2


def shingles(texts: pa.Array, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes."""
    body, at = common.utf8(texts)
    _, _, hashes, first = common.words_of(body, at, _WORD, _CODE)
    power = common.powers(_STEP, words)
    n = max(0, len(hashes) - words + 1)
    sums = np.zeros(n, np.uint64)
    for k in range(words):
        sums += hashes[k : k + n] * power[k]
    sums = common.mix(sums)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(sums[a : b - words + 1]))
        elif b > a:
            out.append(common.mix((hashes[a:b] * power[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


class Signer:
    """Min-max signatures: for each permutation (a multiplication and an addition modulo 2**64) the least and greatest value."""

    def __init__(self, percent: int):
        self.bands = bands(percent)
        count = self.bands * BAND_VALUES // 2
        draw = np.random.default_rng(77)
        self.factor, self.shift = draw.integers(0, 2**64, count, np.uint64) | np.uint64(1), draw.integers(0, 2**64, count, np.uint64)
        self.power = common.powers(common.BASE, BAND_VALUES)[:BAND_VALUES]

    def values(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full(len(self.factor), 2**64 - 1, np.uint64), np.zeros(len(self.factor), np.uint64)
        for i in range(0, len(own), 512):
            x = own[i : i + 512, None] * self.factor + self.shift
            np.minimum(low, x.min(axis=0), out=low)
            np.maximum(high, x.max(axis=0), out=high)
        return low, high

    def keys(self, own: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band, which tells bands apart too; a permutation's two values go to different bands."""
        low, high = self.values(own)
        rows = np.concatenate([low.reshape(-1, BAND_VALUES), high.reshape(-1, BAND_VALUES)])
        return common.mix((common.mix(rows) * self.power).sum(axis=1, dtype=np.uint64) + np.arange(len(rows), dtype=np.uint64))


def signatures(docs: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    """(id, n, s1, s2, bands): the set's size, 128 bits that stand for it, and the band keys; written."""

    def sign(batches):
        common.owner("near_dedup")
        signer = Signer(percent)
        for part in common.sliced(batches, "text"):
            sets = shingles(part.column("text"))
            s1 = [common.mix(x ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64) for x in sets]
            s2 = [common.mix(x + _STEP).sum(dtype=np.uint64) for x in sets]
            keys = [signer.keys(x).view(np.int64) if len(x) else np.empty(0, np.int64) for x in sets]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(x) for x in sets], pa.int64()), *(pa.array(np.array(s, np.uint64).view(np.int64)) for s in (s1, s2)), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys)))],
                ["id", "n", "s1", "s2", "bands"],
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return common.cut(rows.mapInArrow(sign, "id long, n long, s1 long, s2 long, bands array<long>"), "signatures")


def full_sets(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, shingles) of the documents whose id is among the nodes; written."""

    def make(batches):
        common.owner("near_dedup")
        for part in common.sliced(batches, "text"):
            sets = shingles(part.column("text"))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))], ["id", "n", "shingles"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(nodes.hint("merge"), "id", "left_semi")  # the nodes grow with the corpus: no broadcast
    return common.cut(rows.mapInArrow(make, "id long, n long, shingles array<long>"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; written. A node that many pairs have is sent to them, not they to it."""
    degrees = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")).join(degrees, "a")
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))

    def compare(batches):
        common.owner("near_dedup")
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            x, y = batch.column("x"), batch.column("y")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                both = np.intersect1d(p, q, assume_unique=True).size
                keep[i] = 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])

    joined = common.join_keyed(pairs, left, ["a"], "degree", weight=F.size("x") * 8).select("a", "b", "x").join(right, "b").select("a", "b", "x", "y")
    return common.cut(joined.mapInArrow(compare, "a long, b long"), "links")


def _possible(percent: int, a: str, b: str):
    """Whether nodes of n shingles, u of them their own, can be similar enough: at most the smaller n - u is shared."""
    shared = F.least(F.col(f"{a}_n") - F.col(f"{a}_u"), F.col(f"{b}_n") - F.col(f"{b}_u"))
    return 100 * shared >= percent * (F.col(f"{a}_n") + F.col(f"{b}_n") - shared)


def _prefix_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes (id, n, shingles, component) in different components that can be similar enough.

    With all shingles in one order, rarest first, two similar sets share one among the first n - percent * n + 1 of
    each; all that stand before the first shared one are not shared, which bounds the similarity. A shingle's rows of
    its smallest component meet only those of its others. Shingles of one set only come first in that order, so they are
    counted, not ranked.
    """
    sets = common.cut(nodes.select(F.xxhash64("id", "shingles").alias("set"), "id", "n", "component", "shingles"), "open-sets")
    rows = sets.select("set", "component", F.explode("shingles").alias("h"))
    counts = rows.groupBy("h").agg(F.count("*").alias("df"), F.min("component").alias("x"), F.max("component").alias("y")).where("df > 1")
    shared = common.join_keyed(rows.select("set", "h"), common.cut(counts, "counts"), ["h"], "df", grows=True)
    own = Window.partitionBy("set")
    # Rows that are there several times have the same rank.
    ranked = shared.withColumn("r", F.dense_rank().over(own.orderBy("df", "h"))).withColumn("k", F.max("r").over(own)).where("x < y").select("set", "h", "x", "r", "k")
    ranked = ranked.join(sets.select("set", "id", "n", "component").hint("merge"), "set")
    place = F.col("n") - F.col("k") + F.col("r") - 1
    first = F.col("n") - F.ceil(F.col("n") * percent / 100 - 1e-9) + 1
    ranked = common.cut(ranked.withColumn("place", place).where(F.col("place") < first).select("h", "id", "n", "component", "place", "x"), "prefixes")
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in ("id", "n", "component", "place")]
    others = ranked.where(F.col("component") > F.col("x")).select("h", *side("a"))
    both = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    fit = (F.col("a_component") != F.col("b_component")) & (100 * both >= percent * (F.col("a_n") + F.col("b_n") - both))
    return others.join(ranked.select("h", *side("b")), "h").where(fit).select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def links(classes: DataFrame, docs: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    """(a, b): confirmed links between class representatives that connect whatever is linked."""
    rows = classes.select("id", F.explode("bands").alias("value"))
    shared = rows.groupBy("value").agg(F.count("*").alias("size"), F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("value", "size")
    shared = common.cut(shared, "bands")
    members = common.cut(common.join_keyed(rows, shared, ["value"], "size", grows=True), "members")
    sets = full_sets(docs, members.select("id").distinct(), key, text)
    # Shingles of one candidate only. A 32-bit hash may take some for shared, which just weakens the bound.
    owners = sets.select("id", F.explode("shingles").alias("h")).groupBy(F.hash("h").alias("h")).agg(F.min("id").alias("x"), F.max("id").alias("y"))
    own = owners.where("x = y").groupBy(F.col("x").alias("id")).agg(F.count("*").alias("u"))
    sizes = sets.groupBy("id").agg(F.max("n").alias("n"), F.count("*").alias("rows"))
    # Rows that share an id are one node; the bound says nothing of it then.
    nodes = sizes.join(own, "id", "left").select("id", "n", F.when(F.col("rows") == 1, F.coalesce("u", F.lit(0))).otherwise(0).alias("u"))
    nodes = common.cut(nodes.where((F.col("u") == 0) | (100 * (F.col("n") - F.col("u")) >= percent * F.col("n"))), "nodes")
    members = common.cut(members.select("value", "id").join(nodes, "id"), "members")
    centre = common.cut(members.groupBy("value").agg(F.min(F.struct("u", "id", "n")).alias("c"), F.count("*").alias("size")).where("size > 1"), "centres")
    star = common.join_keyed(members, centre, ["value"], "size", grows=True).select(F.col("c.id").alias("a"), F.col("id").alias("b"), F.col("c.n").alias("a_n"), F.col("c.u").alias("a_u"), F.col("n").alias("b_n"), F.col("u").alias("b_u"))
    star = common.cut(star.where((F.col("a") != F.col("b")) & _possible(percent, "a", "b")).select("a", "b").distinct(), "pairs")
    linked = confirmed(star, sets, percent)
    found = components(linked)
    # What is left: bands whose nodes, but for the centre that was compared with all, are of several components.
    others = common.join_keyed(members, centre.select("value", "size", F.col("c.id").alias("centre")), ["value"], "size", grows=True).where(F.col("id") != F.col("centre")).select("value", "id")
    placed = common.cut(others.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")), "placed")
    mixed = placed.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x < y").select("value", "size")
    open_ = common.cut(common.join_keyed(placed, common.cut(mixed, "mixed"), ["value"], "size", grows=True).groupBy("id").agg(F.first("component").alias("component")), "open")
    rest = _prefix_pairs(sets.select("id", "n", "shingles").join(open_, "id"), percent)
    rest = common.cut(rest.join(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
    more = confirmed(rest, sets, percent)
    return linked.unionByName(more)


def mark(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, component, kept) of each row of docs; written."""
    common.prepare(docs.sparkSession)
    signed = signatures(docs, percent, key, text)
    some = signed.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = common.cut(some.groupBy("s1", "s2").agg(F.min("id").alias("id"), F.count("*").alias("size"), F.first("bands").alias("bands")), "classes")
    # Rows that share an id are one node: what links the classes of the others to theirs.
    same = some.select("id", "s1", "s2").distinct().join(some.groupBy("id").agg(F.count("*").alias("r")).where("r > 1"), "id", "left_semi").join(classes.select("s1", "s2", F.col("id").alias("rep")), ["s1", "s2"])
    same = same.select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b")).where("a < b")
    found = components(links(classes, docs, percent, key, text).unionByName(same))
    placed = classes.select("s1", "s2", "size", "id").join(found.withColumnRenamed("node", "id"), "id", "left").select("s1", "s2", "size", F.coalesce("component", "id").alias("component"))
    none = signed.where((F.col("n") == 0) | F.col("id").isNull()).select("id", "n", F.col("id").alias("component"))
    out = common.join_keyed(some.select("id", "n", "s1", "s2"), common.cut(placed, "placed"), ["s1", "s2"], "size").select("id", "n", "component")
    return common.cut(out.unionByName(none).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True))), "marks")


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: its set's size, its component, and whether it is the one that stays."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark(docs, percent=85).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")
