"""Exact top-k search by vector-approximation files.

Three tables are written. The exact vectors, a row each. Their approximation: blocks of BLOCK vectors with one byte for
each component, the cell of the component's range within the block. And the queries, in blocks too. A search reads the
approximation twice and few exact vectors:

1. Cells bound every score from both sides. Each query's k greatest lower bounds over all blocks give a floor under its
   kth score.
2. Only vectors whose upper bound reaches the floor can be among the k best; these are listed.
3. Exact vectors are read in the order of their upper bounds: first the FIRST best of each query, whose kth exact score
   is the new floor, then those that still reach it. What is left then is certain.

Queries and approximations meet as blocks of rows, so neither side has to fit one machine; exact vectors travel only
where they are listed. Still each query meets each cell: an exhaustive exact search is quadratic if its queries grow
with its vectors.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, and neither do rows with a
null id; empty vectors and those of another length than the query's aren't its candidates; rows with the query's own
id are the query's own; ties go to the smaller id, repeated rows are candidates of their own, and queries that are the
same row twice are answered once; with fewer than k candidates all are returned; an empty table gives an empty result;
other columns are left out, so their names can't clash. Components times 1024 and scores have to fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.llm import common

BLOCK, QUERY_BLOCK = 4096, 512
SCALE = 1024
K = 10
QUERY_EVERY = 100
#: Candidates of a query whose exact vectors are read at first, as a multiple of k.
FIRST = 4
#: Query blocks whose bounds a task keeps at once.
HELD = 64


def exact(vectors: DataFrame, key: str, vector: str, what: str) -> DataFrame:
    """(at, id, dim, values) of the vectors that take part: floor(SCALE * x) as 64-bit integers, and a number for each row; written."""

    def pack(batches):
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            x = lists.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            own = np.flatnonzero((lengths > 0) & (bad[ends] == bad[ends - lengths]) & ids.is_valid().to_numpy(zero_copy_only=False))
            whole = np.floor(SCALE * np.where(np.isfinite(x), x, 0)).astype(np.int64)
            values = [whole[e - n : e].tobytes() for e, n in zip(ends[own], lengths[own], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at + np.arange(len(own))), ids.take(pa.array(own)).cast(pa.int64()), pa.array(lengths[own], pa.int32()), pa.array(values, pa.binary())], ["at", "id", "dim", "values"])
            at += len(own)

    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    return common.cut(rows.mapInArrow(pack, "at long, id long, dim int, values binary"), what)


def _blocks(batches, size: int):
    """(dim, rows' numbers, ids, values as a matrix) of ``size`` vectors at most."""
    held: dict[int, list] = {}

    def out(dim: int):
        at, ids, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
        return dim, at, ids, values.reshape(-1, dim)

    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            for i in range(0, len(own), size):
                some = batch.take(pa.array(own[i : i + size]))
                body, _ = common.utf8(some.column("values"))
                held.setdefault(dim, []).append((some.column("at").to_numpy(), some.column("id").to_numpy(), body.view(np.int64)))
                if sum(len(a) for a, _, _ in held[dim]) >= size:
                    yield out(dim)
    for dim in list(held):
        yield out(dim)


def approximate(there: DataFrame) -> DataFrame:
    """The approximation file: (dim, ats, ids, low, step, cells) for each block of exact vectors; written."""

    def cells(batches):
        for dim, at, ids, values in _blocks(batches, BLOCK):
            low = values.min(axis=0).astype(np.float64)
            step = np.maximum((values.max(axis=0) - low) / 255, 1e-9)
            cell = np.minimum((values - low) // step, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (at, ids, low, step, cell))], ["dim", "ats", "ids", "low", "step", "cells"])

    return common.cut(there.mapInArrow(cells, "dim int, ats binary, ids binary, low binary, step binary, cells binary"), "approximation")


def asked(queries: DataFrame) -> DataFrame:
    """(q_block, q_dim, q_ats, q_ids, q_values): the queries by blocks; written."""

    def pack(batches):
        block = TaskContext.get().partitionId() << 40
        for dim, at, ids, values in _blocks(batches, QUERY_BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([dim], pa.int32()), pa.array([at], pa.list_(pa.int64())), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, values))], ["q_block", "q_dim", "q_ats", "q_ids", "q_values"])
            block += 1

    return common.cut(queries.mapInArrow(pack, "q_block long, q_dim int, q_ats array<long>, q_ids binary, q_values binary"), "queries")


class Bounds:
    """For a block of queries and one of the approximation file: lower bounds of all scores, and what to add for the upper ones."""

    def __init__(self, dim: int, ids: bytes, low: bytes, step: bytes, cells: bytes, q_ids: bytes, q_values: bytes):
        self.ids, q = np.frombuffer(ids, np.int64), np.frombuffer(q_values, np.int64).reshape(-1, dim).astype(np.float64)
        low_, step_, cell = np.frombuffer(low), np.frombuffer(step), np.frombuffer(cells, np.uint8).reshape(-1, dim)
        base = (q * step_) @ cell.T.astype(np.float64) + (q @ low_)[:, None]
        slack = 1e-9 * (np.abs(q) @ (np.abs(low_) + 256 * step_)) + 1.0  # rounding, of cells and of this sum
        slack += 1e-6 * (np.abs(q) @ step_)
        self.lower, self.gap = base + (np.minimum(q, 0) @ step_ - slack)[:, None], np.abs(q) @ step_ + 2 * slack
        self.lower[np.frombuffer(q_ids, np.int64)[:, None] == self.ids] = -np.inf  # a query's own row


_PAIR = ("dim", "ats", "ids", "low", "step", "cells", "q_block", "q_dim", "q_ats", "q_ids", "q_values")


def _pairs(batches, more: tuple[str, ...] = ()):
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*_PAIR, *more)), strict=True):
            r = dict(zip((*_PAIR, *more), row, strict=True))
            if r["dim"] == r["q_dim"]:
                yield r, Bounds(r["dim"], r["ids"], r["low"], r["step"], r["cells"], r["q_ids"], r["q_values"])


def _best(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The k rows of each query that are first by a column, greatest first, with their rank."""
    order = Window.partitionBy("query").orderBy(F.desc(by), "id", "at")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``."""
    spark = vectors.sparkSession
    common.prepare(spark)
    there, wanted = exact(vectors, key, vector, "vectors"), exact(queries, key, vector, "wanted")
    wanted = common.cut(wanted.groupBy("id", "dim", "values").agg(F.min("at").alias("at")).select("at", "id", "dim", "values"), "wanted")
    cells, blocks = approximate(there), asked(wanted)
    # No join key: all query blocks meet all blocks of cells, where those lie; blocks of another length are skipped there.
    pairs = cells.crossJoin(blocks)

    def floors(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            while held:
                ats, best = held.popitem()[1]
                some = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ats, some.sum(axis=1))), pa.array(best[some])], ["query", "lower"])

        for r, bounds in _pairs(batches):
            ats, best = held.get(r["q_block"]) or (np.array(r["q_ats"], np.int64), np.full((len(bounds.lower), k), -np.inf))
            both = np.concatenate([best, bounds.lower], axis=1)
            held[r["q_block"]] = ats, np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            if len(held) > HELD:
                yield from out()
        yield from out()

    lowest = pairs.mapInArrow(floors, "query long, lower double").select("query", "lower", F.lit(0).alias("id"), F.lit(0).alias("at"))
    floor = _best(lowest, "lower", k).groupBy("query").agg(F.min("lower").alias("floor"), F.count("*").alias("n")).where(F.col("n") == k).select("query", "floor")
    # A floor for each query of a block, in their order; without k candidates there is none.
    each = blocks.select("q_block", F.posexplode("q_ats").alias("i", "query"))
    listed = each.join(floor, "query", "left").groupBy("q_block").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "floor"))), lambda x: x["floor"]).alias("floors"))
    blocks_ = common.cut(blocks.join(listed, "q_block"), "floors")

    def reach(batches):
        for r, bounds in _pairs(batches, ("floors",)):
            least = np.array([-np.inf if x is None else x for x in r["floors"]])
            upper = bounds.lower + bounds.gap[:, None]
            q, v = np.nonzero((upper >= least[:, None]) & np.isfinite(upper))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(r["q_ats"], np.int64)[q]), pa.array(np.frombuffer(r["ats"], np.int64)[v]), pa.array(bounds.ids[v]), pa.array(upper[q, v])], ["query", "at", "id", "upper"])

    candidates = common.cut(cells.crossJoin(blocks_).mapInArrow(reach, "query long, at long, id long, upper double"), "candidates")

    def scored(some: DataFrame, what: str) -> DataFrame:
        """The exact scores of candidates; a vector that many queries want is read once for all of them in a task."""
        x = some.join(there.select("at", F.col("values").alias("x")), "at")
        y = wanted.select(F.col("at").alias("query"), F.col("values").alias("y"))

        def multiply(batches):
            for batch in batches:
                a, b = (np.split(body.view(np.int64), (at // 8)[1:-1]) for body, at in (common.utf8(batch.column(c)) for c in ("x", "y")))
                scores = [int(p @ q) for p, q in zip(a, b, strict=True)] if batch.num_rows else []
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("at"), batch.column("id"), pa.array(scores, pa.int64())], ["query", "at", "id", "score"])

        return common.cut(x.join(y, "query").select("query", "at", "id", "x", "y").mapInArrow(multiply, "query long, at long, id long, score long"), what)

    early = common.cut(_best(candidates, "upper", FIRST * k).select("query", "at", "id"), "early")
    first = scored(early, "first")
    sure = _best(first, "score", k).groupBy("query").agg(F.min("score").alias("sure"), F.count("*").alias("n")).select("query", F.when(F.col("n") == k, F.col("sure")).alias("sure"))
    late = candidates.join(early.select("query", "at"), ["query", "at"], "left_anti").join(common.cut(sure, "sure"), "query", "left")
    late = late.where(F.col("sure").isNull() | (F.col("upper") >= F.col("sure"))).select("query", "at", "id")
    best = _best(first.unionByName(scored(late, "second")), "score", k)
    names = wanted.select(F.col("at").alias("query"), F.col("id").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    """The ten best for every vector whose id is divisible by 100."""
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
