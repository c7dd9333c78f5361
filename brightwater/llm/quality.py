"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a few numbers (lengths, shares of character classes, repetition of words and lines). Cyclic boosting goes
round the features and fits a shallow tree of each to what is left of the log loss; the trees of a feature add up to
one lookup table over its bins. Then the pairs whose tables help most get theirs in the same way. A score is the sum of
the looked-up values, for all rows at once, through the logistic function.

Defined cases: null and empty texts have all-zero features and get a score as others do; labels that are null or not 0
or 1 and labelled rows without a document teach nothing; with no usable label every score is 0.5; repeated rows are
scored alike; an empty table gives an empty result. The label, lang, source and id of a row are never inputs; a document
whose id is there several times teaches once, with its least features, so the sample stays bounded.
Other columns pass through, whatever their names; only one named __score is refused with a ValueError.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

#: Labelled rows that the model learns from, at most; those with the smallest hash of their id.
TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, PAIRS = 120, 60, 0.15, 3, 6
LEAST_ROWS = 5.0
THRESHOLD = 0.3
FEATURES = ["log_bytes", "log_words", "mean_word", "upper", "digit", "space", "sentence_mark", "bang", "bar", "symbol", "other_mark", "distinct_words", "repeated_next", "capital_words", "log_lines", "line_bytes", "same_lines"]


def _class_table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.float64)
    out[list(chars)] = 1
    return out


_SPACES = bytes([9, 10, 11, 12, 13, 32])
_CLASSES = np.stack([_class_table(x) for x in (bytes(range(65, 91)), bytes(range(48, 58)), _SPACES, b".,;:'\"?-()", b"!", b"|", b"#$%&*@^~<>{}[]\\/_=+`")])
_WORD = np.ones(256, bool)
_WORD[list(_SPACES)] = False
_LINE = np.ones(256, bool)
_LINE[10] = False


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    body, at = common.utf8(texts)
    n = len(at) - 1
    out = np.zeros((n, len(FEATURES)))
    code = common.BYTE_CODE[common.lowered()]
    w_first, w_last, w_hash, w_at = common.words_of(body, at, _WORD, code)
    _, _, l_hash, l_at = common.words_of(body, at, _LINE)
    capital = (body[w_first] >= 65) & (body[w_first] <= 90) if len(w_first) else np.empty(0, bool)
    for i in range(n):
        a, b = at[i], at[i + 1]
        if a == b:
            continue
        size, words, lines = b - a, w_hash[w_at[i] : w_at[i + 1]], l_hash[l_at[i] : l_at[i + 1]]
        share = _CLASSES @ np.bincount(body[a:b], minlength=256) / size
        nw, nl = len(words), len(lines)
        letters = (w_last[w_at[i] : w_at[i + 1]] - w_first[w_at[i] : w_at[i + 1]]).sum()
        out[i] = [
            np.log1p(size), np.log1p(nw), letters / max(nw, 1), *share[:3], *share[3:7], 0.0,
            len(np.unique(words)) / np.sqrt(max(nw, 1)), (words[1:] == words[:-1]).mean() if nw > 1 else 0.0, capital[w_at[i] : w_at[i + 1]].mean() if nw else 0.0,
            np.log1p(nl), size / max(nl, 1), 1 - len(np.unique(lines)) / nl if nl else 0.0,
        ]
        out[i, 10] = share[3:7].sum()
    return out


def _tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int) -> np.ndarray:
    """The values of a tree of at most ``leaves`` leaves over consecutive bins, from each bin's sums."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(hessian)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    parts = [(0, len(gradient))]
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            gains = gain(a, at) + gain(at, b) - gain(a, b)
            gains[(h[at] - h[a] < LEAST_ROWS / 8) | (h[b] - h[at] < LEAST_ROWS / 8)] = -1
            if gains.max(initial=-1) > best[0]:
                best = (gains.max(), p, int(at[gains.argmax()]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.empty(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, float]:
    """The values of the best four-leaf tree over a grid (one cut of the rows, then one of each half's columns), and its gain."""
    best, values = 0.0, np.zeros_like(gradient)
    value = lambda g, h: g / (h + 1.0)
    for cut in range(1, len(gradient)):
        gain, grid = 0.0, np.empty_like(gradient)
        for part in (slice(0, cut), slice(cut, None)):
            g, h = gradient[part].sum(axis=0).cumsum(), hessian[part].sum(axis=0).cumsum()
            gains = g[:-1] ** 2 / (h[:-1] + 1.0) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1.0)
            at = int(gains.argmax())
            gain += gains[at]
            grid[part, : at + 1], grid[part, at + 1 :] = value(g[at], h[at]), value(g[-1] - g[at], h[-1] - h[at])
        if gain > best:
            best, values = gain, grid
    return values, best


class AdditiveModel:
    """Bin edges, a lookup table for each feature and for each chosen pair, and the intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.bias, self.pairs = 0.0, []
        width = x.shape[1]
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for j in range(width)]
        self.coarse = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(x) else np.empty(0) for j in range(width)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.grids: list[np.ndarray] = []
        if len(y) and 0 < y.mean() < 1:
            self._fit(x, y)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.bias = float(np.log(y.mean() / (1 - y.mean())))
        bins, logit = self._bins(x, self.edges), np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-logit))
                step = RATE * _tree(np.bincount(bins[j], y - p, len(table)), np.bincount(bins[j], p * (1 - p), len(table)), LEAVES)
                table += step
                logit += step[bins[j]]
        coarse = self._bins(x, self.coarse)
        sums = lambda cell, size, p: (np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size))
        p, ranked = 1 / (1 + np.exp(-logit)), []
        for i, j in itertools.combinations(range(x.shape[1]), 2):
            shape = len(self.coarse[i]) + 1, len(self.coarse[j]) + 1
            if min(shape) > 1:
                g, h = sums(coarse[i] * shape[1] + coarse[j], shape[0] * shape[1], p)
                ranked.append((_pair_tree(g.reshape(shape), h.reshape(shape))[1], i, j))
        self.pairs = [(i, j) for _, i, j in sorted(ranked, reverse=True)[:PAIRS]]
        self.grids = [np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                p = 1 / (1 + np.exp(-logit))
                g, h = sums(coarse[i] * grid.shape[1] + coarse[j], grid.size, p)
                step = RATE * _pair_tree(g.reshape(grid.shape), h.reshape(grid.shape))[0]
                grid += step
                logit += step[coarse[i], coarse[j]]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.bias)
        for table, own in zip(self.tables, self._bins(x, self.edges), strict=True):
            logit += table[own]
        if self.pairs:
            coarse = self._bins(x, self.coarse)
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                logit += grid[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-logit))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> AdditiveModel:
    """The model of at most ``rows`` labelled rows that aren't held out."""
    common.prepare(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(key) & F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__key"), F.col(label).cast("double").alias("__y"), F.xxhash64(key).alias("__h"))
    sample = known.orderBy("__h", "__y").limit(rows).groupBy("__key").agg(F.max("__y").alias("__y"))
    column = lambda c: F.col(f"`{c}`")
    texts = docs.select(column(key).cast("string").alias("__key"), column(text).alias("__text"))
    joined = texts.join(F.broadcast(sample), "__key").select("__key", "__text", "__y")

    def numbers(batches):
        for part in common.sliced(batches, "__text"):
            x = features(part.column("__text"))
            yield pa.RecordBatch.from_arrays([part.column("__key"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())), part.column("__y")], ["key", "x", "y"])

    each = joined.mapInArrow(numbers, "key string, x array<double>, y double")
    found = each.groupBy("key").agg(F.min("x").alias("x"), F.max("y").alias("y")).toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = found.column("y").to_numpy()
    order = np.lexsort((*x.T, y))  # the same model whatever the order in which rows arrive
    return AdditiveModel(x[order], y[order])


def score(docs: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """docs with the column __score."""
    common.prepare(docs.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        common.owner("quality")
        out, first, (_, at) = [np.empty(0)], 0, common.utf8(texts)
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + common.SLICE_BYTES, "right")) - 1)
            out.append(model.score(features(texts.slice(first, last - first))))
            first = last
        return pa.array(np.concatenate(out))

    common.refuse(docs, "__score")
    return docs.withColumn("__score", scored(F.col(f"`{text}`")))


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: whether it was held out, its score, and the prediction."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    out = score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
