"""Language identification by Bayesian fusion of evidence.

Four sources speak for a language: the text (hashed byte trigrams under a multinomial model), the declared language,
the suffix of the address, and the prior of the host. The host's prior is what its pages' texts say, by grouped
aggregation, smoothed towards its parent domain, that towards all pages, and that towards the uniform prior.

Trigrams overlap, so the text's log likelihood is that of TEXT_WEIGHT independent trigrams at most; a page of a few
words leans on the other evidence, a long one speaks for itself.

Defined cases: null and empty texts, those without a letter, and those of LEAST_TRIGRAMS that fit no language better
than chance are rejected as "und"; shorter ones with a letter go by the other evidence; null declarations, addresses
and hosts are neutral; ties go to the first language in
alphabetical order; with no labelled row at all every text is "und". Repeated rows are judged alike, an empty table
gives an empty result, and other columns pass through, whatever their names; only those named like a new column are
refused with a ValueError.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

#: Labelled rows that train the text model, at most; those with the smallest hash of their id.
TRAIN_ROWS = 8000
BUCKETS = 1 << 16
SMOOTHING = 0.05
#: The text counts as this many independent trigrams at most, or as a third of those it has.
TEXT_WEIGHT = 200.0
#: From this many trigrams on, a text that fits no language better than chance is in none.
LEAST_TRIGRAMS = 30
#: Chance that a declared language, and that of an address suffix, is the text's.
DECLARED, SUFFIX = 0.9, 0.8
#: Pages that a parent's prior counts as.
PRIOR_PAGES = 20.0
MIN_POSTERIOR = 0.5
# Address suffixes and the language they suggest.
SUFFIXES = {"at": "de", "de": "de", "ar": "es", "cl": "es", "es": "es", "mx": "es", "fr": "fr", "au": "en", "uk": "en", "us": "en"}


_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def trigrams(array: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text the buckets of its byte trigrams (A-Z in lower case) without digits, which are of no language; and whether it has a letter."""
    body, at = common.utf8(array)
    if len(body) < 3:
        x, plain = np.empty(0, np.uint32), np.empty(0, bool)
    else:
        b = common.lowered()[body].astype(np.uint32)
        x = b[:-2] * np.uint32(0x1F1F35) ^ b[1:-1] * np.uint32(0x9E3779B1) ^ b[2:] * np.uint32(0x85EBCA6B)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)
        digit = _DIGIT[body]
        plain = ~(digit[:-2] | digit[1:-1] | digit[2:])
    letters = np.concatenate([[0], np.cumsum(_LETTER[body])])
    ends = np.maximum(at[1:] - 2, at[:-1])
    return [x[a:b][plain[a:b]] for a, b in zip(at[:-1], ends, strict=True)], letters[at[1:]] > letters[at[:-1]]


class TextModel:
    """Log probabilities of trigram buckets for each language, relative to chance."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        share = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
        self.table = np.log(share * BUCKETS).T.astype(np.float32).copy() if languages else np.zeros((BUCKETS, 1), np.float32)

    def score(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean log likelihood of each text for each language, the number of trigrams, and whether there is a letter."""
        grams, lettered = trigrams(array)
        sums, count = np.zeros((len(grams), self.table.shape[1])), np.array([len(g) for g in grams], np.int64)
        for i, own in enumerate(grams):
            for k in range(0, len(own), 1 << 18):
                sums[i] += self.table[own[k : k + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return sums / np.maximum(count, 1)[:, None], count, lettered


def train(docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> TextModel:
    """The text model of at most ``rows`` labelled rows; held-out rows (crc32 of the id mod 5 is 0) are left out."""
    common.prepare(docs.sparkSession)
    labelled = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.crc32(F.col(key).cast("string")) % 5 != 0))
    ids = labelled.select(key, F.xxhash64(key).alias("__h")).orderBy("__h").limit(rows).select(key).distinct()
    sample = labelled.join(F.broadcast(ids), key, "left_semi").select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))

    def count(batches):
        common.owner("language")
        found: dict[str, np.ndarray] = {}
        for part in common.sliced(batches, "text"):
            grams, _ = trigrams(part.column("text"))
            for name, own in zip(part.column("label").to_pylist(), grams, strict=True):
                total = found.setdefault(name, np.zeros(BUCKETS, np.int64))
                total += np.bincount(own, minlength=BUCKETS)
        for name, own in found.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(own[used], pa.int64())], ["label", "bucket", "n"])

    # One row for each language and bucket: bounded, whatever the corpus.
    rows_ = sample.mapInArrow(count, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(rows_["label"]))
    counts = np.zeros((len(languages), BUCKETS))
    for name, own in rows_.groupby("label"):
        counts[languages.index(name), own["bucket"]] = own["n"]
    return TextModel(languages, counts)


def _evidence(model: TextModel):
    """An Arrow function of texts: for each language the weighted log likelihood; neutral where there is too little text, empty where it fits no language."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("array<double>")
    def evidence(texts: pa.Array) -> pa.Array:
        common.owner("language")
        found = []
        _, at = common.utf8(texts)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + common.SLICE_BYTES, "right")) - 1)
            found.append(model.score(texts.slice(first, last - first)))
            first = last
        if not found:
            return pa.array([], pa.list_(pa.float64()))
        mean, count, lettered = (np.concatenate(x) for x in zip(*found, strict=True))
        weighted = mean * np.minimum(count / 3.0, TEXT_WEIGHT)[:, None]
        good = (mean.max(axis=1) > 0) & (count > 0)
        weighted[~good] = 0.0  # too little to tell, or no language at all
        known = good | lettered & (count < LEAST_TRIGRAMS)
        sizes = np.where(known, weighted.shape[1], 0)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(weighted[known].ravel()))

    # Else a filter on what follows from it would be moved below, with a second evaluation of all texts.
    return evidence.asNondeterministic()


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def _said(languages: list[str], said: Column, chance: float) -> list[Column]:
    """For each language the log chance that ``said`` is stated of it; neutral where it is null or no known language."""
    known, other = said.isin(languages), np.log((1 - chance) / max(1, len(languages) - 1))
    return [F.when(F.coalesce(known, F.lit(False)), F.when(said == name, F.lit(float(np.log(chance)))).otherwise(F.lit(float(other)))).otherwise(F.lit(0.0)) for name in languages]


#: What a page doesn't show: comments, scripts and styles (to the end if never closed), and tags.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^>]*>", re.I | re.S)


def markup_text(page: Column) -> Column:
    """The text that markup shows, with references to characters resolved; null stays null."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def shown(pages: pa.Array) -> pa.Array:
        return pa.array([None if x is None else html.unescape(_HIDDEN.sub(" ", x)) for x in pages.to_pylist()], pa.string())

    return shown(page)


def markup_language(html: Column) -> Column:
    """The two letters that <html lang="..."> declares, in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1)), F.lit(""))


def address_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def identify(docs: DataFrame, model: TextModel, text: str = "text", declared: Column | None = None, host: Column | None = None) -> DataFrame:
    """docs with __lang ("und" if rejected as no language), __confidence, __text_lang and __accepted."""
    common.prepare(docs.sparkSession)
    common.refuse(docs, "__text_lang", "__lang", "__confidence", "__accepted")
    languages = model.languages
    if not languages:
        none = F.lit(None).cast("string")
        return docs.withColumns({"__text_lang": none, "__lang": F.lit("und"), "__confidence": F.lit(0.0), "__accepted": F.lit(False)})
    evidence = _evidence(model)
    host = F.lower((F.lit(None) if host is None else host).cast("string"))
    said = F.lit(None).cast("string") if declared is None else F.lower(F.substring(declared.cast("string"), 1, 2))
    # The row goes along as one column, so its names can't clash with those used here.
    keyed = docs.select(common.packed(docs), F.col(text).alias("__text"), F.coalesce(F.concat(F.lit("="), host), F.lit("-")).alias("__host"), said.alias("__stated"))
    k = len(languages)
    # What the texts of a host say: sums of k posteriors, partly summed before the shuffle.
    votes = keyed.select("__host", evidence(F.col("__text")).alias("__e")).where(F.size("__e") > 0).select("__host", _softmax(F.col("__e")).alias("__p"))
    by_host = common.cut(votes.groupBy("__host").agg(F.count("*").alias("__n"), *(F.sum(F.col("__p")[i]).alias(f"__s{i}") for i in range(k))), "hosts")
    name = F.expr("substring(__host, 2)")
    parent = F.when(F.size(F.split(name, r"\.")) > 2, F.regexp_replace(name, r"^[^.]*\.", "")).otherwise(F.element_at(F.split(name, r"\."), -1))
    parents = by_host.groupBy(parent.alias("__parent")).agg(F.sum("__n").alias("__pn"), *(F.sum(f"__s{i}").alias(f"__ps{i}") for i in range(k)))
    whole = by_host.agg(F.sum("__n").alias("n"), *(F.sum(f"__s{i}").alias(f"s{i}") for i in range(k))).first()
    top = [((whole[f"s{i}"] or 0.0) + PRIOR_PAGES / k) / ((whole["n"] or 0) + PRIOR_PAGES) for i in range(k)]
    mid = [(F.coalesce(F.col(f"__ps{i}"), F.lit(0.0)) + PRIOR_PAGES * top[i]) / (F.coalesce(F.col("__pn"), F.lit(0)) + PRIOR_PAGES) for i in range(k)]
    own = F.array(*(F.log((F.col(f"__s{i}") + PRIOR_PAGES * mid[i]) / (F.col("__n") + PRIOR_PAGES)) for i in range(k)))
    priors = common.cut(by_host.withColumn("__parent", parent).join(parents, "__parent", "left").select("__host", "__n", own.alias("__prior")), "priors")
    joined = common.join_keyed(keyed, priors, ["__host"], "__n", "left")
    suffix = F.element_at(F.split("__host", r"\."), -1)
    by_suffix = F.create_map(*(F.lit(x) for pair in SUFFIXES.items() for x in pair))[suffix] if SUFFIXES else F.lit(None)
    by_declared, by_address = _said(languages, F.col("__stated"), DECLARED), _said(languages, by_suffix, SUFFIX)
    default = F.array(*(F.lit(float(np.log(x))) for x in top))
    out = joined.withColumns({"__e": evidence(F.col("__text")), "__base": F.coalesce("__prior", default), "__said": F.array(*(a + b for a, b in zip(by_declared, by_address, strict=True)))})
    out = out.withColumn("__all", F.when(F.size("__e") > 0, _softmax(F.zip_with(F.zip_with("__e", "__base", lambda a, b: a + b), "__said", lambda a, b: a + b))))
    best = lambda c: F.element_at(F.array(*map(F.lit, languages)), F.array_position(c, F.array_max(c)).cast("int"))
    confidence = F.coalesce(F.array_max("__all"), F.lit(0.0))
    accepted = confidence >= MIN_POSTERIOR
    new = {"__text_lang": F.when(F.size("__e") > 0, best(F.col("__e"))), "__lang": F.when(accepted, best(F.col("__all"))).otherwise("und"), "__confidence": confidence, "__accepted": accepted}
    return out.withColumns(new).select("__row.*", *new)


def documents(docs: DataFrame) -> DataFrame:
    """identify() for the documents table: lang is what they declare, source their host."""
    return identify(docs, train(docs), declared=F.col("lang"), host=F.col("source"))


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: its language, that of the text alone, the posterior, and whether it is accepted."""
    common.prepare(spark)
    out = documents(common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", F.col("__lang").alias("language"), F.col("__text_lang").alias("text_language"), F.round("__confidence", 6).alias("confidence"), F.col("__accepted").alias("accepted"))


def pages(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """identify() for the pages table: text and declaration are from the markup, host and suffix from the address; the text model is that of docs."""
    shown = rows.withColumn("__shown", markup_text(F.col("html")))
    return identify(shown, train(docs), "__shown", declared=markup_language(F.col("html")), host=address_host(F.col("url"))).drop("__shown")


def pages_query(spark, sf_dir: str) -> DataFrame:
    """One row for each page: as query(), by all four kinds of evidence."""
    common.prepare(spark)
    out = pages(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"), common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("page_id", F.col("__lang").alias("language"), F.col("__text_lang").alias("text_language"), F.round("__confidence", 6).alias("confidence"), F.col("__accepted").alias("accepted"))
