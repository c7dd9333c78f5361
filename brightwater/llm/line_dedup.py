"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate of a host when the share of the host's pages that hold it is over a ratio, and MIN_PAGES pages do
at least: on a host of a few pages any line of one page would be over the ratio. Such lines are cut from the pages. A line counts once a page, is compared whole and case-sensitively, and blank lines never count.

Defined cases: a null host is a host of its own; a null text has no lines and stays null; an empty text is one blank
line; a page whose lines are all boilerplate keeps an empty text; repeated rows are pages of their own; an empty table
gives an empty result. Columns of the input pass through unchanged, whatever their names, but for the two new ones'.

With ``copies=False`` equal texts of a host count as one page, in the share and the least pages alike: else a group of
copies that is a large share of its host has all its lines cut, and nothing of it is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

#: Share of a host's pages above which a line is boilerplate, and the least pages that must hold it.
MAX_RATIO = 0.05
MIN_PAGES = 3


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def _host(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("-"))


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """(host, drop, n_pages): for each host with boilerplate the keys of its lines, and the host's pages.

    A host has at most (its mean lines a page / max_ratio) such lines, so ``drop`` is bounded by the page size.
    """
    pages = docs.select(_host(host).alias("__host"), F.col(text).alias("__text"))
    lines = pages.select("__host", _key(F.col("__text")).alias("__copy"), F.explode(F.array_distinct(F.split("__text", "\n"))).alias("__line")).where(F.trim(F.regexp_replace("__line", r"[\t\r\f]", " ")) != "")
    number = lambda c: F.count("*") if copies else F.count_distinct(c)
    often = lines.groupBy("__host", _key(F.col("__line")).alias("__key")).agg(number(F.col("__copy")).alias("__holds")).where(F.col("__holds") >= min_pages)
    often = common.cut(often, "lines")
    totals = pages.groupBy("__host").agg(F.count("*").alias("__pages"), number(_key(F.col("__text"))).alias("__of"))
    over = common.join_keyed(often, totals, ["__host"], "__pages").where(F.col("__holds") > max_ratio * F.col("__of"))
    return common.cut(over.groupBy("__host").agg(F.array_sort(F.collect_set("__key")).alias("__drop"), F.max("__pages").alias("__pages")), "hosts")


def cut_lines(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """docs with their boilerplate lines cut from ``text``, and the columns __n_lines and __n_dropped."""
    common.refuse(docs, "__n_lines", "__n_dropped")
    drop = boilerplate(docs, text, host, max_ratio, min_pages, copies)
    # The row goes along as one column, so its names can't clash with those used here.
    keyed = docs.select(common.packed(docs), _host(host).alias("__host"), F.split(F.col(text), "\n").alias("__lines"))
    marked = common.join_keyed(keyed, drop, ["__host"], "__pages", "left", weight=F.size("__drop") * 16)
    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter("__lines", lambda x: ~F.array_contains(F.col("__drop"), _key(x))))
    marked = marked.withColumn("__kept", kept)
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    columns = [F.array_join("__kept", "\n").alias(c) if c == text else F.col(f"__row.`{c}`") for c in docs.columns]
    return marked.select(*columns, size("__lines").alias("__n_lines"), (size("__lines") - size("__kept")).alias("__n_dropped"))


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: its lines, how many were cut, and the digest of what is left."""
    out = cut_lines(common.table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH page AS (
  SELECT row_number() OVER () AS r, doc_id, text, source FROM documents),
line AS (
  SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS at FROM page),
holds AS (
  SELECT source, line, count(DISTINCT r) AS pages FROM line WHERE trim(regexp_replace(line, '[\\t\\r\\f]', ' ', 'g')) <> '' GROUP BY 1, 2),
total AS (SELECT source, count(*) AS pages FROM page GROUP BY 1),
boilerplate AS (
  SELECT h.source, h.line FROM holds h JOIN total t ON h.source IS NOT DISTINCT FROM t.source
  WHERE h.pages >= {MIN_PAGES} AND h.pages > {MAX_RATIO} * t.pages),
kept AS (
  SELECT l.r, count(*) AS n_lines, count(b.line) AS n_dropped,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.at) FILTER (WHERE b.line IS NULL), '') AS rest
  FROM line l LEFT JOIN boilerplate b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line GROUP BY 1)
SELECT p.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped,
       sha256(coalesce(k.rest, '')) AS kept_sha256
FROM page p LEFT JOIN kept k ON p.r = k.r
"""
