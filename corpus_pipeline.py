"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of documents.
``run`` writes each stage's result into the shared folder as Parquet and reads it again as the next one's docs.

- language: rows whose language isn't told from text, declaration and host with confidence go (so do texts without any
  trigram). The text model learns from the declared languages of the rows at hand.
- lines: boilerplate lines of a source are cut, where copies of a text count once, so that near_duplicates has one to
  keep; a document stays even if nothing of it is left.
- near_duplicates: of each group of near copies (five words, similarity 0.8) the row with the smallest id stays; rows
  that share that id and its group all stay.
- benchmark: the spans that hold benchmark windows are cut from the text; the document stays.
- tokens: the byte-level BPE ids of what is left.

Where a text changes, n_chars follows. Stages keep null texts as null, and tables with further columns keep those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.llm import byte_bpe, common, decontaminate, language, line_dedup, near_dedup


def _retext(docs: DataFrame, text) -> DataFrame:
    """docs with a new text, and n_chars after it."""
    new = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return docs.withColumns(new)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return language.documents(docs).where("__accepted").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.cut_lines(docs, copies=False)
    return _retext(cut, F.col("text")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marks = near_dedup.mark(docs)
    # Ids that go are all of a group but one; rows without an id stay. They grow with the corpus, so they are merged at any size.
    gone = marks.where(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    found = decontaminate.annotate(docs, common.table(spark, sf_dir, "benchmark"))
    return _retext(found, F.col("__clean")).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    out = byte_bpe.encode(docs.select("doc_id", "text"), *byte_bpe.vocabulary())
    return out.select("doc_id", F.col("__n_tokens").alias("n_tokens"), F.col("__ids").alias("ids"))


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]
#: The search by FM-index, the components and the tokens can't be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = common.cut(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
