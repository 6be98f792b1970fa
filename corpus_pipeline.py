"""From raw documents to packed training sequences.

Each stage takes what the one before kept, as a table, and decides on all of it: documents in no
known language go, one document of each near-duplicate group stays, passages that repeat
between documents are cut out, secrets are masked, and what is left is packed. All stages but the
last return the columns of ``documents``; ``lang`` is the language found, ``n_chars`` follows
the text. A document stays even if a stage leaves no text of it, except where it is rejected.

Defined cases: a null or empty text has no letters, so the first stage rejects it; later stages
leave such texts as they are. Null or repeated ids, rows in full again and null values of other
columns are kept as rows of their own, unless near duplicates. Further columns of any name go
through unchanged. An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import langid, minhash, packing, secrets, suffixes
from tidemark.llm.common import numbered, table, written
from tidemark.session import scratch_path

MIN_SCORE = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _apart(stage: Stage) -> Stage:
    """``stage`` with further columns out of the way of the operators' own names."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        inner = [c if c in COLUMNS else f"further_{i}" for i, c in enumerate(names)]
        return stage(spark, docs.toDF(*inner), sf_dir).toDF(*names)

    return run


def _with(docs: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """``columns`` of ``docs`` with some replaced, in their types."""
    kinds = dict(docs.dtypes)
    return docs.select(*(new[c].cast(kinds[c]).alias(c) if c in new else F.col(c) for c in columns))


@_apart
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose best language is no better than a guess, go."""
    found = langid.identify(docs, langid.train(docs))
    kept = found.where((F.col("_lang") != langid.UNKNOWN) & (F.col("_score") >= MIN_SCORE))
    return _with(kept, docs.columns, lang=F.col("_lang"))


@_apart
def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group stays."""
    rows = numbered(docs)
    judged = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("row"))
    return rows.join(gone.hint("shuffle_hash"), "row", "left_anti").select(*docs.columns)


@_apart
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that stand anywhere else too are cut out of every document."""
    rows = numbered(docs)
    # Only spans are joined, so that all texts cross one shuffle and repeated ones no other with it.
    starts, _ = suffixes.repeated_starts(rows)
    gone = written(suffixes.spans(starts).withColumnRenamed("spans", "_spans"), "removed-spans")
    found = rows.join(gone, "row", "left")
    found = found.withColumn("_kept", suffixes.as_text(suffixes.cut(F.col("text"), F.col("_spans"))))
    text = F.coalesce("_kept", "text")
    return _with(found, docs.columns, text=text, n_chars=F.length(text))


@_apart
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to the name of their kind."""
    found = secrets.scan(docs)
    found = found.withColumn("_masked", F.when(F.col("text").isNotNull(), secrets.redact(F.col("_text"), F.col("_spans"))))
    return _with(found, docs.columns, text=F.col("_masked"), n_chars=F.length("_masked"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each packed sequence, with the pieces of documents in it."""
    return packing.bins(packing.pack(packing.lengths(docs)))


STAGES = [
    ("language_id", language_id),
    ("minhash_dedup", minhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# Naive Bayes, MinHash and packing are no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
