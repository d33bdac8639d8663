"""The training-data pipeline: documents through five operators, each stage on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``.  Between stages the rows are written as Parquet in the shared folder
and read again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm import decontaminate, language_id, line_dedup, minhash_dedup, mixing
from docloom.llm.common import read, shared_path


def _beside(docs: DataFrame) -> tuple[DataFrame, list]:
    """``docs`` under an alias, with its columns by name: decisions joined to it can have any names."""
    own = docs.alias("_docs")
    return own, [F.col(f"_docs.`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the texts that no language's model accepts, null texts among them; ``lang`` is left as it is.

    Where no row has a label to learn from, nothing can be judged: a warning is given and all rows stay.
    """
    model = language_id.fit(docs)
    if not model.languages:
        warnings.warn("no labelled text to learn a language from: all documents stay", stacklevel=2)
        return docs
    judge = language_id.detector(spark, model)
    return docs.where(~judge(F.col("text").cast("string"))["rejected"])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``text`` without the lines that many documents share, ``n_chars`` counted again.

    Texts that lose nothing are left as they are.
    """
    return line_dedup.rewrite(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; of rows that repeat an id the first.

    First in the order of all columns, so reruns agree.  Rows without an id stay.
    """
    found = minhash_dedup.near_duplicates(docs)
    kept = found.where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    own, columns = _beside(docs)
    named = own.join(kept, F.col("_docs.doc_id") == F.col("_kept_id"), "left_semi").select(*columns)
    # A limit of one row a group: Spark drops the others of an id before the shuffle as well.
    order = Window.partitionBy("doc_id").orderBy(*[F.col(f"`{c}`") for c in docs.columns])
    first = named.withColumn("_first_of_id", F.row_number().over(order)).where("_first_of_id = 1").drop("_first_of_id")
    return first.unionAll(docs.where(F.col("doc_id").isNull()))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    found = decontaminate.contained_items(docs, read(spark, sf_dir, "benchmark"))
    leaks = found.select(F.col("doc_id").alias("_leak_id")).distinct()
    own, columns = _beside(docs)
    return own.join(leaks, F.col("_docs.doc_id") == F.col("_leak_id"), "left_anti").select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken, with its number ``copy`` from 1, the source's
    target and the words of one copy.  Columns of ``docs`` that have the names of the added ones give way.
    """
    mixed = mixing.mix(docs).where("copies > 0").select(
        F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), "size", "target", "copies"
    ).distinct()
    added = {"mix_words", "mix_target", "mix_copy"}
    own, columns = _beside(docs.drop(*added))
    met = own.join(
        mixed,
        F.col("_docs.doc_id").eqNullSafe(F.col("_mix_id"))
        & F.col("_docs.source").eqNullSafe(F.col("_mix_source"))
        & (mixing.words(F.col("_docs.text")) == F.col("size")),
    )
    return met.select(
        *columns, F.col("size").alias("mix_words"), F.col("target").alias("mix_target"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("mix_copy"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
]

#: SQL cannot express the language model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
