"""Registered queries: a DataFrame over the given tables and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The ``documents`` table under the names of the document schema."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("source").alias("fuente"),
        F.lit("txt").alias("formato"),
        F.col("lang").alias("idioma"),
        F.col("text").alias("texto"),
        F.lit("ok").alias("estado"),
    )


def as_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` read as pages: a source is a document, a row a page of it."""
    return table(spark, folder, "documents").select(
        F.col("source").alias("doc_id"), F.col("doc_id").alias("page"), F.col("text").alias("texto")
    )
