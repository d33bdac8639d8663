"""Helpers shared by the operators: shared folder, columns computed once, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import checkpoint_dir, cut_lineage

__all__ = ["checkpoint_dir", "components", "cut_lineage", "once", "prefix_sums", "read", "shared_path"]

EDGES_PER_PARTITION = 250_000
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def once(df: DataFrame, keep: list[str | Column], **new: Column) -> DataFrame:
    """``keep`` and ``new`` as columns that later expressions read but do not compute again.

    Spark merges neighbouring projections and so repeats an expression wherever its
    column is used; a generator stands between them.
    """
    kept = df.select(*keep).columns
    packed = F.struct(*[c.alias(n) for n, c in new.items()])
    wide = df.select(*keep, F.explode_outer(F.array(packed)).alias("_once"))
    return wide.select(*kept, *[F.col("_once").getField(n).alias(n) for n in new])


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Sums of all earlier elements, one for each element of an array of numbers.

    A fold copies its state at each step, so it runs over blocks: first over the
    sums of the blocks, then inside each.
    """

    def running(items: Column, first: Column) -> Column:
        end = F.aggregate(
            items, F.array(first), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        )
        return F.slice(end, F.lit(1), F.size(end) - 1)

    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(block))
    zero = F.lit(0).cast("bigint")
    sums = F.transform(
        starts, lambda s: F.aggregate(F.slice(lengths, s, F.lit(block)), zero, lambda a, x: a + x)
    )
    blocks = F.arrays_zip(starts.alias("s"), running(sums, zero).alias("first"))
    several = F.flatten(
        F.transform(blocks, lambda b: running(F.slice(lengths, b["s"], F.lit(block)), b["first"]))
    )
    return F.when(F.size(lengths) <= block, running(lengths, zero)).otherwise(several)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over the edges, for every id that has one.

    Alternating large-star and small-star rounds: every id's neighbours are hung on
    its smallest one until nothing changes.  A round is an aggregate that is combined
    before the shuffle and a join that Spark can split, so a star of any size is no
    hot group; the edges never grow and are written to the shared folder each round.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = cut_lineage(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    # Edges never grow: a round's table needs no more partitions than these rows fill.
    parts = max(1, -(-pairs.count() // EDGES_PER_PARTITION))
    pairs = pairs.coalesce(parts)
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        rest = low.select("u", F.col("m").alias("v")).where("u > v")
        large = cut_lineage(large.unionAll(rest).distinct().coalesce(parts))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut_lineage(
            hung.unionAll(low.select("u", F.col("m").alias("v"))).distinct().coalesce(parts)
        )
        now = tuple(
            pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )
        if now == before:
            break
        before = now
    top = pairs.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(top)
