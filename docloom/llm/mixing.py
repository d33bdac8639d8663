"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed hash.  A source's budget is met by the documents whose hash
lies below a threshold, so nothing is sorted, runs agree, and a smaller budget takes a
subset of a larger one's documents.  The threshold is found digit by digit: sizes are
summed by source and hash bucket, the bucket in which the sum passes the budget is the
boundary, and only the boundary bucket's documents are summed again by the next digit.
Each sum is combined before the shuffle and ends in a table of sources times buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut_lineage, read

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: The hash has LEVELS digits of DIGIT_BITS bits.
LEVELS, DIGIT_BITS = 3, 12
HASH_BITS = LEVELS * DIGIT_BITS
#: A table of sources is sent to the tasks up to this many rows of about 64 bytes; beyond, it is joined by key.
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def document_hash(doc_id: Column) -> Column:
    """The first HASH_BITS bits of an MD5, as a number."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``totals`` (source, source_size) with ``target``: shares of the whole by weight, under caps.

    Giving what is above a cap to the others by weight, until none is above, ends at one
    level: everyone gets level * weight or its cap.  With sources in order of
    cap / weight those at their cap come first, and the level follows from running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(float(w)) for w in weights])
    named = totals.withColumn("_at", F.row_number().over(by_name)).withColumn(
        "_weight", F.get(choices, ((F.col("_at") - 1) % len(weights)).cast("int"))
    )
    named = named.withColumn("_cap", F.col("source_size") * float(most))
    filled = Window.orderBy((F.col("_cap") / F.col("_weight")), "_at")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    here_on = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = named.select(
        "source", "source_size", "_at", "_weight", "_cap",
        (
            (F.sum(F.col("source_size").cast("double")).over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            / F.sum("_weight").over(here_on)
        ).alias("_level"),
    )
    levels = levels.withColumn("_full", F.col("_cap") / F.col("_weight") <= F.col("_level"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_weight"), "_at", "_level"))).over(all_rows)
    return levels.withColumn("_first", level).select(
        "source", "source_size",
        F.when(F.col("_full"), F.col("_cap"))
        .otherwise(F.col("_first")["_level"] * F.col("_weight")).alias("target"),
    )


def _small(sources: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(sources) if rows <= BROADCAST_SOURCES else sources


def _boundary(summed: DataFrame, state: DataFrame, rows: int) -> DataFrame:
    """State with one more digit: the first bucket whose running sum passes the budget."""
    order = Window.partitionBy("_key").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = (
        summed.join(_small(state, rows), "_key")
        .withColumn("_upto", F.col("_base") + F.sum("_sum").over(order))
        .where(F.col("_upto") > F.col("_budget"))
    )
    first = running.groupBy("_key").agg(F.min(F.struct("_digit", "_upto", "_sum")).alias("_b"))
    return (
        state.join(first, "_key", "left")
        .withColumn("_open", F.col("_open") & F.col("_b").isNotNull())
        .withColumn(
            "_prefix",
            F.when(F.col("_open"), F.shiftleft("_prefix", DIGIT_BITS) + F.col("_b")["_digit"]).otherwise(F.col("_prefix")),
        )
        .withColumn("_base", F.when(F.col("_open"), F.col("_b")["_upto"] - F.col("_b")["_sum"]).otherwise(F.col("_base")))
        .drop("_b")
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row.

    Size is the number of words, 0 for a null text.  Sources in code point order, null as
    a source of its own and last, have ``weights`` in turn and share the sum of all sizes;
    a target is at most ``most`` times its source's size, and what is above goes to the
    others by weight.  All documents are taken floor(target / source_size) times,
    and those with the smallest hashes of their doc_id once more, as long as the sum of
    their sizes stays within the rest; ``taken`` is copies * size.  Documents with one
    hash (a repeated or null doc_id) are taken together or not.  A source without words
    has target 0 and takes nothing.  Other columns are ignored.
    """
    name = F.col(source).cast("string")
    rows = cut_lineage(
        docs.select(
            F.col(doc_id).alias("doc_id"), name.alias("source"),
            # A key that is never null: null sources join as any other.
            F.coalesce(F.concat(F.lit("s"), name), F.lit("")).alias("_key"),
            words(F.col(text)).alias("size"), document_hash(F.col(doc_id)).alias("_hash"),
        )
    )
    shift = HASH_BITS - DIGIT_BITS
    top = cut_lineage(
        rows.groupBy("_key", "source", F.shiftright("_hash", shift).alias("_digit")).agg(F.sum("size").alias("_sum"))
    )
    totals = top.groupBy("_key", "source").agg(F.sum("_sum").alias("source_size"))
    targets = source_targets(totals, weights, most).withColumn(
        "_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    )
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = cut_lineage(
        targets.withColumn("_full", full.cast("bigint")).withColumn(
            "_budget", F.col("target") - F.col("_full") * F.col("source_size")
        )
    )
    n = targets.count()
    state = targets.select(
        "_key", "_budget", F.lit(True).alias("_open"), F.lit(0).cast("bigint").alias("_prefix"),
        F.lit(0).cast("bigint").alias("_base"),
    )
    state = cut_lineage(_boundary(top.select("_key", "_digit", "_sum"), state, n))
    for _ in range(1, LEVELS):
        shift -= DIGIT_BITS
        open_now = state.where("_open").select("_key", "_prefix")
        inside = rows.join(_small(open_now, n), "_key").where(
            F.shiftright("_hash", shift + DIGIT_BITS) == F.col("_prefix")
        )
        summed = inside.groupBy(
            "_key", F.shiftright("_hash", shift).bitwiseAND((1 << DIGIT_BITS) - 1).alias("_digit")
        ).agg(F.sum("size").alias("_sum"))
        state = cut_lineage(_boundary(summed, state, n))
    limit = F.when(F.col("_open"), F.col("_prefix")).otherwise(F.lit(1 << HASH_BITS))
    limits = targets.drop("source").join(state.select("_key", limit.alias("_limit")), "_key")
    # Only texts without words fit a budget of nothing: they too are taken ``most`` times at the most.
    copies = F.least(F.col("_full") + F.when(F.col("_hash") < F.col("_limit"), 1).otherwise(0), F.lit(most))
    return rows.join(_small(limits, n), "_key").select(
        "doc_id", "source", "size", "source_size", "target",
        copies.cast("bigint").alias("copies"), (copies * F.col("size")).cast("bigint").alias("taken"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = """
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
      lambda x: x <> ''))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s),
c AS (SELECT *, (1 + (rn - 1) % 3)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM w),
l AS (
  SELECT *, cap / weight AS ratio, ((SELECT sum(source_size) FROM s)::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
t AS (
  SELECT source, source_size, CASE WHEN ratio <= level THEN cap
    ELSE weight * (SELECT level FROM l WHERE ratio > level ORDER BY ratio, rn LIMIT 1) END AS target FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS full_copies FROM t),
x AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.full_copies,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (full_copies * size + CASE WHEN upto <= target - full_copies * source_size THEN size ELSE 0 END)::BIGINT AS taken
FROM x
"""
