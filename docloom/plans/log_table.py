"""The compacted log: one row a document, in buckets, of which a run rewrites only those it touched.

The log itself only grows.  ``compact`` takes the rows written since the last compaction, finds the
buckets of their keys, and merges them with what those buckets hold; nothing else is read or
written.  How far a table is compacted stands in a file beside its rows, written last: when that is
missing, or is not the point the run started from (a run died between), everything is compacted anew
from the log.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.compact import latest_wins

#: Folder column of the compacted table.
BUCKET = "cubo"
#: A table is made with a bucket for so many rows of the log, within these bounds; it keeps their number
#: until the log has grown fourfold, when everything is compacted anew.
ROWS_PER_BUCKET, FEWEST, MOST = 100_000, 16, 4096
#: Names that start with an underscore are no rows to Spark.
_MARK = "_compactado"


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _mark(spark: SparkSession, out: str) -> tuple[int, int] | None:
    """(last sequence number compacted, number of buckets), if that is known."""
    try:
        found = spark.read.schema("seq BIGINT, buckets INT").json(f"{out}/{_MARK}").first()
    except AnalysisException:
        return None
    return (found.seq, found.buckets) if found and found.seq is not None else None


def _write(rows: DataFrame, out: str, buckets: int, mode: str, key: str) -> None:
    # Rows of a bucket meet, and are split again by size: few files, and no task with too much.
    dealt = rows.withColumn(BUCKET, bucket(key, buckets)).hint("rebalance", F.col(BUCKET))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "snappy").partitionBy(
        BUCKET
    ).parquet(out)


def compact(
    spark: SparkSession, log: DataFrame, out: str, columns: list[str], since: int,
    key: str = "doc_id", seq: str = "seq", buckets: int | None = None,
) -> int | None:
    """Latest row of every key of ``log`` at ``out``; the number of buckets rewritten, None if it was all of them.

    ``since`` is the last sequence number of the log before this run.  Row groups of older
    log files are skipped by their statistics.
    """
    at = _mark(spark, out)
    last, size = log.agg(F.coalesce(F.max(seq), F.lit(0)), F.count("*")).first()
    wanted = buckets or min(MOST, max(FEWEST, -(-size // ROWS_PER_BUCKET)))
    if at is None or at[0] != since or wanted > 4 * at[1]:
        touched, buckets = None, wanted
        _write(latest_wins(log, key, seq).select(*columns), out, buckets, "static", key)
    else:
        buckets = at[1]
        fresh = log.where(F.col(seq) > since)
        # At most ``buckets`` numbers.
        touched = [r[0] for r in fresh.select(bucket(key, buckets)).distinct().collect()]
        if touched:
            old = spark.read.parquet(out).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            # What is stored is older than any new row of its key.
            both = old.withColumn(seq, F.lit(since).cast("bigint")).unionByName(fresh.select(*columns, seq))
            _write(latest_wins(both, key, seq).select(*columns), out, buckets, "dynamic", key)
    spark.createDataFrame([(last, buckets)], "seq BIGINT, buckets INT").coalesce(1).write.mode("overwrite").json(
        f"{out}/{_MARK}"
    )
    return None if touched is None else len(touched)


def read(spark: SparkSession, out: str) -> DataFrame:
    """The compacted table without its folder column."""
    return spark.read.parquet(out).drop(BUCKET)
