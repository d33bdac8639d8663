"""Dense row numbers over a total order, without a single-task sort.

Rows are range partitioned, numbered inside their partition and shifted by the
sizes of the partitions before; only those sizes meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import cut_lineage

_IN_PARTITION = (1 << 33) - 1


def with_row_id(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... in ``order``, which must be total.

    The ranged rows are checkpointed: both the sizes and the numbers must come
    from the same partitioning, also after an executor is lost.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut_lineage(
        ranged.withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftrightunsigned("_mid", 33))
        .withColumn("_nth", F.col("_mid").bitwiseAND(_IN_PARTITION))
        .drop("_mid")
    )
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the range exchange, so always small.
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_nth"))
        .drop("_part", "_nth", "_offset")
    )
