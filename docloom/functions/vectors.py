"""Column expressions over ARRAY<FLOAT> vectors, accumulated in double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions.text import StrCol, col


def norm(vector: StrCol) -> Column:
    square = F.aggregate(
        col(vector), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    return F.sqrt(square)


def is_unit(vector: StrCol) -> Column:
    """Unit norm within tolerance; NaN is not."""
    return F.coalesce(F.abs(norm(vector) - 1) < V.UNIT_TOLERANCE, F.lit(False))


def unit_norm_report(rows: DataFrame, vector: str = "vector") -> DataFrame:
    """(ok, n, dims): whether all rows are unit vectors; an empty table is."""
    return rows.agg(
        F.coalesce(F.bool_and(is_unit(vector)), F.lit(True)).alias("ok"),
        F.count("*").alias("n"),
        F.count_distinct(F.size(vector)).alias("dims"),
    )


def assert_unit(rows: DataFrame, vector: str = "vector") -> DataFrame:
    """Fail the job at the first vector that is not of unit norm."""
    bad = F.raise_error(F.lit("vectors must have unit norm")).cast("array<float>")
    return rows.withColumn(vector, F.when(is_unit(vector), F.col(vector)).otherwise(bad))
