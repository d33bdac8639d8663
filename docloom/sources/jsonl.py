"""JSON lines: read with a declared schema, torn and foreign lines dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docloom.functions import text as X
from docloom.operators.row_ids import with_row_id


def parse_lines(lines: DataFrame, schema: StructType, key: str = "doc_id", value: str = "value") -> DataFrame:
    """Rows of the lines that hold an object with ``key``; other columns are kept."""
    rest = [c for c in lines.columns if c != value]
    parsed = lines.filter(~X.is_blank(value)).select(
        *rest,
        F.try_parse_json(value).isNotNull().alias("_whole"),
        F.from_json(value, schema).alias("_row"),
    )
    return parsed.filter(F.col("_whole") & F.col(f"_row.{key}").isNotNull()).select(*rest, "_row.*")


def read_jsonl(spark: SparkSession, path: str, schema: StructType, key: str = "doc_id") -> DataFrame:
    """Rows in ``schema`` with ``seq``: 0, 1, 2 ... by file name and place in the file.

    Spark reads the largest splits first, so the order of a scan says nothing; file and
    offset do.  Logs are named so that later ones sort last.
    """
    place = ["_file", "_block", "_line"]
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return with_row_id(parse_lines(lines, schema, key), place, "seq").drop(*place)
