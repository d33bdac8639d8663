"""CSV files of a known dialect, read by Spark's splittable reader.

The inventory's decoder looks at each file by itself; this is the way for folders of files
that share header, delimiter and encoding, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as X
from docloom.operators.pages import ordered_text
from docloom.operators.row_ids import with_row_id


_RECORD = "_record"


def _cells(record: Column, delimiter: str) -> Column:
    """Cells of a raw record: delimiters outside quotes, and one."""
    plain = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(delimiter), F.lit(""))) + 1


def csv_rows(
    spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8", schema: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Rows as text with ``_file`` and ``_pos``, their order over all files by name and place.

    Rows longer than the header are left out, shorter ones are filled up with NULL.  Without line breaks in
    cells a file is split among tasks.
    """
    reader = spark.read.option("header", True).option("sep", delimiter).option("encoding", encoding)
    # A quote inside a quoted cell is doubled.
    reader = reader.option("escape", '"').option("multiLine", multi_line).option("inferSchema", False)
    if schema is None:
        schema = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in reader.csv(path).schema)
    # A record of another length than the header is kept as it stands; all its cells are needed to tell, so none is pruned.
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False)
    rows = reader.schema(f"{schema}, {_RECORD} STRING").csv(path)
    cells = _cells(F.col(_RECORD), delimiter)
    rows = rows.where(F.col(_RECORD).isNull() | (cells <= len(rows.columns) - 1)).drop(_RECORD)
    place = ["_file", "_block", "_line"]
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return with_row_id(placed, place, "_pos").drop("_block", "_line")


def csv_documents(rows: DataFrame, doc_id: Column) -> DataFrame:
    """(doc_id, texto, filas_totales): a document for each key, its rows as ``column: value | ...`` lines."""
    columns = [c for c in rows.columns if not c.startswith("_")]
    named = rows.select(doc_id.alias("doc_id"), "_pos", X.row_text(columns).alias("_text"))
    counts = named.groupBy("doc_id").agg(F.count("*").alias("filas_totales"))
    texts = ordered_text(named.where(F.col("_text") != ""), "doc_id", "_pos", "_text", "\n")
    return counts.join(texts, "doc_id", "left").select(
        "doc_id", F.coalesce("texto", F.lit("")).alias("texto"), "filas_totales"
    )
