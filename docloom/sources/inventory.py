"""The inventory of files: the source of document ids, and their routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.operators.compact import stratified_head
from docloom.operators.row_ids import with_row_id

# Columns an inventory must have, in the names it is delivered with.
COLUMNS = (
    "DOC_ID", "Carpeta", "Nombre estandarizado", "Tipo", "Fenómeno", "Observatorio",
    "Código Observatorio",
)


def read_inventory(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Inventory rows with their position, from a CSV, Parquet or XLSX file.

    Of a workbook the sheet of that name is taken, without a name the first.
    """
    if path.lower().endswith((".xlsx", ".xls")):
        from docloom.sources.decoders import xlsx_inventory

        return xlsx_inventory(spark, path, sheet)
    if path.lower().endswith(".csv"):
        rows = spark.read.csv(path, header=True, inferSchema=False)
    else:
        rows = spark.read.parquet(path)
    if "pos" in rows.columns:
        return rows
    place = ["_file", "_block", "_line"]
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return with_row_id(placed, place, "pos").drop(*place)


def inventory(
    rows: DataFrame, root: str = "", types: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Normalised inventory, optionally of some file types or a stratified sample."""
    if types:
        rows = rows.filter(F.col("Tipo").isin(*types))
    if limit:
        rows = stratified_head(rows, "Tipo", "pos", limit)
    name = F.col("Nombre estandarizado").cast("string")
    path = F.concat(F.rtrim(F.col("Carpeta").cast("string"), F.lit("/")), F.lit("/"), name)
    prefix = F.lit(root.rstrip("/") + "/" if root else "")
    return rows.select(
        F.col("pos").cast("bigint").alias("pos"),
        F.col("DOC_ID").cast("string").alias("doc_id"),
        name.alias("fuente"),
        path.alias("ruta_relativa"),
        F.concat(prefix, path).alias("ruta_absoluta"),
        F.col("Tipo").cast("string").alias("tipo_adl"),
        X.phenomenon(F.col("Fenómeno").cast("string")).alias("fenomeno"),
        F.col("Observatorio").cast("string").alias("observatorio"),
        F.col("Código Observatorio").cast("string").alias("codigo_observatorio"),
    )


def reader(kind: Column | str, path: Column | str) -> Column:
    """Which reader takes a file, by inventory type or extension, in this order."""
    kind, ext = X.col(kind), X.extension(path)
    routes = (
        ("pdf", (kind == "PDF") | (ext == "pdf")),
        ("json", (kind == "JSON") | (ext == "json")),
        ("csv", (kind == "CSV") | (ext == "csv")),
        ("xlsx", (kind == "Excel") | ext.isin("xlsx", "xls")),
        ("txt", (kind == "Texto") | (ext == "txt")),
        ("image", ext.isin(*V.IMAGE_EXTENSIONS)),
        ("pbf", ext == "pbf"),
    )
    out = F.lit("unsupported")
    for name, test in reversed(routes):
        out = F.when(F.coalesce(test, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def is_tile(path: Column | str) -> Column:
    return F.lower(X.col(path)).endswith(".pbf")
