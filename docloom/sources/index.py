"""The vector index as tables: ``vectors`` and ``metadata`` of a version, and a manifest that names it."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas


def alignment(index: DataFrame, metadata: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(vectors, records, unmatched): an index is sound when unmatched is 0."""
    sides = index.select(key, F.lit(1).alias("v"), F.lit(0).alias("m")).unionByName(
        metadata.select(key, F.lit(0).alias("v"), F.lit(1).alias("m"))
    )
    per_key = sides.groupBy(key).agg(F.sum("v").alias("v"), F.sum("m").alias("m"))
    return per_key.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("vectors"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("records"),
        F.count_if((F.col("v") != 1) | (F.col("m") != 1) | F.col(key).isNull()).alias("unmatched"),
    )


MANIFEST = "version STRING, vectors BIGINT, records BIGINT, encoder_id STRING, number BIGINT"
#: Rows of a metadata folder; the folder's number is ``row_range``.
ROWS_PER_RANGE = 1 << 16


def row_range(row_id: Column) -> Column:
    return F.floor(row_id / F.lit(ROWS_PER_RANGE)).cast("bigint")


def write_index(vectors: DataFrame, metadata: DataFrame, folder: str) -> None:
    """Both tables in a new version folder; the manifest that names it is written last.

    A run that fails leaves the version before in place.  Metadata with a ``row_id`` lies in folders of
    ROWS_PER_RANGE rows (column ``row_range``), sorted, so that the rows of an answer are read from
    the folders that hold them.
    """
    spark = vectors.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    vectors.write.parquet(f"{folder}/{version}/vectors")
    if "row_id" in metadata.columns:
        metadata = metadata.repartitionByRange("row_id").withColumn("row_range", row_range(F.col("row_id")))
        metadata.sortWithinPartitions("row_range", "row_id").write.partitionBy("row_range").parquet(f"{folder}/{version}/metadata")
    else:
        metadata.write.parquet(f"{folder}/{version}/metadata")
    index, records = (spark.read.parquet(f"{folder}/{version}/{t}") for t in ("vectors", "metadata"))
    found = _aligned(index, records)
    encoders = [r.encoder_id for r in index.select("encoder_id").distinct().limit(2).collect()]
    if len(encoders) > 1:
        raise ValueError(f"vectors of several encoders: {', '.join(encoders)}")
    last = _manifest(spark, folder)
    number = (last.number or 0) + 1 if last else 1
    row = (version, found.vectors, found.records, encoders[0] if encoders else None, number)
    # One more file, so a crash leaves the manifests before it.
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")


def _manifest(spark: SparkSession, folder: str):
    """The manifest with the highest number; there is one row for each version."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException:
        return None
    return rows.orderBy(F.col("number").desc_nulls_last()).first()


def _aligned(index: DataFrame, metadata: DataFrame):
    found = alignment(index, metadata).first()
    if found.unmatched:
        raise ValueError(
            f"index and metadata differ: {found.vectors} vectors, {found.records} records, "
            f"{found.unmatched} keys without exactly one of each"
        )
    return found


def load_index(
    spark: SparkSession, folder: str, encoder_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(vectors, metadata) of the newest version, after checking the encoder.

    Keys were compared when the version was written; here row counts are, which the files'
    footers hold.  A folder without a manifest is checked in full.
    """
    manifest = _manifest(spark, folder)
    at = f"{folder}/{manifest.version}" if manifest else folder
    index = spark.read.schema(schemas.INDEX).parquet(f"{at}/vectors")
    metadata = spark.read.parquet(f"{at}/metadata")
    if manifest is None:
        _aligned(index, metadata)
        first = index.select("encoder_id").filter(F.col("encoder_id") != F.lit(encoder_id)).first() if encoder_id else None
        made_by = first.encoder_id if first else encoder_id
    else:
        counts = index.count(), metadata.count()
        if counts != (manifest.vectors, manifest.records):
            raise ValueError(f"index and metadata differ from the manifest: {counts[0]} vectors, {counts[1]} records")
        made_by = manifest.encoder_id
    if encoder_id is not None and made_by not in (None, encoder_id):
        raise ValueError(f"index was made by {made_by}, not by {encoder_id}")
    return index, metadata


def export_metadata(metadata: DataFrame, path: str) -> None:
    """JSON lines in row order, NULL fields left out."""
    ordered = metadata.orderBy("row_id") if "row_id" in metadata.columns else metadata
    ordered.drop("row_id", "row_range").write.mode("overwrite").option("ignoreNullFields", "true").json(path)
