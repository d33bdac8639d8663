"""Incremental chunking with Structured Streaming.

A file source lists new document files, an append sink commits chunks exactly once,
and the checkpoint remembers both.  Stopping at any moment loses nothing; a torn
output is never visible because the sink lists files only after their commit.
Cross-file deduplication of tile features is not here on purpose: its result
depends on path order and not on arrival order, so it is recomputed in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docloom import schemas
from docloom.functions.segment import Segmenter, by_language
from docloom.operators.chunks import chunk_documents, valid_documents
from docloom.sources.jsonl import parse_lines


def document_stream(
    spark: SparkSession, folder: str, schema: StructType = schemas.DOCUMENTS,
    files_per_trigger: int = 1000, pattern: str = "*.parquet",
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def line_stream(
    spark: SparkSession, folder: str, schema: StructType = schemas.DOCUMENTS,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Documents from JSON lines; torn lines are dropped."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return parse_lines(lines, schema)


def chunk_stream(documents: DataFrame, segmenter: Segmenter = by_language) -> DataFrame:
    """Chunks of a document stream; stateless, so the batch operator is used as it is."""
    return chunk_documents(valid_documents(documents), segmenter)


def append_available(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write everything that has arrived and stop; call again to go on from there."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
