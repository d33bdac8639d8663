"""Documents to chunks, chunks to a searchable index, queries to answers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom import schemas
from docloom.functions import text as X
from docloom.functions.segment import Guarded, Segmenter, by_language
from docloom.functions.vectors import assert_unit
from docloom.operators import encode, retrieve
from docloom.operators.chunks import (
    assert_sources, chunk_documents, chunking_errors, metadata_records, valid_documents,
)
from docloom.operators.compact import done_keys, pending
from docloom.operators.row_ids import with_row_id
from docloom.plans.isolate import isolated
from docloom.session import cut_lineage
from docloom.sources.index import load_index, write_index


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def build_chunks(
    spark: SparkSession, documents: str, out: str, restart: bool = False,
    segmenter: Segmenter = by_language, batches: int = 1, count_tokens=None,
) -> None:
    """Append the chunks of documents not chunked before.

    Done are documents with chunks and those listed as having none.  Documents are taken
    in ``batches`` by a hash of their id; a batch is one committed write, so a run that dies
    leaves a document with all its chunks or none, and the batches before it.  A restart
    copies what is there to a backup folder first.  ``count_tokens`` is that of ``chunk_documents``.

    A document on which the segmenter fails is listed in ``errors`` and tried again by the next run.
    A ``Guarded`` segmenter says so itself; a batch that any other one breaks is halved until the
    document is alone.
    """
    valid = valid_documents(spark.read.parquet(documents))
    chunks, empty, errors = f"{out}/chunks", f"{out}/empty", f"{out}/errors"
    if restart:
        kept = f"{out}/backup-{spark.sql('SELECT unix_millis(now())').first()[0]}"
        for name, path in (("chunks", chunks), ("empty", empty), ("errors", errors)):
            old = _existing(spark, path)
            if old is not None:
                old.write.parquet(f"{kept}/{name}")
                spark.createDataFrame([], old.schema).write.mode("overwrite").parquet(path)

    def healthy() -> None:
        spark.createDataFrame([], schemas.CHUNKS).write.mode("append").parquet(chunks)

    def failed(rows: DataFrame) -> None:
        rows.select("doc_id", "error", F.current_timestamp().alias("momento")).write.mode("append").parquet(errors)

    def work(part: DataFrame, tries: int) -> None:
        before = [t for t in (_existing(spark, chunks), _existing(spark, empty)) if t is not None]
        # Keys are compared, texts are not shuffled for it.
        ids = pending(part.select("doc_id"), done_keys(*before)) if before else part.select("doc_id")
        todo = part.join(ids, "doc_id", "left_semi") if before else part
        todo_ids = cut_lineage(ids)
        chunk_documents(todo, segmenter, count_tokens=count_tokens).drop("last").write.mode("append").parquet(chunks)
        without = cut_lineage(pending(todo_ids, spark.read.parquet(chunks)))
        if isinstance(segmenter, Guarded):
            # Only texts that gave no chunk are cut again, to tell failures from texts without any.
            wrong = cut_lineage(chunking_errors(part.join(without, "doc_id", "left_semi"), segmenter))
            failed(wrong)
            without = pending(without, wrong)
        without.write.mode("append").parquet(empty)

    def alone(rows: DataFrame, tries: int, error: Exception) -> None:
        failed(rows.select("doc_id").distinct().withColumn("error", X.error_detail(F.lit(str(error)))))

    isolated(valid, work, alone, healthy, batches)


def read_chunk_errors(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, error), the last one of every document that has still neither chunks nor the mark of having none."""
    found = _existing(spark, f"{folder}/errors")
    if found is None:
        return spark.createDataFrame([], "doc_id STRING, error STRING")
    done = [t for t in (_existing(spark, f"{folder}/{n}") for n in ("chunks", "empty")) if t is not None]
    left = pending(found, done_keys(*done)) if done else found
    return left.groupBy("doc_id").agg(F.max_by("error", "momento").alias("error"))


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/chunks")


def encode_chunks(
    spark: SparkSession, chunks: DataFrame, cache: str, encoder: encode.Encoder, force: bool = False, batches: int = 1
) -> None:
    """Add the vectors that the cache lacks, a committed write for each of ``batches`` by chunk id.

    ``force`` encodes again what this encoder has made; vectors of other encoders stay.
    """
    stored = _existing(spark, cache)
    if force and stored is not None:
        # The cache is partitioned by encoder: only this one's partition is replaced.
        nothing = spark.createDataFrame([], stored.schema).where("false")
        (
            encode.encode_missing(chunks, nothing, encoder).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("encoder_id").parquet(cache)
        )
        return
    for at in range(batches):
        part = chunks.where(F.pmod(F.xxhash64("chunk_id"), F.lit(batches)) == at)
        made = encode.encode_missing(part, _existing(spark, cache), encoder)
        made.write.mode("append").partitionBy("encoder_id").parquet(cache)


def build_index(
    spark: SparkSession, chunks: DataFrame, cache: str, out: str, encoder: encode.Encoder,
    force: bool = False, batches: int = 1,
) -> None:
    """Encode what the cache lacks, then write numbered vectors and metadata as a new version."""
    assert_sources(chunks)
    encode_chunks(spark, chunks, cache, encoder, force, batches)
    # Only keys are ordered; texts and vectors meet their number in a keyed join.
    keys = with_row_id(chunks.select("chunk_id", "doc_id", "posicion"), ["doc_id", "posicion"])
    numbers = keys.select("chunk_id", "row_id")
    own = spark.read.parquet(cache).where(F.col("encoder_id") == encoder.encoder_id)
    vectors = own.dropDuplicates(encode.CACHE_KEY)
    current = encode.with_cache_key(chunks, encoder).select(*encode.CACHE_KEY)
    index = current.join(assert_unit(vectors), encode.CACHE_KEY).join(numbers, "chunk_id")
    write_index(
        index.select(
            "row_id", "chunk_id", "encoder_id", F.col("vector").cast("array<float>").alias("vector")
        ),
        metadata_records(chunks).join(numbers, "chunk_id"),
        out,
    )


def answer_queries(
    spark: SparkSession, queries: DataFrame, folder: str, encoder: encode.Encoder,
    pool: int = V.POOL, text: str = "texto",
) -> DataFrame:
    """Nested answers of (query_id, text) rows from an index made by the same encoder."""
    index, metadata = load_index(spark, folder, encoder.encoder_id)
    vectors = cut_lineage(encode.encode_texts(queries, encoder, ["query_id"], text))
    return retrieve.answer(vectors, index, metadata, pool)


def search_queries(
    spark: SparkSession, queries: DataFrame, folder: str, encoder: encode.Encoder, k: int = 10,
    text: str = "texto",
) -> DataFrame:
    """Metadata of the ``k`` best chunks of every query."""
    index, metadata = load_index(spark, folder, encoder.encoder_id)
    vectors = cut_lineage(encode.encode_texts(queries, encoder, ["query_id"], text))
    return retrieve.search(vectors, index, metadata, k)
