"""Ranked documents and fragments for a table of queries.

All queries are answered by one set-based job.  Search touches only ids and
vectors; chunk texts are fetched for the pooled rows alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.functions.segment import Segmenter, by_language
from docloom.operators.chunks import fragment_chunks
from docloom.operators.compact import first_per_group
from docloom.operators.search import MAX_QUERY_BYTES, top_k
from docloom.session import cut_lineage
from docloom.sources.index import row_range

# A pool of this many rows is a few tens of megabytes and safe to broadcast.
_BROADCAST_POOL = 500_000
#: A table, or what makes the rows of it that ranked rows (query_id, rank, row_id, score), at most so many, need.
Metadata = DataFrame | Callable[[DataFrame, int], DataFrame]
#: Folders that a read of metadata names one by one; a pool in more of them reads most of the table anyway.
MAX_RANGES = 10_000


def rank_documents(pool: DataFrame, n: int = V.TOP_DOCUMENTS) -> DataFrame:
    """(query_id, rank, doc_id, score): the best documents of each query's pool.

    A document scores as its best chunk; equal scores keep the order of the chunks.
    """
    best = pool.groupBy("query_id", "doc_id").agg(
        F.max("score").alias("score"), F.min("rank").alias("_first")
    )
    order = [F.col("score").desc(), F.col("_first")]
    return first_per_group(best, ["query_id"], order, n, "rank").select(
        "query_id", "rank", "doc_id", "score"
    )


def rank_fragments(
    pool: DataFrame, n: int = V.TOP_FRAGMENTS, segmenter: Segmenter = by_language
) -> DataFrame:
    """(query_id, rank, chunk_id, doc_id, text): fragments in chunk order, the first ``n``.

    ``pool`` has chunk texts and, if they were recorded, languages.  Every chunk
    gives a fragment, so chunks after the ``n``-th cannot reach the answer.
    """
    columns = [c for c in ("query_id", "rank", "chunk_id", "doc_id", "texto", "idioma")
               if c in pool.columns]
    near = pool.filter(F.col("rank") <= n).select(*columns).withColumnRenamed("rank", "_chunk_rank")
    cut = fragment_chunks(near, segmenter)
    order = [F.col("_chunk_rank"), F.col("frag_pos")]
    return first_per_group(cut, ["query_id"], order, n, "rank").select(
        "query_id", "rank", "chunk_id", "doc_id", "text"
    )


def few(rows: DataFrame, n: int | None) -> DataFrame:
    """At most ``n`` rows, marked for a broadcast where that is safe."""
    return F.broadcast(rows) if n is not None and n <= _BROADCAST_POOL else rows


def with_metadata(ranked: DataFrame, metadata: DataFrame, key: str, rows: int | None) -> DataFrame:
    """Join the few ranked rows to their metadata, from the small side when it is.

    Metadata in folders by ``row_range`` is read from the folders of the ranked rows alone, as long as
    they are at most MAX_RANGES; ``ranked`` should be materialised for that.
    """
    small = few(ranked, rows)
    if key != "row_id" or "row_range" not in metadata.columns:
        return metadata.join(small, key)
    wanted = ranked.select(row_range(F.col("row_id")).alias("r")).where("r is not null").distinct()
    ranges = sorted(r.r for r in wanted.limit(MAX_RANGES + 1).collect())
    if len(ranges) <= MAX_RANGES:
        metadata = metadata.where(F.col("row_range").isin(ranges))
    return metadata.drop("row_range").join(small, key)


def search(
    queries: DataFrame, index: DataFrame, metadata: Metadata, k: int = 10,
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """Metadata of the ``k`` best chunks of every query, with ``rank`` and ``score``.

    Metadata with a ``row_id`` is joined directly; otherwise the index gives chunk ids.
    """
    ranked = top_k(queries, index, k, max_query_bytes=max_query_bytes)
    rows = queries.count() * k
    if callable(metadata):
        # Read for its metadata and for the join.
        ranked = cut_lineage(ranked)
        metadata = metadata(ranked, rows)
    if "row_id" not in metadata.columns:
        keys = index.select("row_id", "chunk_id")
        ranked = with_metadata(ranked, keys, "row_id", rows).drop("row_id")
        return with_metadata(ranked, metadata, "chunk_id", rows)
    if "row_range" in metadata.columns:
        # Ids, ranks and scores alone; they are read twice, for their ranges and for the join.
        ranked = cut_lineage(ranked)
    return with_metadata(ranked, metadata, "row_id", rows).drop("row_id")


def answer(
    queries: DataFrame, index: DataFrame, metadata: Metadata, pool: int = V.POOL,
    segmenter: Segmenter = by_language,
) -> DataFrame:
    """(query_id, documents, fragments): the nested answer of every query, by query.

    The pool is used twice, for documents and for fragments, so the search result (a
    few rows per query) is materialised and the vectors are read once.
    """
    found = cut_lineage(search(queries, index, metadata, pool))
    return nest(queries, rank_documents(found), rank_fragments(found, segmenter=segmenter))


def nest(queries: DataFrame, documents: DataFrame, fragments: DataFrame) -> DataFrame:
    """Gather the ranked rows of every query, a handful each, into arrays."""

    def gathered(rows: DataFrame, name: str, *fields: str) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct("rank", *fields)))
        return rows.groupBy("query_id").agg(listed.alias(name))

    return (
        queries.select("query_id")
        .join(gathered(documents, "documents", "doc_id"), "query_id", "left")
        .join(gathered(fragments, "fragments", "chunk_id", "doc_id", "text"), "query_id", "left")
        .select(
            "query_id",
            *[F.coalesce(c, F.array()).alias(c) for c in ("documents", "fragments")],
        )
        .orderBy("query_id")
    )


def keyword_relevance(found: DataFrame, keywords: DataFrame, n: int = 3) -> DataFrame:
    """(query_id, relevant): whether a keyword occurs in the first ``n`` chunk texts."""
    hit = X.mentions_any("texto", F.col("keywords"))
    return (
        found.filter(F.col("rank") <= n)
        .join(keywords, "query_id")
        .groupBy("query_id")
        .agg(F.bool_or(hit).alias("relevant"))
    )


def sanity_rows(found: DataFrame, expected: Column) -> DataFrame:
    """What a person checks by eye: score, phenomenon match and a text preview."""
    return found.select(
        "query_id", "rank", "score", "doc_id", "fenomeno",
        F.coalesce(F.col("fenomeno") == expected, F.lit(False)).alias("match"),
        X.preview("texto").alias("preview"),
    )
