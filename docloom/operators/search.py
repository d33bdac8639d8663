"""Exact inner-product top-k of many queries over a vector table.

The vector table is read once and never shuffled: each task multiplies its Arrow
batches with the query matrix and keeps the best k rows per query, which are then
merged.  The query matrix is sent to the tasks only while its measured size stays
under a bound.  Larger query sets are packed into blocks and meet packed vector
blocks through a merge join, so neither side passes through the driver or is broadcast.
Both ways multiply in double what was stored, so they give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.compact import first_per_group

MAX_QUERY_BYTES = 64 << 20
# The last bits of a product depend on where a row lies in its batch.  Without them
# equal vectors score the same, and ties fall to the row id on every run.
_SCORE_DECIMALS = 10
_SCORES_AT_ONCE = 4_000_000
_HELD_CANDIDATES = 2_000_000
_QUERIES_PER_BLOCK = 1024
_VECTORS_PER_BLOCK = 4096
_MERGE_SALTS = 64


class _Best:
    """The best k rows of every query seen so far; ties go to the smaller id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, _SCORES_AT_ONCE // max(1, len(queries)))
        for at in range(0, len(ids), step):
            scores = np.round(queries @ vectors[at : at + step].T, _SCORE_DECIMALS)
            floor = self.floor
            first = np.isneginf(floor).any()
            if first and scores.shape[1] > self.k:
                nth = scores.shape[1] - self.k
                floor = np.maximum(floor, np.partition(scores, nth, axis=1)[:, nth])
            # Everything level with the k-th score stays until ids decide.
            q, r = np.nonzero(scores >= floor[:, None])
            self.held.append((q, ids[at : at + step][r], scores[q, r]))
            self.size += len(q)
            if first or self.size > _HELD_CANDIDATES:
                self.compress()

    def compress(self) -> None:
        if not self.held:
            return
        q, ids, scores = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[q[last]] = scores[last]
        self.held = [(q[keep], ids[keep], scores[keep])]
        self.size = int(keep.sum())

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.compress()
        return self.held[0] if self.held else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) == 0:
        return flat.reshape(0, dim or 0)
    wide = flat.reshape(len(column), -1)
    if dim is not None and wide.shape[1] != dim:
        raise ValueError(f"vectors have {wide.shape[1]} dimensions, queries have {dim}")
    return wide


def _batches(qids, ids, scores, names) -> Iterator[pa.RecordBatch]:
    if len(ids):
        yield pa.RecordBatch.from_arrays([qids, pa.array(ids), pa.array(scores)], names=names)


def _out_schema(queries: DataFrame, corpus: DataFrame, qid: str, row: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(qid, queries.schema[qid].dataType),
            T.StructField(row, corpus.schema[row].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _score_broadcast(queries, corpus, k, qid, row, vector) -> DataFrame:
    table = queries.select(qid, vector).toArrow()
    wide = _matrix(table[vector])
    shared = queries.sparkSession.sparkContext.broadcast((table[qid].combine_chunks(), wide))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, matrix = shared.value
        best = _Best(len(matrix), k)
        for b in batches:
            best.add(matrix, b.column(0).to_numpy(zero_copy_only=False),
                     _matrix(b.column(1), matrix.shape[1]))
        q, ids, scores = best.rows()
        yield from _batches(qids.take(pa.array(q)), ids, scores, [qid, row, "score"])

    return corpus.select(row, vector).mapInArrow(score, _out_schema(queries, corpus, qid, row))


def _packed(df: DataFrame, key: str, vector: str, size: int, names: tuple[str, str]) -> DataFrame:
    """Rows of at most ``size`` vectors: their keys, and their values as stored, end to end."""
    schema = T.StructType(
        [
            T.StructField(names[0], T.ArrayType(df.schema[key].dataType)),
            T.StructField(names[1], T.BinaryType()),
        ]
    )
    kind = _stored(df, vector)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                keys = part.column(0)
                listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
                values = _matrix(part.column(1)).astype(kind).tobytes()
                yield pa.RecordBatch.from_arrays([listed, pa.array([values])], names=list(names))

    return df.select(key, vector).mapInArrow(block, schema)


def _stored(df: DataFrame, vector: str) -> type:
    element = df.schema[vector].dataType.elementType
    return np.float32 if isinstance(element, T.FloatType) else np.float64


def _score_blocks(queries, corpus, k, qid, row, vector, groups: int) -> DataFrame:
    wanted = _packed(queries, qid, vector, _QUERIES_PER_BLOCK, ("_qids", "_q"))
    stored = _packed(corpus, row, vector, _VECTORS_PER_BLOCK, ("_rows", "_v"))
    # A vector block goes to one group, a query block to all: as many tasks share
    # the vectors as there are groups, and every pair of blocks meets once.
    spread = stored.withColumn("_group", F.pmod(F.xxhash64("_rows"), F.lit(groups)))
    copied = wanted.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # Spark knows the packed blocks' size only from the file their texts came from,
    # so the kind of join is not left to it.
    copied = copied.withColumn("_group", F.col("_group").cast("bigint")).hint("merge")
    pairs = spread.join(copied, "_group")
    q_kind, v_kind = _stored(queries, vector), _stored(corpus, vector)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple[pa.Array, _Best]] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for qids, one in best.values():
                at, ids, scores = one.rows()
                yield from _batches(qids.take(pa.array(at)), ids, scores, [qid, row, "score"])
            best.clear()

        for b in batches:
            for i in range(b.num_rows):
                rows, v, qids, q = (b.column(c).slice(i, 1) for c in range(4))
                rows, qids = rows.flatten(), qids.flatten()
                vectors = np.frombuffer(v[0].as_py(), v_kind).reshape(len(rows), -1)
                matrix = np.frombuffer(q[0].as_py(), q_kind).reshape(len(qids), -1)
                # A block of queries is known by its first key and its length.
                _, one = best.setdefault((qids[0].as_py(), len(qids)), (qids, _Best(len(qids), k)))
                one.add(matrix.astype(np.float64), rows.to_numpy(zero_copy_only=False), vectors.astype(np.float64))
                if sum(x.size for _, x in best.values()) > _HELD_CANDIDATES:
                    yield from emit()
        yield from emit()

    return pairs.select("_rows", "_v", "_qids", "_q").mapInArrow(
        score, _out_schema(queries, corpus, qid, row)
    )


def query_bytes(queries: DataFrame, vector: str = "vector") -> int:
    """Measured size of the query matrix."""
    return queries.agg(F.coalesce(F.sum(F.size(vector).cast("bigint")), F.lit(0))).first()[0] * 8


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    row_id: str = "row_id",
    vector: str = "vector",
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, row_id, score): the ``k`` best rows of every query, best first.

    Equal scores are ordered by row id.  Both tables hold unit vectors of one
    dimension; with fewer than ``k`` rows a query gets them all.
    """
    # Measuring runs what makes the queries; without a bound to hold there is no need.
    if max_query_bytes > 0 and query_bytes(queries, vector) <= max_query_bytes:
        scored = _score_broadcast(queries, corpus, k, query_id, row_id, vector)
    else:
        groups = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        scored = _score_blocks(queries, corpus, k, query_id, row_id, vector, groups)
    order: list[Column] = [F.col("score").desc(), F.col(row_id)]
    # Merge in two steps, so one query's candidates from all tasks never meet at once.
    # A task has sent k rows of a query at most, so tasks are what is merged by.
    salted = scored.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(_MERGE_SALTS)))
    merged = first_per_group(salted, [query_id, "_salt"], order, k).drop("_salt")
    return first_per_group(merged, [query_id], order, k, "rank").select(
        query_id, "rank", row_id, "score"
    )
