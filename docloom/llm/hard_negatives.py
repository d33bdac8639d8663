"""Hard negatives by exact integer inner products, multiplied by Strassen's recursion.

Vectors become integers and are packed, in the tasks that read them, into tiles of candidates
and blocks of anchors.  Every anchor block meets every group of tiles in a keyed join; a task
multiplies block and tile by Strassen's method in int64, with zero padding and leaves of LEAF,
and folds the products into heaps that hold a few rows of each anchor.  Heaps of different
groups are merged by a ranking.  A first pass finds the positives; the second, which then knows
each positive's score, fills one heap for each window between a share of that score and all of it.

All additions are exact modulo 2^64, so a score is right whenever it fits into int64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut_lineage, read

SCALE, ANCHOR_EVERY, SHIFT_EVERY, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
#: Share of the positive's score that a negative has at least, in percent.
LEAST_PERCENT = 80
TILE_ROWS, BLOCK_ROWS = 1024, 256
#: Rows that an anchor block meets in one task: few in small tables, for parallel work; beyond
#: MANY_GROUPS groups more, up to the larger number, so that blocks are copied less often.
GROUP_ROWS, MANY_GROUPS = (4096, 65_536), 4096
#: No side of a leaf's product is longer, but for a tile's when the vectors are short.
LEAF = 64
_LOWEST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a`` @ ``b`` in int64: seven products of half the size at each level, odd sides padded by zeros."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf // 2 or max(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The ``k`` first of each row's entries, by larger score and then smaller id; heaps of the same rows merge."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.row = self.score = self.id = np.empty(0, np.int64)
        self.least = np.full(rows, _LOWEST)
        self.full = np.zeros(rows, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """A row of scores for each heap; only what can still enter is kept."""
        row, at = np.nonzero(allowed & ((scores >= self.least[:, None]) | ~self.full[:, None]))
        self.merge(row, scores[row, at], ids[at])

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.id, ids)))
        # Not by the negated score: the smallest int64 has none.
        order = np.lexsort((ids, ~score, row))
        row = row[order]
        first = np.searchsorted(row, row)
        kept = np.arange(len(row)) - first < self.k
        self.row, self.score, self.id = row[kept], score[order][kept], ids[order][kept]
        last = np.flatnonzero(np.arange(len(row)) - first == self.k - 1)
        self.least[row[last]] = score[order][last]
        self.full[row[last]] = True


def usable(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(id, label, v) of the rows that take part: v holds the components in double."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.alias("v")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & good)


def _integers(lists: pa.Array) -> np.ndarray:
    return np.floor(SCALE * lists.flatten().to_numpy()).astype(np.int64)


def _by_width(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Vectors of different lengths have no product: rows of each length by themselves."""
    widths = b["v"].value_lengths().to_numpy()
    for width in np.unique(widths):
        yield int(width), b.take(pa.array(np.flatnonzero(widths == width)))


_TILE = "width int, batch_group long, ids binary, labels binary, rows binary"


def _tiles(groups: int):
    """Candidates packed into tiles, in the order of their ids, each in a group that its ids choose."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for width, own in _by_width(b):
                own = own.take(pa.compute.sort_indices(own, sort_keys=[("id", "ascending")]))
                for at in range(0, own.num_rows, TILE_ROWS):
                    tile = own.slice(at, TILE_ROWS)
                    ids = tile["id"].to_numpy()
                    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
                    group = int((mixed >> np.uint64(20)) % np.uint64(groups))
                    yield _row(width, group, tile, ids)

    return pack


def _row(width: int, group: int, own: pa.RecordBatch, ids: np.ndarray) -> pa.RecordBatch:
    cells = (ids, own["label"].to_numpy(), _integers(own["v"]))
    return pa.RecordBatch.from_arrays(
        [pa.array([width], pa.int32()), pa.array([group], pa.int64())] + [pa.array([c.tobytes()]) for c in cells],
        names=["width", "batch_group", "ids", "labels", "rows"],
    )


def _anchor_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for width, own in _by_width(b):
            for at in range(0, own.num_rows, BLOCK_ROWS):
                block = own.slice(at, BLOCK_ROWS)
                yield _row(width, 0, block, block["id"].to_numpy())


def _read(b: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, rows = (np.frombuffer(b[prefix + c][i].as_py(), np.int64) for c in ("ids", "labels", "rows"))
    return ids, labels, rows.reshape(len(ids), -1)


def _met(blocks: DataFrame, tiles: DataFrame, groups: int) -> DataFrame:
    """Every anchor block beside every tile; block and tile meet by the tile's group.

    A block is copied once for each group, a tile is moved once; the join is by key, and the
    rows of a block follow each other.
    """
    named = blocks.withColumnsRenamed({c: f"a_{c}" for c in ("ids", "labels", "rows")}).drop("batch_group")
    copied = named.withColumn("batch_group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    return copied.join(tiles.hint("shuffle_merge"), ["width", "batch_group"])


def _folded(batches: Iterator[pa.RecordBatch], heaps, add, take) -> Iterator[pa.RecordBatch]:
    """Heaps for a block while its rows follow each other, given out when another block begins."""
    last, held = None, None
    for b in batches:
        for i in range(b.num_rows):
            name = b["a_ids"][i].as_py()
            if name != last:
                if held is not None:
                    yield take(held)
                last, anchors = name, _read(b, i, "a_")
                held = heaps(b, i, anchors)
            ids, labels, rows = _read(b, i, "")
            add(held, strassen(anchors[2], np.ascontiguousarray(rows.T)), anchors, ids, labels)
    if held is not None:
        yield take(held)


def _positives(k: int):
    def add(held, scores, anchors, ids, labels):
        held[1].offer(scores, ids, (anchors[1][:, None] == labels) & (anchors[0][:, None] != ids))

    def take(held):
        heap = held[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(held[0][heap.row]), pa.array(heap.id), pa.array(heap.score)], names=["anchor_id", "positive_id", "positive_score"]
        )

    def run(batches):
        yield from _folded(batches, lambda b, i, anchors: (anchors[0], Heaps(len(anchors[0]), k)), add, take)

    return run


def _negatives(k: int, least_percent: int):
    def heaps(b, i, anchors):
        at = np.frombuffer(b["p_at"][i].as_py(), np.int64)
        return anchors[0], at, *(np.frombuffer(b[c][i].as_py(), np.int64) for c in ("p_ids", "p_scores")), Heaps(len(at), k)

    def add(held, scores, anchors, ids, labels):
        _, at, _, top, heap = held
        own = scores[at]
        # percent * positive <= 100 * negative, both sides divided by their common factor.
        shared = np.gcd(least_percent, 100)
        inside = (own <= top[:, None]) & ((least_percent // shared) * top[:, None] <= (100 // shared) * own)
        heap.offer(own, ids, inside & (anchors[1][at][:, None] != labels))

    def take(held):
        anchor_ids, at, positive_ids, top, heap = held
        cells = (anchor_ids[at][heap.row], positive_ids[heap.row], top[heap.row], heap.id, heap.score)
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=names)

    def run(batches):
        yield from _folded(batches, heaps, add, take)

    return run


def _with_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors, each with its positives: the anchor's place in the block, id and score."""
    for b in batches:
        for width, own in _by_width(b):
            for start in range(0, own.num_rows, BLOCK_ROWS):
                block = own.slice(start, BLOCK_ROWS)
                row = _row(width, 0, block, block["id"].to_numpy())
                found = block["positives"]
                at = np.repeat(np.arange(block.num_rows), found.value_lengths().to_numpy())
                cells = (at, found.flatten().field("positive_id").to_numpy(), found.flatten().field("positive_score").to_numpy())
                added = [pa.array([np.ascontiguousarray(c, np.int64).tobytes()]) for c in cells]
                yield pa.RecordBatch.from_arrays(row.columns + added, names=row.schema.names + ["p_at", "p_ids", "p_scores"])


def _first(rows: DataFrame, keys: list[str], k: int, score: str, tie: str) -> DataFrame:
    """The heaps of all groups merged: ``k`` rows of a key, numbered in ``rank``; Spark cuts each task's share first."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), tie))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(256 * x), a score is the inner product of those.  An anchor's
    positives are its ``positives`` best rows of the same label, its own id excepted; for each, the
    ``negatives`` best rows of another label are returned whose score lies between
    ``least_percent`` of the positive's and all of it.  Larger scores come first, ties by
    smaller id.  Rows with a null id, label or vector, an empty vector, or a null or non-finite
    component take no part; vectors of different lengths are never compared.  Rows that repeat
    an id are rows of their own, but an anchor never meets its own id, and of
    several anchors with one id that with the smallest label and vector counts.  Other columns
    are ignored.  ``is_anchor`` is a condition on ``id``: by default, that 100 divides it.
    """
    rows = usable(vectors, vec_id, vector, label)
    chosen = F.col("id") % ANCHOR_EVERY == 0 if is_anchor is None else is_anchor
    anchors = rows.where(chosen).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*")
    anchors = cut_lineage(anchors)
    n = rows.count()
    groups = max(1, -(-n // min(GROUP_ROWS[1], max(GROUP_ROWS[0], n // MANY_GROUPS))))
    tiles = rows.mapInArrow(_tiles(groups), _TILE)
    blocks = anchors.mapInArrow(_anchor_blocks, _TILE)
    found = _met(blocks, tiles, groups).mapInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = _first(found, ["anchor_id"], positives, "positive_score", "positive_id")
    # At most ``positives`` of an anchor.
    lists = cut_lineage(
        best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    known = anchors.join(lists, "id").mapInArrow(_with_positives, _TILE + ", p_at binary, p_ids binary, p_scores binary")
    windows = _met(known, tiles, groups).mapInArrow(
        _negatives(negatives, least_percent),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    ranked = _first(windows, ["anchor_id", "positive_id"], negatives, "negative_score", "negative_id")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted(vectors: DataFrame) -> DataFrame:
    """``vectors`` with the label of every seventh id moved on by one, in a circle of ten."""
    moved = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(shifted(read(spark, sf_dir, "embeddings")))


SQL = """
WITH u AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM u a JOIN u c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, c, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5),
n AS (
  SELECT p.a AS anchor_id, p.c AS positive_id, p.score AS positive_score, s.c AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c) AS r
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 5
"""
