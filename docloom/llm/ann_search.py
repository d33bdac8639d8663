"""Approximate nearest neighbours by inner product, with balanced posting lists.

Vectors are lengthened by one coordinate so that all have one norm; then the largest
inner product is the smallest distance.  Centroids are fitted on a bounded sample and held
in a graph that each task searches in memory.  Every vector goes to the posting list of its
nearest centroid and, near a boundary, to those of a few more.  A query visits the lists
whose centroids are at most a ratio farther than its REFERENCE-th nearest (the nearest of all
says little: it is the one the query's own vector helped to place); the ratio is set by a
bounded sample of queries compared with all vectors.

Lists are cut into blocks of bounded size and so are the queries that visit them; blocks
meet in a keyed join, and each task keeps the best candidates of a query over all
blocks it sees.  A query carries a floor, the 2k-th best score in the sample of vectors: what lies
below it cannot be among the k best, and is sent on only from the nearest lists, which
hold k vectors for certain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut_lineage, read

#: Vectors that centroids are fitted on, and queries that the ratio is set by, at most (in expectation).
SAMPLE_VECTORS, SAMPLE_QUERIES = 20_000, 100
MAX_CENTROIDS = 2048
#: Lists of a vector, and how much farther than its nearest centroid another may be.
COPIES, BOUNDARY = 8, 1.3
#: Which of a query's nearest centroids its ratio refers to.
REFERENCE = 8
#: Recall aimed at in the sample; what is asked for is 0.9.
AIM = 0.95
VECTORS_PER_BLOCK, QUERIES_PER_BLOCK = 1024, 512
_DEGREE, _FAR, _ROUNDS = 16, 4, 8
_HELD = 1_000_000


@dataclass
class Graph:
    """Centroids with their nearest neighbours among themselves."""

    points: np.ndarray
    links: np.ndarray
    entry: np.ndarray
    ratio: float = math.inf
    beam: int = 64
    #: Vectors in each list.
    sizes: np.ndarray | None = None

    @staticmethod
    def build(points: np.ndarray) -> Graph:
        n = len(points)
        degree = min(_DEGREE, n - 1)
        near = np.argsort(_distances(points, points), axis=1, kind="stable")[:, 1 : degree + 1]
        rng = np.random.default_rng(1)
        # A few links to anywhere keep far regions within reach.
        far = rng.integers(0, n, (n, min(_FAR, n)))
        return Graph(points.astype(np.float32), np.concatenate([near, far], axis=1), rng.choice(n, min(16, n), replace=False))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(distances, centroids) of the ``beam`` nearest found, nearest first: best-first over the links."""
        n, q = len(self.points), len(queries)
        beam = min(beam, n)
        rows = np.arange(q)[:, None]
        seen = np.zeros((q, n + 1), bool)
        ids = np.broadcast_to(self.entry, (q, len(self.entry))).copy()
        seen[rows, ids] = True
        dist = self._to(queries, ids)
        done = np.zeros(ids.shape, bool)
        step = max(2, min(8, beam // 6))
        queries = queries.astype(np.float32)
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, : max(beam, 1)]
            ids, dist, done = (np.take_along_axis(x, order, 1) for x in (ids, dist, done))
            waiting = np.where(done | np.isinf(dist), np.inf, dist)
            chosen = np.argsort(waiting, axis=1, kind="stable")[:, :step]
            live = np.isfinite(np.take_along_axis(waiting, chosen, 1))
            if not live.any():
                return dist[:, :beam], ids[:, :beam]
            np.put_along_axis(done, chosen, True, 1)
            heads = np.where(live, np.take_along_axis(ids, chosen, 1), n)
            table = np.concatenate([self.links, np.full((1, self.links.shape[1]), n)])
            new = np.sort(table[heads].reshape(q, -1), axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new[seen[rows, new]] = n
            seen[rows, new] = True
            seen[:, n] = False
            ids = np.concatenate([ids, new], axis=1)
            dist = np.concatenate([dist, self._to(queries, new)], axis=1)
            done = np.concatenate([done, np.zeros(new.shape, bool)], axis=1)

    def _to(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.full(ids.shape, np.inf, np.float32)
        q, at = np.nonzero(ids < len(self.points))
        for low in range(0, len(q), 200_000):
            part = slice(low, low + 200_000)
            gap = queries[q[part]] - self.points[ids[q[part], at[part]]]
            out[q[part], at[part]] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def fit_centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Lloyd rounds; a centroid with few vectors moves next to one with many, which balances the lists."""
    rng = np.random.default_rng(0)
    points = sample[rng.choice(len(sample), k, replace=False)].copy()
    mean = len(sample) / k
    for at in range(_ROUNDS):
        near = np.concatenate(
            [_distances(sample[x : x + 4096], points).argmin(1) for x in range(0, len(sample), 4096)]
        )
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(points)
        np.add.at(sums, near, sample)
        points[count > 0] = sums[count > 0] / count[count > 0][:, None]
        if at < _ROUNDS - 1:
            crowded = np.argsort(-count, kind="stable")
            crowded = crowded[count[crowded] > 2 * mean]
            idle = np.argsort(count, kind="stable")[: len(crowded)]
            idle = idle[count[idle] < mean / 2]
            for j, c in zip(idle, crowded):
                points[j] = sample[rng.choice(np.flatnonzero(near == c))]
    return points


def _plain(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _longer(vectors: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(1), 0))
    return np.column_stack([vectors, rest])


def _queries_longer(vectors: np.ndarray, norm: float) -> np.ndarray:
    """A query's length does not matter to its order of candidates."""
    size = np.sqrt((vectors * vectors).sum(1))[:, None]
    return np.column_stack([vectors / size * norm, np.zeros(len(vectors))])


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) of rows that take part: an id, and a vector of finite numbers that are not all zero.

    Where dimensions differ, those of the commonest take part.
    """
    double = F.col(vector).cast("array<double>")
    rows = df.select(F.col(vec_id).cast("bigint").alias("id"), double.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    best = sizes.first()
    return rows.where(F.size("v") == (best.d if best else 0)).distinct()


def exact_score(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products row by row, the same whatever block a vector lies in."""
    return (queries * vectors).sum(axis=1)


class _Nearest:
    """The best ``k`` candidates of each query over blocks; ties go to the smaller id."""

    def __init__(self, k: int):
        self.k, self.parts, self.size = k, [], 0

    def add(
        self, qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
        least: np.ndarray | None = None,
    ) -> None:
        rough = queries @ vectors.T
        rough[qids[:, None] == ids[None]] = -np.inf
        if least is not None:
            rough[rough < least[:, None]] = -np.inf
        # An id with several vectors may fill several of the first places.
        first = self.k + len(ids) - len(np.unique(ids))
        if rough.shape[1] > first:
            # Rounding differs between blocks: keep what is level with the k-th but for that.
            floor = np.partition(rough, -first, axis=1)[:, -first]
            slack = 1e-9 * np.maximum(np.abs(np.where(np.isfinite(floor), floor, 0)), 1e-30) + 1e-12 * np.abs(
                queries
            ).sum(1) * np.abs(vectors).max()
            keep = rough >= (floor - slack)[:, None]
        else:
            keep = np.ones(rough.shape, bool)
        q, v = np.nonzero(keep & np.isfinite(rough))
        self.parts.append((qids[q], ids[v], exact_score(queries[q], vectors[v])))
        self.size += len(q)
        if self.size > _HELD:
            self.compress()

    def compress(self) -> None:
        if not self.parts:
            return
        q, v, s = (np.concatenate(x) for x in zip(*self.parts))
        # A vector comes once from each of its lists, an id from each of its vectors: the best counts.
        order = np.lexsort((-s, v, q))
        q, v, s = q[order], v[order], s[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
        q, v, s = q[new], v[new], s[new]
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < self.k
        self.parts = [(q[keep], v[keep], s[keep])]
        self.size = int(keep.sum())

    def take(self) -> Iterator[pa.RecordBatch]:
        self.compress()
        if self.parts:
            q, v, s = self.parts[0]
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])
        self.parts, self.size = [], 0

    def full(self) -> bool:
        if self.size > _HELD:
            self.compress()
        return self.size > _HELD // 2


_FOUND = "query_id bigint, vec_id bigint, score double"


def _truth(shared, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, queries = shared.value
        best = _Nearest(k)
        for b in batches:
            if b.num_rows:
                best.add(qids, queries, b.column(0).to_numpy(), _plain(b.column(1)))
        yield from best.take()

    return scan


def _assign(shared, norm: float, copies: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                dist, ids = graph.search(_longer(_plain(b.column(1)), norm), max(2 * copies, 16))
                keep = np.isfinite(dist[:, :copies]) & (dist[:, :copies] <= BOUNDARY * dist[:, :1] + 1e-6)
                row, col = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row, col].astype(np.int32)), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row))],
                    names=["list", "id", "v"],
                )

    return run


def _floor(ids: np.ndarray, queries: np.ndarray, sample: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """A score that at least 2k other vectors reach; minus infinity where the sample is too small to tell."""
    known, vectors = sample
    if len(known) <= 2 * k:
        return np.full(len(ids), -np.inf)
    scores = queries @ vectors.T
    scores[ids[:, None] == known[None]] = -np.inf
    low = np.partition(scores, -2 * k, axis=1)[:, -2 * k]
    return low - 1e-9 * np.maximum(np.abs(np.where(np.isfinite(low), low, 0)), 1e-30)


def _visit(shared, norm: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, sample = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                dist, ids = graph.search(_queries_longer(_plain(b.column(1)), norm), graph.beam)
                reference = dist[:, min(REFERENCE, dist.shape[1]) - 1]
                keep = dist <= graph.ratio * reference[:, None] + 1e-6
                # The nearest lists that hold k others at least, each vector COPIES times at most.
                size = graph.sizes[ids]
                certain = np.cumsum(size, axis=1) - size < COPIES * (k + 1)
                row, col = np.nonzero((keep | certain) & np.isfinite(dist))
                floor = _floor(b.column(0).to_numpy(), _plain(b.column(1)), sample, k)
                floor = np.where(certain[row, col], -np.inf, floor[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row, col].astype(np.int32)), b.column(0).take(pa.array(row)),
                     b.column(1).take(pa.array(row)), pa.array(floor)],
                    names=["list", "id", "v", "floor"],
                )

    return run


def _blocks(rows: DataFrame, size: int, names: dict[str, str]) -> DataFrame:
    """Rows of a list packed into blocks of about ``size``: an array of each column under its new name."""
    counts = rows.groupBy("list").agg(F.ceil(F.count("*") / size).cast("bigint").alias("_parts"))
    # One row for each centroid, of which there are at most MAX_CENTROIDS.
    dealt = rows.join(F.broadcast(counts), "list").withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")))
    packed = dealt.groupBy("list", "_part").agg(F.collect_list(F.struct(*names)).alias("_b"))
    return packed.select("list", *[F.col(f"_b.{c}").alias(n) for c, n in names.items()])


def _match(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Nearest(k)
        for b in batches:
            for i in range(b.num_rows):
                ids, vectors, qids, queries, least = (b.column(c).slice(i, 1).flatten() for c in range(5))
                best.add(qids.to_numpy(), _plain(queries), ids.to_numpy(), _plain(vectors), least.to_numpy())
                if best.full():
                    yield from best.take()
        yield from best.take()

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def _sampled(df: DataFrame, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """About ``most`` of ``n`` rows, chosen by a hash of the id."""
    scale = 1 << 30
    picked = df.where(F.pmod(F.xxhash64("id"), F.lit(scale)) < min(scale, math.ceil(scale * most / max(n, 1))))
    table = picked.orderBy("id").toArrow()
    if not table.num_rows:
        return np.empty(0, np.int64), np.empty((0, 1))
    return table["id"].to_numpy(), _plain(table["v"].combine_chunks())


def build_graph(sample: np.ndarray, n: int, norm: float) -> Graph:
    k = max(1, min(MAX_CENTROIDS, int(4 * math.sqrt(n)), len(sample) // 4))
    return Graph.build(fit_centroids(_longer(sample, norm), k))


def set_ratio(graph: Graph, vectors: DataFrame, postings: DataFrame, queries: DataFrame, n: int, norm: float, k: int) -> None:
    """The smallest ratio at which a sample of queries finds AIM of its true neighbours, and a beam that holds its lists."""
    qids, sample = _sampled(queries, n, SAMPLE_QUERIES)
    graph.sizes = np.zeros(len(graph.points), np.int64)
    for row in postings.groupBy("list").count().collect():  # one for each centroid
        graph.sizes[row["list"]] = row["count"]
    graph.beam = len(graph.points)
    if not len(qids):
        graph.ratio = math.inf
        return
    shared = vectors.sparkSession.sparkContext.broadcast((qids, sample))
    true = cut_lineage(_ranked(vectors.mapInArrow(_truth(shared, k), _FOUND), k).select("query_id", F.col("vec_id").alias("id")))
    # At most k neighbours of each sampled query, in at most COPIES lists each.
    pairs = true.join(postings.select("list", "id"), "id").select("query_id", "id", "list").toArrow().to_pandas()
    dist = _distances(_queries_longer(sample, norm), graph.points)
    reference = np.sort(dist, axis=1)[:, min(REFERENCE, dist.shape[1]) - 1]
    scaled = dist / np.maximum(reference, 1e-12)[:, None]
    pairs["need"] = scaled[np.searchsorted(qids, pairs["query_id"]), pairs["list"]]
    need = pairs.groupby(["query_id", "id"])["need"].min().to_numpy()
    if not len(need):
        return
    graph.ratio = float(np.quantile(need, AIM, method="higher")) * (1 + 1e-9)
    lists = (scaled <= graph.ratio).sum(1)
    enough = COPIES * (k + 1) / max(graph.sizes.mean(), 1e-9)
    graph.beam = int(min(len(graph.points), max(16, math.ceil(1.25 * lists.max()), math.ceil(4 * enough))))


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest rows found but its own.

    Nearest is the largest inner product, in double precision on the stored vectors; ties go
    to the smaller id; with fewer candidates a query gets those found.  Null, zero and
    non-finite vectors, vectors of another dimension than the commonest, and rows without an
    id take no part.  An id that is repeated is one candidate with its best score.
    ``is_query`` is a condition on the id.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(usable(vectors, vec_id, vector))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, most = rows.agg(F.count("*"), F.max(square)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    norm = math.sqrt(most) * (1 + 1e-12)
    queries = rows.where(is_query)
    sample = _sampled(rows, n, SAMPLE_VECTORS)
    if not len(sample[0]):
        sample = _sampled(rows, 1, 1)
    # An id with several vectors has one place among the best.
    once = np.unique(sample[0], return_index=True)[1]
    graph = build_graph(sample[1], n, norm)
    held = spark.sparkContext.broadcast(graph)
    kind = "list int, id bigint, v array<double>"
    postings = cut_lineage(rows.mapInArrow(_assign(held, norm, COPIES), kind))
    set_ratio(graph, rows, postings, queries, queries.count(), norm, k)
    held = spark.sparkContext.broadcast((graph, (sample[0][once], sample[1][once])))
    visits = cut_lineage(queries.mapInArrow(_visit(held, norm, k), f"{kind}, floor double"))
    stored = _blocks(postings, VECTORS_PER_BLOCK, {"id": "_ids", "v": "_vectors"})
    asked = _blocks(visits, QUERIES_PER_BLOCK, {"id": "_qids", "v": "_queries", "floor": "_least"})
    met = stored.join(asked, "list").select("_ids", "_vectors", "_qids", "_queries", "_least")
    return _ranked(met.mapInArrow(_match(k), _FOUND), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
