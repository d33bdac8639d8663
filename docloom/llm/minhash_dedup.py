"""Near-duplicate documents by b-bit MinHash.

One scan turns each text into the minima of its five-word shingles under many hash
functions.  Bands of a few minima give the candidate buckets; of each minimum only
the low bits are kept, packed into a signature whose bit counts, corrected for
chance collisions, estimate the similarity of a candidate pair.  What the estimate
leaves is confirmed on the full sets.

No step emits all pairs of a group.  Equal sets are one class with one
representative.  In a bucket, and later among candidates, pairs are looked at inside
a task, a block of members against a block, and only the star of each connected part
leaves it: rows grow with the members, links keep their connectivity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import shingles as S
from docloom.llm.common import components, cut_lineage, read

BANDS, ROWS, BITS = 42, 6, 2
MINIMA = BANDS * ROWS
SIGNATURE_WORDS = 8
#: A pair this far below the similarity asked for is over five deviations away.
MARGIN = 0.15
MEMBERS_PER_BLOCK = 256
SHINGLES_PER_BLOCK = 1 << 16
_SHINGLES_AT_ONCE = 1 << 15
_U = np.uint64


def _unique(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted values of each text, and where each begins."""
    parts = [np.unique(values[a:b]) for a, b in zip(at[:-1], at[1:])]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    return (np.concatenate(parts) if parts else values), bounds


def _digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell sets apart."""
    one = np.add.reduceat(S.mix(values ^ _U(0xA5A5A5A5A5A5A5A5)), starts)
    two = np.add.reduceat(S.mix(values * _U(0x9E3779B97F4A7C15)), starts)
    return one, two


def _minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima of all hash functions, one row for each text; texts are not empty."""
    n = len(bounds) - 1
    out = np.empty((n, MINIMA), _U)
    factors, at = S.constants(MINIMA, 9), 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _SHINGLES_AT_ONCE, "right")) - 1)
        part = values[bounds[at] : bounds[end]]
        starts = bounds[at:end] - bounds[at]
        held = np.empty_like(part)
        for k in range(MINIMA):
            np.multiply(part, factors[k], out=held)
            out[at:end, k] = np.minimum.reduceat(held, starts)
        at = end
    return out


def _bands(minima: np.ndarray) -> np.ndarray:
    keys = np.empty((len(minima), BANDS), _U)
    for band in range(BANDS):
        key = np.full(len(minima), band + 1, _U)
        for k in range(band * ROWS, band * ROWS + ROWS):
            key = S.mix(key * _U(31) + minima[:, k])
        keys[:, band] = key
    return keys


def _packed(minima: np.ndarray) -> np.ndarray:
    """Low bits of all minima, BITS of each, in 64-bit words; the last bits stay zero."""
    low = S.mix(minima.copy()) & _U((1 << BITS) - 1)
    out = np.zeros((len(minima), SIGNATURE_WORDS), _U)
    per_word = 64 // BITS
    for k in range(MINIMA):
        out[:, k // per_word] |= low[:, k] << _U(BITS * (k % per_word))
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of packed signatures, chance collisions taken out."""
    x = a ^ b
    x |= x >> _U(1)
    x &= _U(0x5555555555555555)
    same = 1 - np.bitwise_count(x).sum(axis=-1) / MINIMA
    chance = 1 / (1 << BITS)
    return (same - chance) / (1 - chance)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            part = b.slice(at, 2048)
            values, bounds = _unique(*S.batch_shingles(part.column(1)))
            size = np.diff(bounds)
            has = size > 0
            one = np.zeros(len(size), _U)
            two, keys = one.copy(), np.zeros((len(size), BANDS), _U)
            packed = np.zeros((len(size), SIGNATURE_WORDS), _U)
            if has.any():
                dense = np.concatenate([[0], np.cumsum(size[has])])
                one[has], two[has] = _digests(values, dense[:-1])
                minima = _minima(values, dense)
                keys[has], packed[has] = _bands(minima), _packed(minima)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                 _binary(keys), _binary(packed)],
                names=["doc_id", "n_shingles", "_one", "_two", "_bands", "_sig"],
            )


def _binary(table: np.ndarray) -> pa.Array:
    wide = table.shape[1] * 8
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(wide), len(table), [None, pa.py_buffer(np.ascontiguousarray(table).tobytes())]
    )
    return fixed.cast(pa.binary())


def _wide(column: pa.Array, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _U).reshape(len(column), words)


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, _one, _two, _bands, _sig) of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _sign, f"doc_id {kind}, n_shingles bigint, _one bigint, _two bigint, _bands binary, _sig binary"
    )


def _spread(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Rows of a group dealt to its pairs of blocks: ``_i`` <= ``_j``, ``_side`` tells whose block it is.

    A group of one block keeps one copy of each row; in a larger one every two rows
    meet in at least one pair of blocks.
    """
    mine = F.pmod(F.xxhash64("rep"), F.col(blocks))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))
    return (
        rows.withColumn("_mine", mine)
        .withColumn("_other", other)
        .withColumn("_i", F.least("_mine", "_other"))
        .withColumn("_j", F.greatest("_mine", "_other"))
        .withColumn("_group", F.xxhash64(key, "_i", "_j"))
        .drop("_other")
    )


def _stars(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> pa.RecordBatch | None:
    """Edges (member, smallest member) of the connected parts over positions a, b."""
    if len(a) == 0:
        return None
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[: len(a)], flat[len(a) :]
    order = np.argsort(ids[nodes], kind="stable")
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    label = rank.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[order[new]])
        if (new == label).all():
            break
        label = new
    hung = label != rank
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[nodes][hung]), pa.array(ids[nodes[order]][label[hung]])], names=["a", "b"]
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut so that no group (sorted column ``_group``) lies in two of them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        group = b.column("_group").to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(group == group[-1], True))
        if last == 0 and held and held[-1].column("_group")[0].as_py() == group[0]:
            held.append(b)
            continue
        if last or held:
            whole = pa.Table.from_batches([*held, *([b.slice(0, last)] if last else [])])
            yield whole
        held = [b.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _likely(size: np.ndarray, sig: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes allow the similarity and the estimate comes near it."""
    small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
    ok = 100 * small >= percent * large
    ok[ok] = similarity(sig[a[ok]], sig[b[ok]]) >= percent / 100 - MARGIN
    return ok


def _pairs(group: np.ndarray, mine: np.ndarray, crossing: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions in one group; of a pair of blocks those across only."""
    n, shift = len(group), 1
    while shift < n:
        a = np.flatnonzero(group[:-shift] == group[shift:])
        if len(a) == 0:
            return
        b = a + shift
        keep = ~crossing[a] | (mine[a] != mine[b])
        yield a[keep], b[keep]
        shift += 1


def _bucket_links(percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            ids, size, group, i, j, mine = (
                t.column(c).to_numpy() for c in ("rep", "n_shingles", "_group", "_i", "_j", "_mine")
            )
            sig = _wide(t.column("_sig"), SIGNATURE_WORDS)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in _pairs(group, mine, i != j):
                ok = _likely(size, sig, a, b, percent)
                found.append((a[ok], b[ok]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                # The same two documents share many buckets; the star needs no order.
                stars = _stars(a, b, ids)
                if stars is not None and stars.num_rows:
                    yield stars

    return links


def candidate_edges(reps: DataFrame, percent: int) -> DataFrame:
    """Edges that connect every two representatives that share a bucket and look alike."""
    rows = reps.select("rep", F.posexplode(_split("_bands", BANDS)).alias("_band", "_key"))
    sized = rows.select("rep", "_key").withColumn(
        "_n", F.count("*").over(_by("_key"))
    ).where("_n > 1")
    blocks = F.ceil(F.col("_n") / MEMBERS_PER_BLOCK).cast("bigint")
    full = sized.withColumn("_blocks", blocks).join(reps.select("rep", "n_shingles", "_sig"), "rep")
    dealt = _spread(full, "_key", "_blocks").select(
        "rep", "n_shingles", "_sig", "_i", "_j", "_mine", "_group"
    )
    kind = reps.schema["rep"].dataType.simpleString()
    return (
        dealt.repartition("_group")
        .sortWithinPartitions("_group", "rep")
        .mapInArrow(_bucket_links(percent), f"a {kind}, b {kind}")
    )


def _by(*cols):
    from pyspark.sql import Window

    return Window.partitionBy(*cols)


def _split(name: str, words: int):
    """The 64-bit words of a binary column as strings of 8 bytes."""
    return F.array(*[F.substring(name, 8 * k + 1, 8) for k in range(words)])


def _confirm(percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            ids, group, i, j, mine, one, two = (
                t.column(c).to_numpy() for c in ("rep", "_group", "_i", "_j", "_mine", "_one", "_two")
            )
            size = t.column("n_shingles").to_numpy()
            sig = _wide(t.column("_sig"), SIGNATURE_WORDS)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
            out_a, out_b = [], []
            for low, high in zip(edges[:-1], edges[1:]):
                values, at = _unique(*S.batch_shingles(t.column("text").slice(low, high - low).combine_chunks()))
                if not len(values):
                    continue
                sets = [values[x:y] for x, y in zip(at[:-1], at[1:])]
                held = np.flatnonzero(np.diff(at) > 0)
                right = np.zeros(high - low, bool)
                first, second = _digests(values, at[:-1][held])
                # Under a repeated doc_id there may be a text of another class.
                right[held] = (first.view(np.int64) == one[low:high][held]) & (
                    second.view(np.int64) == two[low:high][held]
                )
                parent = np.arange(high - low)

                def root(x: int) -> int:
                    while parent[x] != x:
                        parent[x] = parent[parent[x]]
                        x = parent[x]
                    return x

                part = slice(low, high)
                for a, b in _pairs(group[part], mine[part], i[part] != j[part]):
                    ok = right[a] & right[b]
                    ok[ok] = _likely(size[part], sig[part], a[ok], b[ok], percent)
                    for x, y in zip(a[ok].tolist(), b[ok].tolist()):
                        p, q = root(x), root(y)
                        if p == q:
                            continue
                        both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                        if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                            parent[p] = q
                            out_a.append(ids[low + x])
                            out_b.append(ids[low + y])
            if out_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(out_a)), pa.array(np.array(out_b))], names=["a", "b"]
                )

    return links


def confirmed_edges(clusters: DataFrame, reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links between representatives of a candidate cluster, confirmed on the full sets.

    Of the links in a pair of blocks a spanning forest is returned.
    """
    known = clusters.select(F.col("id").alias("rep"), "component").join(
        reps.select("rep", "n_shingles", "_sig", "_one", "_two"), "rep"
    )
    total = known.groupBy("component").agg(F.sum("n_shingles").alias("_sum"), F.count("*").alias("_count"))
    blocks = F.ceil(F.greatest(F.col("_sum") / SHINGLES_PER_BLOCK, F.col("_count") / MEMBERS_PER_BLOCK))
    known = known.join(total, "component").withColumn("_blocks", blocks.cast("bigint"))
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(known, "rep")
    dealt = _spread(texts, "component", "_blocks").select(
        "rep", "n_shingles", "_sig", "_one", "_two", "_i", "_j", "_mine", "_group", "text"
    )
    kind = reps.schema["rep"].dataType.simpleString()
    return (
        dealt.repartition("_group")
        .sortWithinPartitions("_group", "rep")
        .mapInArrow(_confirm(percent), f"a {kind}, b {kind}")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Two documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of
    distinct five-word shingles (a shorter text is one shingle); ``component_id`` is the
    smallest doc_id reachable over links.  Texts that are null, empty or without a word
    have no shingle and no link.  A row without doc_id is linked to nothing: component
    NULL, kept.  Rows that repeat a doc_id are one document with the links of all its
    texts; each row keeps its own n_shingles.  Other columns are ignored.
    """
    kind = dict(docs.dtypes)[doc_id]
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = cut_lineage(signatures(docs))
    used = signed.where("doc_id is not null and n_shingles > 0")
    key = ["_one", "_two", "n_shingles"]
    # Equal sets have equal bands and signatures: any one of them will do.
    reps = cut_lineage(
        used.groupBy(*key).agg(
            F.min("doc_id").alias("rep"), F.first("_bands").alias("_bands"), F.first("_sig").alias("_sig")
        )
    )
    members = used.select("doc_id", *key).join(reps.select("rep", *key), key).select("doc_id", "rep")
    members = cut_lineage(members.distinct())
    # The texts of a repeated doc_id belong together; a doc_id may also stand for two classes.
    several = members.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("_max"))
    several = several.where("b <> _max").drop("_max")
    joined = members.join(several, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b")
    candidates = components(candidate_edges(reps, percent))
    links = confirmed_edges(candidates, reps, docs, percent)
    found = components(links.unionAll(joined))
    place = (
        members.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("component", "rep")).cast(kind).alias("_component"))
    )
    return (
        signed.select("doc_id", "n_shingles")
        .join(place, "doc_id", "left")
        .select(
            "doc_id", "n_shingles",
            F.coalesce("_component", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("_component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
      ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id
  GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)),
g AS (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e),
reach AS (
  WITH RECURSIVE r(u, v) AS (SELECT u, v FROM g UNION SELECT r.u, g.v FROM r JOIN g ON r.v = g.u)
  SELECT u, min(v) AS m FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(m, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.u = d.doc_id
"""
