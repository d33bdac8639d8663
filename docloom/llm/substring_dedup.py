"""Passages that an earlier document holds, found with a compressed FM-index for each shard.

A text is routed by its windows: a window's key is the smallest hash of its few-word grams, so
equal windows have one key wherever they stand, and neighbouring windows with one key form a
segment.  Only segments whose key stands in two documents go on.  A shard is a share of
the keys; its segments are indexed (``fm_index``) and streamed through the index, which
gives their matching statistics and, where a whole window matches, the smallest document
among the matches.  What comes back are intervals of words.

Volumes: a key is sent once for each batch of documents that holds it, not once for each
document; segments travel packed, equal ones of a task once; a text is shuffled once, by
its document.  Keys with so many documents that one shard could not hold them (HOT_DOCS, and
more than 2^-20 of all) are split: their windows are counted one by one, by 128 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import shingles as S
from docloom.llm.common import cut_lineage, read
from docloom.llm.fm_index import FMIndex

WINDOW = 13
#: Words of the grams whose smallest hash is a window's key.
GRAM = 5
#: Windows of a segment, at most.
LONGEST = 20
#: Words of a shard, on average.
SHARD_WORDS = 1 << 21
#: Documents of a key from which its windows are split; the list of such keys has 2^20 entries at most.
HOT_DOCS, HOT_SHARE = 16_384, 1 << 20
#: Segments that a task packs at once.
_PACK = 1 << 19
_U = np.uint64


class Segments:
    """Stretches of windows with one key in a batch of texts: arrays by segment.

    ``doc`` is the text, ``at`` the first word counted from the text's begin, ``first`` counted from
    the batch's, ``windows`` the number of windows, ``key`` their key.
    """

    def __init__(self, texts: pa.Array, window: int):
        self.words, self.begin = S.batch_words(texts, fold=False)
        n = len(self.words)
        gram = min(GRAM, window)
        self.doc = self.at = self.first = self.windows = np.empty(0, np.int64)
        self.key = np.empty(0, _U)
        starts = n - window + 1
        if starts <= 0:
            return
        factors = S.constants(gram, 11)
        grams = np.zeros(n - gram + 1, _U)
        for k in range(gram):
            grams += self.words[k : n - gram + 1 + k] * factors[k]
        key = _sliding_minima(S.mix(grams), window - gram + 1)
        doc = np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))
        whole = doc[:starts] == doc[window - 1 :]
        new = np.ones(starts, bool)
        new[1:] = (key[1:] != key[:-1]) | ~whole[:-1] | ~whole[1:]
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, starts))
        used = whole[first]
        first, length = first[used], length[used]
        # Long stretches of one key (repetitive texts) are cut.
        pieces = -(-length // LONGEST)
        step = _within(pieces) * LONGEST
        length = np.minimum(np.repeat(length, pieces) - step, LONGEST)
        self.first = np.repeat(first, pieces) + step
        self.windows, self.key, self.doc = length, key[self.first], doc[self.first]
        self.at = self.first - self.begin[self.doc]


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. for each count, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, deflated."""
    return zlib.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 1)


def _unpack(packed: bytes, dtype) -> np.ndarray:
    item = np.dtype(dtype).itemsize
    planes = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(item, -1).T).view(dtype).reshape(-1)


def _keys(window: int):
    """For each text, the segments whose key another document of the batch holds, and the keys to compare elsewhere.

    A key of several documents is sent once, in no segment's name: its ``segment`` is their number below zero.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = Segments(b["text"], window)
            order = np.argsort(found.key, kind="stable")
            _, document = np.unique(b["doc_id"].to_numpy(), return_inverse=True)
            own = document[found.doc] if len(found.doc) else np.empty(0, np.int64)
            key, own = found.key[order], own[order]
            edge = np.ones(len(key), bool)
            edge[1:] = key[1:] != key[:-1]
            group = np.cumsum(edge) - 1
            at = np.flatnonzero(edge)
            pairs = np.unique(group * max(1, len(b)) + own)
            documents = np.bincount(pairs // max(1, len(b)), minlength=len(at))
            local = np.empty(len(key), bool)
            local[order] = (documents > 1)[group]
            # One line for a key of several documents, one for each segment of the others.
            sent = np.zeros(len(key), bool)
            sent[order[at]] = True
            sent |= ~local
            count = np.empty(len(key), np.int64)
            count[order] = documents[group]
            n = len(b)
            number = _within(np.bincount(found.doc, minlength=n))

            def lists(mask, values, kind):
                ends = np.concatenate([[0], np.cumsum(np.bincount(found.doc[mask], minlength=n))])
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[mask], kind))

            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"],
                    lists(local, number, pa.int32()),
                    lists(sent, found.key.view(np.int64), pa.int64()),
                    lists(sent, np.where(local, -count, number), pa.int32()),
                ],
                names=["doc_id", "here", "key", "segment"],
            )

    return scan


_KEYS = "doc_id long, here array<int>, key array<long>, segment array<int>"


def _chosen(b: pa.RecordBatch, window: int) -> tuple[Segments, np.ndarray]:
    """The segments of a batch and which of them its column ``segments`` names."""
    found = Segments(b["text"], window)
    lists = b["segments"]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(found.doc, minlength=len(b)))])
    named = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(b)), lists.value_lengths().fill_null(0).to_numpy())
    at = bounds[row] + named
    # Rows that repeat an id share its list, whose numbers may pass the end of a shorter text.
    at = at[at < bounds[row + 1]]
    chosen = np.zeros(len(found.key), bool)
    chosen[at] = True
    return found, chosen


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _packed(shards: int, hot: np.ndarray, window: int):
    """The chosen segments of texts, packed by shard; those of hot keys are left to ``_windows``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            found, chosen = _chosen(b, window)
            chosen &= ~_in_sorted(found.key, hot)
            length = found.windows[chosen] + window - 1
            at = np.repeat(found.first[chosen], length) + _within(length)
            doc = found.doc[chosen]
            held.append(
                (
                    (found.key[chosen] % _U(shards)).astype(np.int64), b["doc_id"].to_numpy()[doc],
                    b["digest"].to_numpy()[doc], found.at[chosen].astype(np.int32), length, found.words[at],
                )
            )
            size += len(doc)
            if size >= _PACK:
                yield _blobs(held)
                held, size = [], 0
        if size:
            yield _blobs(held)

    return scan


_BLOB = "shard long, doc_id binary, digest binary, at binary, sequence binary, length binary, code binary, word binary"


def _blobs(held: list) -> pa.RecordBatch:
    """One row for each shard: its segments' places, distinct sequences, and words by their number."""
    shard, doc_id, digest, at, length, words = (np.concatenate(x) for x in zip(*held))
    start = np.cumsum(length) - length
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    rows = []
    for own in np.split(order, cuts[1:]):
        size = length[own]
        mine = words[np.repeat(start[own], size) + _within(size)]
        names, code = np.unique(mine, return_inverse=True)
        first, which = _distinct(mine, size)
        kept = np.zeros(len(own), bool)
        kept[first] = True
        rows.append(
            [int(shard[own[0]])]
            + [
                _pack(x)
                for x in (
                    doc_id[own], digest[own], at[own], which.astype(np.int32), size[first].astype(np.uint8),
                    code[np.repeat(kept, size)].astype(np.int32), names,
                )
            ]
        )
    kinds = [pa.int64()] + [pa.binary()] * 7
    names = [c.split()[0] for c in _BLOB.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)


def _distinct(words: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first of each different sequence in their order, and each sequence's number among them)."""
    width = int(length.max())
    table = np.zeros((len(length), width + 1), words.dtype)
    table[np.repeat(np.arange(len(length)), length), _within(length)] = words
    table[:, width] = length
    rows = table.view(np.dtype((np.void, table.itemsize * (width + 1)))).ravel()
    _, first, which = np.unique(rows, return_index=True, return_inverse=True)
    order = np.argsort(first)
    number = np.empty(len(first), np.int64)
    number[order] = np.arange(len(first))
    return first[order], number[which]


def _search(window: int):
    """Intervals of words that a smaller document holds, from all blobs of a shard."""

    def shard(table: pa.Table) -> pa.Table:
        columns = {c: [] for c in ("doc_id", "digest", "at", "sequence", "length", "word")}
        sequences = 0
        for blob in table.to_pylist():
            code = _unpack(blob["code"], np.int32)
            columns["word"].append(_unpack(blob["word"], _U)[code])
            columns["sequence"].append(_unpack(blob["sequence"], np.int32) + sequences)
            columns["length"].append(_unpack(blob["length"], np.uint8).astype(np.int64))
            sequences += len(columns["length"][-1])
            columns["doc_id"].append(_unpack(blob["doc_id"], np.int64))
            columns["digest"].append(_unpack(blob["digest"], np.int32))
            columns["at"].append(_unpack(blob["at"], np.int32))
        doc_id, digest, at, sequence, length, word = (np.concatenate(x) for x in columns.values())
        ids, document = np.unique(doc_id, return_inverse=True)
        names, code = np.unique(word, return_inverse=True)
        # Sequences that several tasks sent are indexed once.
        first, same = _distinct(code.astype(np.int32) + 1, length)
        kept = np.zeros(sequences, bool)
        kept[first] = True
        code, sequence, length = code[np.repeat(kept, length)], same[sequence], length[first]
        least = np.full(len(first), len(ids), np.int64)
        np.minimum.at(least, sequence, document)
        # Code 0 ends a sequence.
        begin = np.cumsum(length + 1) - (length + 1)
        place = np.repeat(begin, length) + _within(length)
        text = np.zeros(int((length + 1).sum()), np.int64)
        text[place] = code + 1
        index = FMIndex(text, np.repeat(least, length + 1), len(names) + 1, len(ids), window)
        windows = length - window + 1
        ends = np.repeat(begin + window - 1, windows) + _within(windows)
        matched, low, high = index.matching_statistics(text, ends, window)
        holder = np.repeat(least, windows)
        full = np.flatnonzero(matched == window)
        holder[full] = index.documents.smallest(low[full], high[full])
        # Every place of a sequence against the smallest holder of each of its windows.
        count = windows[sequence]
        of = np.repeat(np.arange(len(sequence)), count)
        offset = _within(count)
        from_first = np.cumsum(windows) - windows
        hit = holder[from_first[sequence[of]] + offset] < document[of]
        of, offset = of[hit], offset[hit]
        return _intervals(of, at[of] + offset, doc_id, digest, window)

    return shard


_INTERVALS = "doc_id long, digest int, begin int, length int"


def _intervals(of: np.ndarray, start: np.ndarray, doc_id: np.ndarray, digest: np.ndarray, window: int) -> pa.Table:
    """Windows that follow each other in one segment as one interval of words."""
    edge = np.ones(len(of), bool)
    edge[1:] = (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(of)) - 1 if len(first) else first
    begin = start[first]
    return pa.table(
        {
            "doc_id": pa.array(doc_id[of[first]], pa.int64()), "digest": pa.array(digest[of[first]], pa.int32()),
            "begin": pa.array(begin, pa.int32()), "length": pa.array(start[last] - begin + window, pa.int32()),
        }
    )


def _windows(hot: np.ndarray, window: int):
    """The windows of hot keys, each with 128 bits of its words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = [S.constants(window, seed) for seed in (21, 22)]
        for b in batches:
            found, chosen = _chosen(b, window)
            chosen &= _in_sorted(found.key, hot)
            count = found.windows[chosen]
            step = _within(count)
            first = np.repeat(found.first[chosen], count) + step
            doc = np.repeat(found.doc[chosen], count)
            hashes = []
            for own in factors:
                value = np.zeros(len(first), _U)
                for k in range(window):
                    value += found.words[first + k] * own[k]
                hashes.append(S.mix(value).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"].take(pa.array(doc)), b["digest"].take(pa.array(doc)),
                    pa.array((np.repeat(found.at[chosen], count) + step).astype(np.int32)),
                    pa.array(hashes[0]), pa.array(hashes[1]),
                ],
                names=["doc_id", "digest", "begin", "h1", "h2"],
            )

    return scan


def repeated_intervals(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, digest, begin, length): intervals of words whose windows a smaller doc_id holds as well.

    ``rows`` has (doc_id, text, digest), doc_id never null; intervals may touch and overlap.
    """
    scanned = rows.select("doc_id", "text").mapInArrow(_keys(window), _KEYS)
    # A key has one line a batch at most, or one for each of a document's own repeats: too few to combine before the
    # shuffle, so the lines are dealt out as they are and no lists of places are built on the way.
    each = scanned.select("doc_id", F.explode(F.arrays_zip("key", "segment")).alias("s")).select("s.key", "doc_id", "s.segment")
    documents = F.sum(F.when(F.col("segment") < 0, -F.col("segment")).otherwise(1))
    shared = cut_lineage(
        each.repartition("key")
        .groupBy("key")
        .agg(
            documents.alias("documents"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("segment").alias("least"),
            F.collect_list(F.when(F.col("segment") >= 0, F.struct("doc_id", "segment"))).alias("places"),
        )
        .where("low < high or least < 0")
        .select("key", "documents", "places")
    )
    total = shared.agg(F.sum("documents")).first()[0] or 0
    limit = max(HOT_DOCS, total // HOT_SHARE)
    hot = np.sort(
        np.array([r.key for r in shared.where(F.col("documents") > limit).select("key").toLocalIterator()], np.int64).view(_U)
    )
    elsewhere = shared.select(F.explode("places").alias("p")).groupBy("p.doc_id").agg(
        F.collect_list("p.segment").alias("segments")
    )
    here = scanned.where(F.size("here") > 0).select("doc_id", F.col("here").alias("segments"))
    chosen = here.unionAll(elsewhere).groupBy("doc_id").agg(F.flatten(F.collect_list("segments")).alias("segments"))
    met = rows.join(chosen, "doc_id").select("doc_id", "digest", "text", "segments")
    shards = max(1, int(total * (GRAM + window) // SHARD_WORDS))
    hot_keys = rows.sparkSession.sparkContext.broadcast(hot)
    blobs = met.mapInArrow(_from_broadcast(_packed, hot_keys, shards, window), _BLOB)
    found = blobs.groupBy("shard").applyInArrow(_search(window), _INTERVALS)
    if not len(hot):
        return found
    single = met.mapInArrow(_from_broadcast(_windows, hot_keys, None, window), "doc_id long, digest int, begin int, h1 long, h2 long")
    least = single.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    later = single.join(least, ["h1", "h2"]).where("least < doc_id")
    return found.unionAll(later.select("doc_id", "digest", "begin", F.lit(window).alias("length")))


def _from_broadcast(make, hot, shards, window):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make(hot.value, window) if shards is None else make(shards, hot.value, window)
        yield from own(batches)

    return scan


_KEPT = T.StructType(
    [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
)


@F.pandas_udf(_KEPT)
def _without(text: pd.Series, begin: pd.Series, length: pd.Series) -> pd.DataFrame:
    out = []
    for t, starts, sizes in zip(text, begin, length):
        # On bytes, blanks are space and \t..\r only.
        words = (t or "").encode().split()
        n = len(words)
        if starts is not None and len(starts):
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + sizes, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:n]) == 0)]
        out.append((b" ".join(words).decode(), n, n - len(words)))
    return pd.DataFrame(out, columns=["kept", "n_words", "n_removed"])


def drop_repeated_passages(
    docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row.

    Words are runs of anything but space and \\t..\\r, as they stand.  Every word goes that lies in
    a window of ``window`` words which a document with a smaller doc_id holds as well; windows
    are judged on the input.  ``kept`` has the words left, joined by one space.  A null or empty text
    has no words.  A text shorter than a window, and a row without a doc_id, keep all
    words and take none from others.  Rows that repeat a doc_id are judged each by itself and
    take nothing from each other.  Repeats inside a document alone stay.  Other columns
    are ignored.
    """
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = plain.where(F.col("doc_id").isNotNull()).withColumn("digest", F.hash("text"))
    found = repeated_intervals(rows, window)
    places = found.groupBy("doc_id").agg(F.collect_list(F.struct("digest", "begin", "length")).alias("places"))
    met = rows.join(places, "doc_id", "left")
    own = F.filter(F.col("places"), lambda p: p["digest"] == F.col("digest"))
    named = _kept(met.select("doc_id", "text", own.alias("places")))
    return named.unionAll(_kept(plain.where(F.col("doc_id").isNull()).withColumn("places", F.lit(None).cast(_PLACES))))


_PLACES = "array<struct<digest:int,begin:int,length:int>>"


def _kept(rows: DataFrame) -> DataFrame:
    done = rows.select("doc_id", _without("text", _field("begin"), _field("length")).alias("r"))
    return done.select("doc_id", "r.n_words", "r.n_removed", "r.kept")


def _field(name: str) -> Column:
    return F.transform(F.coalesce(F.col("places"), F.array().cast(_PLACES)), lambda p: p[name])


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_passages(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS k FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
m AS (SELECT k, min(doc_id) AS least FROM p GROUP BY k HAVING min(doc_id) < max(doc_id)),
h AS (SELECT DISTINCT doc_id, i + j AS pos FROM p JOIN m USING (k), unnest(range(0, 13)) AS t(j) WHERE least < doc_id),
g AS (SELECT doc_id, list(pos) AS gone FROM h GROUP BY doc_id),
o AS (
  SELECT d.doc_id, w, gone, list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(gone, i) THEN NULL ELSE x END),
    lambda x: x IS NOT NULL) AS kept
  FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM o
"""
