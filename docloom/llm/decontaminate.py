"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is far shorter than a document, so their similarity says little; what counts is
the share of the item's shingles that the document holds, wherever they lie in it.
A document that holds ``percent`` of n shingles lacks at most n * (100 - percent) / 100, so of any one more
than that it holds at least one.  The MinHash sketch of an item is that many of its smallest
hashes; its length is set for each size part, by the part's largest size.  Sharing a
member of the sketch makes a candidate, and no document that holds enough is missed.  A
candidate is confirmed by counting the item's shingles in the whole document.

The shingles of documents are looked up in a bitmap whose size follows the number of item
shingles, up to a bound, before anything is shuffled.  What passes are shingles of items
and few others, which the join drops; it depends on the document alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import shingles as S
from docloom.llm.common import cut_lineage, read

#: Bits of the bitmap for each item shingle, and the bounds of all of them (the larger is 128 MB).
BITS_PER_SHINGLE, BITMAP_BITS = 64, (1 << 20, 1 << 30)
_PAGE = 32768
_DOCS_AT_ONCE = 1024
_U = np.uint64


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        values, at = S.batch_shingles(b.column(1))
        row = np.repeat(np.arange(b.num_rows), np.diff(at))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(row)), pa.array(values.view(np.int64))], names=["item_id", "hash"]
        )


def sketch_length(n: Column, percent: int) -> Column:
    """Members of the sketches of the size part of ``n``: sizes from one power of two to the next are a part."""
    largest = F.pow(F.lit(2.0), F.length(F.bin(n))) - 1
    return F.floor(largest * (100 - percent) / 100) + 1


def index_items(items: DataFrame, percent: int = 80, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, hash, n_item, sketch): an item's shingles; ``sketch`` marks its smallest hashes."""
    kind = items.schema[item_id].dataType.simpleString()
    rows = (
        items.where(F.col(item_id).isNotNull())
        .select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
        .mapInArrow(_shingles, f"item_id {kind}, hash bigint")
        .distinct()
    )
    # Hashes are compared as the signed numbers they are stored as; any fixed order serves.
    held = rows.groupBy("item_id").agg(F.sort_array(F.collect_list("hash")).alias("_all"))
    named = held.select("item_id", F.size("_all").cast("bigint").alias("n_item"), F.posexplode("_all").alias("_at", "hash"))
    return named.select("item_id", "hash", "n_item", (F.col("_at") < sketch_length(F.col("n_item"), percent)).alias("sketch"))


def bitmap(index: DataFrame) -> np.ndarray:
    """Bits for the shingles of all items, two for each, by different bits of the hash.

    Built by aggregation; the driver gets pages, whose number has the bound of BITMAP_BITS.
    """
    n = index.count() * BITS_PER_SHINGLE
    bits = min(BITMAP_BITS[1], max(BITMAP_BITS[0], 1 << n.bit_length()))
    places = F.array(*[F.pmod(h, F.lit(bits)) + 1 for h in (F.col("hash"), F.shiftrightunsigned("hash", 32))])
    pages = (
        index.select(F.explode(places).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    table = np.zeros(bits // 8, np.uint8)
    for row in pages.toLocalIterator():
        at = (row.page - 1) * (_PAGE // 8)
        table[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return table


def _in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    def held(part: np.ndarray) -> np.ndarray:
        place = (part & _U(8 * len(bits) - 1)).astype(np.int64)
        return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0

    at = np.flatnonzero(held(values))
    return at[held(values[at] >> _U(32))]


def _evidence(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in batches:
            for first in range(0, b.num_rows, _DOCS_AT_ONCE):
                part = b.slice(first, _DOCS_AT_ONCE)
                values, at = S.batch_shingles(part.column(1))
                inside = _in(bits, values)
                if not len(inside):
                    continue
                doc = np.searchsorted(at, inside, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(values[inside].view(np.int64))], names=["doc_id", "hash"]
                )

    return scan


def contained_items(
    docs: DataFrame, items: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(item_id, doc_id, n_item, n_common, containment): items of which a document holds enough.

    100 * |I & D| >= percent * |I| over distinct five-word shingles; a text of one to four
    words is one shingle, its whole sequence.  Items or documents that are null, empty
    or without a word have none and are never found; rows without an id take no
    part.  Rows that repeat an id are one item or document with the shingles of all its
    texts.  ``percent`` is 1 to 100.  Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    index = cut_lineage(index_items(items, percent))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(index))
    hits = (
        docs.where(F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
        .mapInArrow(_evidence(shared), f"doc_id {kind}, hash bigint")
        .distinct()
    )
    return (
        hits.join(index, "hash")
        .groupBy("doc_id", "item_id", "n_item")
        .agg(F.count("*").alias("n_common"), F.bool_or("sketch").alias("_candidate"))
        .where(F.col("_candidate") & (F.col("n_common") * 100 >= F.col("n_item") * percent))
        .select(
            "item_id", "doc_id", "n_item", "n_common",
            (F.col("n_common") / F.col("n_item")).alias("containment"),
        )
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL = """
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (
  SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM t),
s AS (
  SELECT DISTINCT kind, id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
      ELSE array_to_string(ws[i:i + 4], ' ') END AS sh, len(ws) < 5 AS short
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY id),
c AS (
  SELECT i.id AS item_id, d.id AS doc_id, count(*) AS n_common
  FROM s i JOIN s d ON i.sh = d.sh AND i.short = d.short AND i.kind = 'i' AND d.kind = 'd' GROUP BY ALL)
SELECT item_id, doc_id, n_item, n_common, n_common / n_item AS containment
FROM c JOIN n ON n.id = item_id WHERE n_common * 100 >= n_item * 80
"""
