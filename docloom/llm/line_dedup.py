"""Lines that many documents share, dropped from all but one of them.

Lines are exploded, normalised and hashed to 128 bits; distinct documents are counted
per hash and the lines over the threshold come back as positions of their documents,
from which the text is put together again in order.  Only hashes and positions are
counted and joined; a document's text is shuffled once, to meet its positions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.common import BLANKS, cut_lineage, read

MIN_CHARS, MIN_DOCS = 40, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII takes the quick function."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(t, at):
        if t is None or at is None:
            return None
        gone = set(at.tolist())
        return "\n".join(line for i, line in enumerate(t.split("\n")) if i not in gone)

    return pd.Series([one(t, at) for t, at in zip(text, dropped)], dtype=object)


def shared_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, _row, _dropped): positions of the lines that a text loses."""
    lines = docs.select("doc_id", "_row", F.posexplode(F.split("_text", "\n")).alias("_at", "_line"))
    lines = lines.where(F.col("doc_id").isNotNull()).withColumn("_line", F.btrim("_line", F.lit(BLANKS)))
    lines = lines.where(F.length("_line") >= min_chars).withColumn("_line", _ascii_lower(F.col("_line")))
    hashed = cut_lineage(
        lines.select(
            "doc_id", "_row", "_at",
            F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(7), "_line").alias("_h2"),
        )
    )
    common = (
        hashed.groupBy("_h1", "_h2")
        .agg(F.count_distinct("doc_id").alias("_docs"), F.max("doc_id").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
        .select("_h1", "_h2", "_keeper")
    )
    lost = hashed.join(common, ["_h1", "_h2"]).where(F.col("doc_id") != F.col("_keeper"))
    return lost.groupBy("doc_id", "_row").agg(F.collect_set("_at").alias("_dropped"))


def drop_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, kept, n_lines, n_dropped) for every row.

    A line's key is the line without space and \\t..\\r at its ends, A-Z lower-cased.  Keys
    of ``min_chars`` code points or more, found in ``min_docs`` different documents or
    more, lose all their lines except in the largest doc_id that holds them.  A null or
    empty text is one empty line and gives an empty text.  Rows without a doc_id are
    not counted and keep all lines.  Rows that repeat a doc_id count as one document, and
    each loses the same lines.  Other columns are ignored.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), plain.alias("_text"))
    # Repeated doc_ids are told apart by their text.
    rows = rows.withColumn("_row", F.xxhash64("_text"))
    lost = shared_lines(rows, min_chars, min_docs)
    found = rows.join(lost, ["doc_id", "_row"], "left")
    changed = _without(F.when(F.col("_dropped").isNotNull(), F.col("_text")), F.col("_dropped"))
    breaks = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit("")))
    return found.select(
        "doc_id",
        F.coalesce(changed, "_text").alias("kept"),
        (breaks + 1).cast("bigint").alias("n_lines"),
        F.when(F.col("_dropped").isNotNull(), F.size("_dropped")).otherwise(0).cast("bigint").alias("n_dropped"),
    )


def rewrite(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
) -> DataFrame:
    """``docs`` with the same columns, ``text`` without its shared lines and ``n_chars`` to match.

    The rules are those of ``drop_shared_lines``; texts that lose nothing, null ones among
    them, and their ``n_chars`` are left as they are.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), plain.alias("_text")).withColumn("_row", F.xxhash64("_text"))
    lost = shared_lines(rows, min_chars, min_docs).select(
        F.col("doc_id").alias("_lost_id"), F.col("_row").alias("_lost_row"), F.col("_dropped").alias("_lost_lines")
    )
    own = lambda c: F.col(f"_docs.`{c}`")
    whole = F.coalesce(own(text).cast("string"), F.lit(""))
    met = docs.alias("_docs").join(
        lost, (own(doc_id) == F.col("_lost_id")) & (F.xxhash64(whole) == F.col("_lost_row")), "left"
    )
    hit = F.col("_lost_lines").isNotNull()
    shorter = _without(F.when(hit, whole), F.col("_lost_lines"))
    new = {text: F.when(hit, shorter).otherwise(own(text))}
    if n_chars in docs.columns:
        new[n_chars] = F.when(hit, F.length(shorter).cast("bigint")).otherwise(own(n_chars))
    return met.select(*[new.get(c, own(c)).alias(c) for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH l AS (
  SELECT doc_id, i AS pos, string_split(coalesce(text, ''), chr(10))[i] AS line,
    translate(trim(string_split(coalesce(text, ''), chr(10))[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS t(i)),
c AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, c.keeper IS NOT NULL AND c.keeper <> doc_id AS gone FROM l LEFT JOIN c USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
