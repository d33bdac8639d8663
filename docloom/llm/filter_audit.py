"""How quality filters act on each other, for every order of applying them.

Each filter stores one table of the ids that fail it, in the shared folder.  What a filter
removes after a prefix of others depends on the prefix as a set, so all orders come from
the removals of each filter after each set: its failing ids, anti joined with the
tables of the filters in the set.  The sets travel as bit masks beside the ids: one anti join
with another filter's table serves all sets that hold it, and semi joins with the labelled
ids give the label losses.  Survivors are the documents anti joined in the same way.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import read, shared_path

WORDS = r"[^\x20\x09-\x0D]+"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
NAMES = "ABCDE"


def measured(docs: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """(doc_id, digest, part, A, B, C, D): which documents fail by their own text; null texts are empty."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(plain, 256)).alias("digest"), plain.alias("_text"),
        F.regexp_extract_all(plain, F.lit(WORDS), F.lit(0)).alias("_words"),
    )
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    return words.select(
        "doc_id", "digest", "part",
        (n < MIN_WORDS).alias("A"),
        (100 * distinct < MIN_DISTINCT_PERCENT * n).alias("B"),
        (100 * F.regexp_count("_text", F.lit("[A-Z]")) > MAX_CAPITALS_PERCENT * F.length("_text")).alias("C"),
        F.col("_text").rlike(SYMBOLS).alias("D"),
    )


class Failures:
    """The audited documents and one table of failing ids for each filter, written to the shared folder.

    A document's key is the digest of its text and its id, so rows that repeat an id are
    judged each by its own text.  A null id is compared with nothing by E.
    """

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"):
        spark = docs.sparkSession
        self.folder = shared_path(spark, "filter-audit")
        measured(docs, doc_id, text, part).write.parquet(f"{self.folder}/measured")
        rows = spark.read.parquet(f"{self.folder}/measured")
        named = F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")
        self.documents = rows.withColumn("key", F.concat("digest", named))
        # The least id of a text is found before the shuffle.  It is written, so that the join back has a shuffle on both
        # sides and Spark can split it where a text is hot.
        least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
        least.select("digest", "least").write.parquet(f"{self.folder}/least")
        least = spark.read.schema("digest binary, least bigint").parquet(f"{self.folder}/least")
        copies = self.documents.join(least, "digest").where("doc_id > least")
        own = F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in "ABCD"]), lambda f: f.isNotNull())
        kept = ["key", "doc_id", "part"]
        failing = self.documents.select(*kept, F.explode(own).alias("filter"))
        failing = failing.unionAll(copies.select(*kept, F.lit("E").alias("filter")))
        # A folder for each filter.
        failing.write.partitionBy("filter").parquet(f"{self.folder}/failing")
        self.all_failing = spark.read.schema("key binary, doc_id bigint, part string, filter string").parquet(
            f"{self.folder}/failing"
        )

    def table(self, name: str) -> DataFrame:
        return self.all_failing.where(F.col("filter") == name).drop("filter")

    def after(self, rows: DataFrame, others: str) -> DataFrame:
        """``rows`` under every subset of ``others`` (``mask``, a bit for each filter), without what the subset removes.

        Rows are dealt out by key before they are multiplied, so all joins find them in place.
        """
        bits = [1 << NAMES.index(name) for name in others]
        masks = sorted(sum(b for i, b in enumerate(bits) if chosen >> i & 1) for chosen in range(1 << len(bits)))
        rows = rows.repartition("key").withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks])))
        for name, bit in zip(others, bits):
            ids = self.table(name).select(F.col("key").alias("_key"))
            rows = rows.join(ids, (F.col("key") == F.col("_key")) & (F.col("mask").bitwiseAND(bit) != 0), "left_anti")
        return rows


def removals(failures: Failures, labels: DataFrame) -> DataFrame:
    """(part, filter, mask, removed, good, toxic): what each filter removes after each set of others."""
    spark = labels.sparkSession
    each = None
    for name in NAMES:
        removed = failures.after(failures.table(name), NAMES.replace(name, ""))
        removed = removed.select("doc_id", "part", F.lit(name).alias("filter"), "mask")
        each = removed if each is None else each.unionAll(removed)
    each.write.parquet(f"{failures.folder}/removed")
    each = spark.read.parquet(f"{failures.folder}/removed")
    kinds = {"removed": each}
    for kind, condition in (("good", "quality = 1"), ("toxic", "toxic = 1")):
        ids = labels.where(condition).select(F.col("doc_id").cast("bigint").alias("_label"))
        kinds[kind] = each.join(ids, F.col("doc_id") == F.col("_label"), "left_semi")
    every = None
    for kind, rows in kinds.items():
        counts = rows.groupBy("part", "filter", "mask").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
        every = counts if every is None else every.unionAll(counts)
    by_kind = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds]
    return every.groupBy("part", "filter", "mask").agg(*by_kind)


_STEP = "array<struct<filter_order:string,step:int,filter:string,before:int,upto:int,others:int>>"


def _steps() -> list[dict]:
    """Every step of every order: its filter, and masks of those before, up to it, and of all others."""
    rows = []
    for order in permutations(NAMES):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << NAMES.index(name)
            masks = {"before": before, "upto": before | bit, "others": (1 << len(NAMES)) - 1 - bit}
            rows.append({"filter_order": "".join(order), "step": step, "filter": name, **masks})
            before |= bit
    return rows


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part is a value of ``part``, null as the empty string, in which an empty one counts too.
    Every row of ``docs`` counts as a document, those that repeat an id or have none too.
    Filter E takes texts equal to one with a smaller id; rows without an id neither fail it nor
    make others fail.  A label counts for all rows with its id, once, however often it is
    repeated; null labels count for none.  No documents give no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    failures = Failures(docs, doc_id, text, part)
    after = failures.after(failures.documents.select("key", "part"), NAMES)
    kept = after.groupBy("part", "mask").agg(F.count("*").alias("kept"))
    kept_by_mask = kept.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", "kept"))).alias("kept"))
    values = F.struct("removed", "good", "toxic")
    lost_by_mask = (
        removals(failures, labels)
        .groupBy("part")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "filter", "mask"), values))).alias("lost"))
    )
    # Both maps have at most 80 entries, whatever the number of documents.
    parts = kept_by_mask.join(lost_by_mask, "part", "left")
    # One literal: a column object for each of 3,600 cells takes the driver longer than the audit.
    orders = F.from_json(F.lit(json.dumps(_steps())), _STEP)
    wide = parts.select("part", "kept", "lost", F.explode(orders).alias("s")).select("part", "kept", "lost", "s.*")

    def lost(mask: Column, field: str) -> Column:
        found = F.try_element_at(F.col("lost"), F.concat_ws(" ", F.col("filter"), mask))
        return F.coalesce(found[field], F.lit(0)).cast("bigint")

    before = F.col("before").cast("string")
    plain = wide.select(
        "part", "filter_order", "step", "filter",
        F.coalesce(F.try_element_at("kept", F.col("upto")), F.lit(0)).cast("bigint").alias("kept"),
        lost(before, "removed").alias("removed"),
        (lost(F.lit("0"), "removed") - lost(before, "removed")).alias("redundant"),
        lost(F.col("others").cast("string"), "removed").alias("unique_fails"),
        lost(before, "good").alias("good_lost"), lost(before, "toxic").alias("toxic_lost"),
    )
    total = plain.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return plain.join(total, ["part", "filter"]).drop("filter")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL = """
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
f AS (
  SELECT doc_id, part, (len(w) < 200)::INT AS a, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT AS c,
    regexp_matches(text, '[#$%&*|]')::INT AS d, (doc_id > least)::INT AS e
  FROM t),
m AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS fails, count(*) AS n,
    count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
    count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic
  FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM l p JOIN l q ON q.x <> p.x JOIN l r ON r.x NOT IN (p.x, q.x) JOIN l s ON s.x NOT IN (p.x, q.x, r.x)
  JOIN l u ON u.x NOT IN (p.x, q.x, r.x, s.x)),
s AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, unnest(range(1, 6)) AS g(step)),
c AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & before <> 0 AND fails & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM c
"""
