"""First-wins, latest-wins and set differences on keyed rows.

"First k rows per key" is written as a filtered row number: Spark turns it into a
window group limit that keeps at most k rows per key in every map task before the
shuffle, so a key that holds a third of the table sends k rows per task and not a
third of the table.  Beyond the size for which Spark does that, keys are salted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom import fixed_values as V

# Spark's own bound for the window group limit (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000
_SALTS = 64


def first_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``k`` rows of every key group in ``order``, which must be total."""
    name = rank or "_rank"

    def top(rows: DataFrame, by: list[str]) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn(name, number).filter(F.col(name) <= k)

    if k > _GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        df = top(salted, [*keys, "_salt"]).drop(name, "_salt")
    out = top(df, keys)
    return out.withColumn(name, F.col(name).cast("bigint")) if rank else out.drop(name)


def latest_wins(log: DataFrame, key: str = "doc_id", seq: list[str] | str = "seq") -> DataFrame:
    """Last written row of every key; ``seq`` orders the log."""
    seq = [seq] if isinstance(seq, str) else seq
    return first_per_group(log, [key], [F.col(c).desc() for c in seq])


def first_wins_features(features: DataFrame) -> DataFrame:
    """One version of every tile feature, from the first tile that has it.

    Key is layer and id, tiles are ordered by path.  A feature without an id is
    never a duplicate: it gets a key of its own, its position.
    """
    here = F.struct("path", "layer_pos", "feature_pos")
    own = F.when(F.col("id").isNull(), here)
    kept = first_per_group(
        features.withColumn("_own", own),
        ["layer", "id", "_own"],
        [F.col(c) for c in ("path", "layer_pos", "feature_pos")],
    )
    return kept.drop("_own")


def pending(wanted: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``wanted`` whose key is not done."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def among(wanted: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``wanted`` whose key is listed."""
    return wanted.join(keys.select(key).distinct(), key, "left_semi")


def done_keys(*tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """Set union of the keys of several tables."""
    return reduce(DataFrame.union, [t.select(key) for t in tables]).distinct()


def append_passes(*passes: DataFrame) -> DataFrame:
    """Rows of successive passes with a ``pass`` number, to order a later compaction."""
    numbered = [p.withColumn("pass", F.lit(i).cast("bigint")) for i, p in enumerate(passes)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def out_of_memory(log: DataFrame, seq: list[str] | str = "seq") -> DataFrame:
    """Keys whose latest row failed for lack of memory and deserve another try."""
    said = reduce(
        Column.__or__, [F.contains(F.col("detalle"), F.lit(s)) for s in V.OUT_OF_MEMORY]
    )
    return latest_wins(log, "doc_id", seq).filter((F.col("estado") == "error") & said).select("doc_id")


def attempt_ladder(log: DataFrame, seq: str = "seq") -> DataFrame:
    """(doc_id, intentos, peldano): how often a key was tried and on which rung of the ladder it stands.

    ``primera``: well at the first row; ``reintento``: well after an error; ``memoria``: last failed for
    lack of memory and is tried again; ``aislado``: failed alone in its batch; ``error``: any other
    error; else the state itself.  Rows that count several tries say so in ``intentos``.
    """
    tries = F.coalesce(F.col("intentos"), F.lit(1)) if "intentos" in log.columns else F.lit(1)
    last = F.max(F.struct(seq, "estado", F.coalesce("detalle", F.lit("")).alias("detalle")))
    # One value of a key, combined before the shuffle.
    keys = log.groupBy("doc_id").agg(
        F.sum(tries).cast("bigint").alias("intentos"), F.bool_or(F.col("estado") == "error").alias("_failed"), last.alias("_last")
    )
    state, detail = F.col("_last.estado"), F.col("_last.detalle")
    memory = reduce(Column.__or__, [F.contains(detail, F.lit(s)) for s in V.OUT_OF_MEMORY])
    rung = (
        F.when(state != "error", F.when(state != "ok", state).when(F.col("_failed"), "reintento").otherwise("primera"))
        .when(memory, "memoria")
        .when(F.startswith(detail, F.lit(V.LOST_DETAIL)), "aislado")
        .otherwise("error")
    )
    return keys.select("doc_id", "intentos", rung.alias("peldano"))


def stratified_head(rows: DataFrame, stratum: str, order: str, limit: int) -> DataFrame:
    """Sample of about ``limit`` rows: the first ones of every stratum, then of all.

    Every stratum gives ``max(1, limit // strata)`` rows.
    """
    strata = rows.agg(F.count_distinct(F.col(stratum)).alias("n")).scalar()
    quota = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(strata, F.lit(1))))
    in_stratum = rows.filter(F.col(stratum).isNotNull())
    head = first_per_group(in_stratum, [stratum], [F.col(order)], max(limit, 1), "_rank")
    return head.filter(F.col("_rank") <= quota).drop("_rank").orderBy(order).limit(limit)
