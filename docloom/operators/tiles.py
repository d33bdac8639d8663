"""Vector tile features to document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.operators.compact import first_wins_features
from docloom.operators.pages import ordered_text


def _property(props: Column, name: str) -> Column:
    return F.get(F.filter(props, lambda p: p["k"] == name), F.lit(0))["v"]


def feature_id(props: Column) -> Column:
    """``b_ID_concatenated`` when it is set and not empty, else ``fid``; NULL when blank."""
    found = F.coalesce(
        F.nullif(_property(props, "b_ID_concatenated"), F.lit("")), _property(props, "fid")
    )
    return F.nullif(X.strip(found), F.lit(""))


def feature_text(props: Column) -> Column:
    pairs = F.transform(props, lambda p: X.pair(p["k"], p["v"], V.TILE_NULL_WORDS))
    return F.array_join(F.filter(pairs, lambda p: p.isNotNull()), " | ")


#: Where a feature stands; tiles are ordered by path.
PLACE = ("path", "layer_pos", "feature_pos")


def feature_owners(features: DataFrame) -> DataFrame:
    """(layer, id, place) of the first of ``features`` with each key; those without an id have no owner.

    Such rows of many arrivals can be kept in one table: the owner of a key is the first place of
    all its rows (``current_owners``), whatever order they came in.
    """
    keyed = features.withColumn("id", feature_id(F.col("props"))).where(F.col("id").isNotNull())
    return current_owners(keyed.select("layer", "id", *PLACE))


def current_owners(owners: DataFrame) -> DataFrame:
    """One row a key: its first place.  Combined before the shuffle, so a key may be in any number of tiles."""
    first = owners.groupBy("layer", "id").agg(F.min(F.struct(*PLACE)).alias("_first"))
    return first.select("layer", "id", "_first.*")


def losing_tiles(features: DataFrame, owners: DataFrame) -> DataFrame:
    """(path) of the tiles that once owned a key of the new ``features`` and do not any more.

    ``owners`` holds the rows of the new features too.  A tile that lost a key in a run which died
    is named again as long as the new tiles are.
    """
    keys = feature_owners(features).select("layer", "id")
    # The stored side has few rows a key: one for each run that changed its owner.
    rows = owners.select("layer", "id", "path").distinct().join(keys, ["layer", "id"], "left_semi")
    now = current_owners(owners).select("layer", "id", F.col("path").alias("_owner"))
    lost = rows.join(now, ["layer", "id"]).where(F.col("path") != F.col("_owner")).select("path").distinct()
    return lost.join(features.select("path").distinct(), "path", "left_anti")


def _kept(features: DataFrame, owners: DataFrame | None) -> DataFrame:
    keyed = features.withColumn("id", feature_id(F.col("props")))
    if owners is None:
        return first_wins_features(keyed)
    # One pass: a feature is at an owner's place or has no id; places can be few enough to be sent to the features.
    places = current_owners(owners).select(*PLACE).distinct().withColumn("_owner", F.lit(True))
    joined = keyed.join(places, list(PLACE), "left")
    return joined.where(F.when(F.col("id").isNull(), True).otherwise(F.col("_owner").isNotNull())).drop("_owner")


def tile_documents(features: DataFrame, tiles: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """(path, texto, estado, filas_totales, detalle) of every tile.

    A feature is written by the first tile that has it, even when it has nothing
    to print; a tile left without text is a duplicate, or empty if it had no feature.
    First among ``features``, or by a table of ``owners``, with which some tiles can be written alone.
    """
    kept = _kept(features, owners)
    lines = (
        kept.withColumn("linea", feature_text(F.col("props")))
        .filter(F.col("linea") != "")
        # One sortable position from the two levels of a tile.
        .withColumn("pos", F.shiftleft(F.col("layer_pos"), 40) + F.col("feature_pos"))
    )
    texts = ordered_text(lines, "path", "pos", "linea", "\n")
    totals = features.groupBy("path").agg(F.count("*").alias("total"))
    fresh = kept.groupBy("path").agg(F.count("*").alias("nuevas"))
    joined = (
        tiles.select("path")
        .join(totals, "path", "left")
        .join(fresh, "path", "left")
        .join(texts, "path", "left")
        .select(
            "path",
            F.coalesce("total", F.lit(0)).alias("filas_totales"),
            F.coalesce("nuevas", F.lit(0)).alias("nuevas"),
            F.coalesce("texto", F.lit("")).alias("texto"),
        )
    )
    state = (
        F.when(~X.is_blank("texto"), F.lit("ok"))
        .when(F.col("filas_totales") > 0, F.lit("duplicado_pbf"))
        .otherwise(F.lit("vacio"))
    )
    return joined.select(
        "path", "texto", state.alias("estado"), "filas_totales",
        F.format_string("features=%d nuevas=%d", "filas_totales", "nuevas").alias("detalle"),
    )
