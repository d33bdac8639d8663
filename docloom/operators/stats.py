"""Statistics of document and chunk tables.

Each is a partial aggregation: map tasks send one row per group value, whatever
the size of the group.  There is no window over a document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.session import cut_lineage


def _rows() -> Column:
    return F.count("*").alias("n")


def _dimensions(documents: DataFrame) -> DataFrame:
    """The corpus reduced to one row per combination of its low-cardinality fields."""
    return documents.groupBy("estado", "formato", "fenomeno", "idioma").agg(
        _rows(),
        F.sum("n_palabras").alias("palabras"),
        F.sum("n_caracteres").alias("caracteres"),
        F.count_if(F.coalesce("truncado", F.lit(False))).alias("truncados"),
    )


def corpus_summary(documents: DataFrame) -> DataFrame:
    """(metric, key, value): totals over all states and the histograms.

    NULL keys are left out of histograms.  The corpus is aggregated once, to a table
    whose size does not depend on it, and every metric is read from that.  It is
    materialised because each metric prunes other columns, and Spark would otherwise
    scan the corpus for each.
    """
    base = cut_lineage(_dimensions(documents))
    ok = F.col("estado") == "ok"
    totals = base.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documentos_totales"),
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("documentos_ok"),
        F.coalesce(F.sum(F.when(~F.coalesce(ok, F.lit(False)), F.col("n"))), F.lit(0)).alias(
            "documentos_no_ok"
        ),
        F.coalesce(F.sum("palabras"), F.lit(0)).alias("palabras_totales"),
        F.coalesce(F.sum("caracteres"), F.lit(0)).alias("caracteres_totales"),
        F.coalesce(F.sum("truncados"), F.lit(0)).alias("truncados"),
    )
    names = totals.columns
    totals = totals.unpivot([], names, "metric", "value").select(
        "metric", F.lit(None).cast("string").alias("key"), F.col("value").cast("bigint")
    )
    parts = [totals] + [
        _histogram(base if every else base.filter(ok), column).select(
            F.lit(metric).alias("metric"), F.col(column).cast("string").alias("key"),
            F.col("n").alias("value"),
        )
        for metric, column, every in (
            ("por_estado", "estado", True),
            ("por_formato", "formato", True),
            ("ok_por_formato", "formato", False),
            ("por_fenomeno", "fenomeno", True),
        )
    ]
    top = _top_languages(base)
    parts.append(
        top.select(
            F.lit("por_idioma").alias("metric"), F.col("idioma").alias("key"),
            F.col("n").alias("value"),
        )
    )
    return reduce(DataFrame.union, parts)


def _histogram(base: DataFrame, column: str) -> DataFrame:
    return (
        base.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.sum("n").cast("bigint").alias("n"))
    )


def top_languages(documents: DataFrame, n: int = 12) -> DataFrame:
    """The most frequent languages of well extracted documents, ties by name."""
    return _top_languages(_dimensions(documents), n)


def _top_languages(base: DataFrame, n: int = 12) -> DataFrame:
    ok = base.filter(F.col("estado") == "ok")
    return _histogram(ok, "idioma").orderBy(F.desc("n"), "idioma").limit(n)


def summary_record(documents: DataFrame) -> DataFrame:
    """The summary as one JSON text."""
    rows = corpus_summary(documents)
    entry = F.struct(F.coalesce("key", F.lit("")).alias("k"), F.col("value").alias("v"))
    # The summary has a few dozen rows, bounded by the number of states and formats.
    metrics = rows.groupBy("metric").agg(
        F.max(F.when(F.col("key").isNull(), F.col("value"))).alias("total"),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("key").isNotNull(), entry)))).alias(
            "histogram"
        ),
    )
    item = F.struct(
        F.col("metric").alias("k"),
        F.coalesce(
            F.col("total").cast("string"),
            F.to_json("histogram"),
        ).alias("v"),
    )
    body = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(item)),
            lambda x: F.concat(F.lit('"'), x["k"], F.lit('":'), x["v"]),
        ),
        ",",
    )
    return metrics.agg(F.concat(F.lit("{"), body, F.lit("}")).alias("resumen"))


def chunk_statistics(chunks: DataFrame) -> DataFrame:
    """One row: documents, chunks, chunks per document, mean sizes."""
    return chunks.agg(
        F.count_distinct("doc_id").cast("bigint").alias("documents"),
        _rows().alias("chunks"),
        F.avg("n_caracteres_chunk").alias("mean_chars"),
        F.avg("n_palabras_chunk").alias("mean_words"),
        F.avg("num_tokens").alias("mean_tokens"),
    ).withColumn(
        "chunks_per_document",
        F.when(F.col("documents") > 0, F.col("chunks") / F.col("documents")),
    )


def length_percentiles(rows: DataFrame, column: str = "num_tokens") -> DataFrame:
    """Exact median, 90th percentile and maximum, from a table of value counts."""
    counted = rows.groupBy(column).agg(_rows())
    return counted.agg(
        F.percentile(column, 0.5, F.col("n")).alias("p50"),
        F.percentile(column, 0.9, F.col("n")).alias("p90"),
        F.max(column).cast("bigint").alias("max"),
    )


def boundary_share(chunks: DataFrame) -> DataFrame:
    """Per language: chunks, and those that end a sentence or their document.

    The last chunk of a document may end anywhere.  Its flag comes from an
    aggregate per document, so no chunk text is shuffled.
    """
    ends = X.ends_sentence("texto")
    per_document = chunks.groupBy("doc_id", "idioma").agg(
        _rows(),
        F.count_if(ends).alias("ok"),
        F.max_by(ends, "posicion").alias("last_ok"),
        F.max("posicion").alias("last"),
    )
    return (
        per_document.groupBy("idioma")
        .agg(
            F.sum("n").cast("bigint").alias("n"),
            F.sum(F.col("ok") + (~F.col("last_ok")).cast("int")).cast("bigint").alias("ok"),
        )
        .withColumn("pct", F.lit(100.0) * F.col("ok") / F.col("n"))
    )


def fragments_within_limit(fragments: DataFrame, limit: int = V.FRAGMENT_WORDS) -> DataFrame:
    """Per query: fragments, and those no longer than ``limit`` words."""
    return fragments.groupBy("query_id").agg(
        _rows(),
        F.count_if(X.word_count("text") <= limit).cast("bigint").alias("within"),
    )


def metadata_table(documents: DataFrame) -> DataFrame:
    """Documents without their text, by document."""
    return documents.drop("texto").orderBy("doc_id")


def error_rows(documents: DataFrame) -> DataFrame:
    """Metadata of everything that did not extract well; NULL counts as an error."""
    return metadata_table(documents.filter(~F.col("estado").eqNullSafe("ok")))
