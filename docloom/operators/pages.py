"""Repeated headers and footers of paged documents.

The margin lines of a page are found inside its row.  Only line signatures are
shuffled, counted map-side first, so a document that holds a third of all pages
costs no more than its distinct signatures.  The signatures kept for a document
are few by definition (each needs a share of the pages, each page offers six), so
they travel to the pages as one short array per document.

Where a document's pages are an array in its row already, as decoders return them,
everything is done inside the row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.functions.arrays import explode_items, let

_SALTS = 16


def margin_lines(page_text: Column | str, margin: int = V.MARGIN_LINES) -> Column:
    """Distinct first and last non-blank lines of a page."""
    lines = F.filter(F.split(X.col(page_text), "\n"), lambda x: ~X.is_blank(x))
    first = F.slice(lines, 1, margin)
    # slice() refuses a start before the array, so short pages take all their lines.
    start = F.greatest(F.size(lines) - margin + 1, F.lit(1))
    return F.array_distinct(F.concat(first, F.slice(lines, start, F.lit(margin))))


def boilerplate(
    pages: DataFrame, ratio: float = V.REPEAT_RATIO, margin: int = V.MARGIN_LINES
) -> DataFrame:
    """(doc_id, firma, n) of margin lines on at least ``ratio`` of the pages.

    The least count is three and documents under four pages have none.  Two raw
    variants of a line on one page count twice; blank pages count as pages.
    """
    signatures = (
        explode_items(pages, ["doc_id"], margin_lines("texto", margin), "pos", "linea")
        .select("doc_id", X.line_signature("linea").alias("firma"))
        .filter(F.length("firma").between(1, V.MAX_SIGNATURE))
        .groupBy("doc_id", "firma")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= V.MIN_REPEATS)
    )
    sizes = pages.groupBy("doc_id").agg(F.count("*").alias("pages"))
    least = F.greatest(F.lit(V.MIN_REPEATS), F.floor(F.col("pages") * F.lit(ratio)))
    return (
        signatures.join(sizes.filter(F.col("pages") >= V.MIN_PAGES), "doc_id")
        .filter(F.col("n") >= least)
        .select("doc_id", "firma", "n")
    )


def strip_page_lines(
    pages: DataFrame, ratio: float = V.REPEAT_RATIO, margin: int = V.MARGIN_LINES
) -> DataFrame:
    """Pages without page numbers and boilerplate, their paragraphs rebuilt.

    Pages are joined on document and a salt, so the pages of one document spread
    over several tasks when the signature table is too large to broadcast.
    """
    per_document = (
        boilerplate(pages, ratio, margin)
        .groupBy("doc_id")
        .agg(F.collect_set("firma").alias("_firmas"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    )
    salted = pages.withColumn("_salt", F.pmod(F.hash("page"), F.lit(_SALTS)))
    joined = salted.join(per_document, ["doc_id", "_salt"], "left")

    text = _without_furniture(F.col("texto"), F.coalesce("_firmas", F.array().cast("array<string>")))
    return joined.withColumn("texto", text).drop("_salt", "_firmas")


def _without_furniture(page: Column, signatures: Column) -> Column:
    def keep(line: Column) -> Column:
        furniture = X.is_page_number(line) | F.array_contains(signatures, X.line_signature(line))
        return X.is_blank(line) | ~furniture

    # Blank lines part paragraphs whatever blanks they hold.
    return X.rebuild_paragraphs(F.array_join(F.filter(F.split(page, "\n"), keep), "\n"))


def _runs(ordered: Column) -> Column:
    """(firma, n) of a sorted array: the lengths of the runs of equal values."""
    placed = F.transform(ordered, lambda x, i: F.struct(x.alias("firma"), i.alias("i")))
    starts = F.filter(placed, lambda e: (e["i"] == 0) | (e["firma"] != F.get(ordered, e["i"] - 1)))

    def lengths(firsts: Column) -> Column:
        def run(e: Column, at: Column) -> Column:
            end = F.coalesce(F.get(firsts, at + 1)["i"], F.size(ordered))
            return F.struct(e["firma"].alias("firma"), (end - e["i"]).cast("bigint").alias("n"))

        return F.transform(firsts, run)

    return let(starts, lengths)


def furniture(pages: Column, ratio: float = V.REPEAT_RATIO, margin: int = V.MARGIN_LINES) -> Column:
    """Array of (firma, n), as ``boilerplate`` counts them, for one document's array of pages."""
    signatures = F.flatten(F.transform(pages, lambda p: F.transform(margin_lines(p, margin), X.line_signature)))
    fit = F.filter(signatures, lambda s: F.length(s).between(1, V.MAX_SIGNATURE))
    least = F.greatest(F.lit(V.MIN_REPEATS), F.floor(F.size(pages) * F.lit(ratio)))
    repeated = F.filter(let(F.array_sort(fit), _runs), lambda r: r["n"] >= least)
    return F.when(F.size(pages) >= V.MIN_PAGES, repeated).otherwise(
        F.array().cast("array<struct<firma:string,n:bigint>>")
    )


def strip_page_array(
    pages: Column | str, ratio: float = V.REPEAT_RATIO, margin: int = V.MARGIN_LINES
) -> Column:
    """One document's array of pages, each as ``strip_page_lines`` leaves it; a NULL page is empty."""

    def strip(filled: Column) -> Column:
        signatures = F.transform(furniture(filled, ratio, margin), lambda r: r["firma"])
        return let(signatures, lambda s: F.transform(filled, lambda p: _without_furniture(p, s)))

    return let(F.transform(X.col(pages), lambda p: F.coalesce(p, F.lit(""))), strip)


def joined_pages(pages: Column | str, sep: str = "\n\n") -> Column:
    """The pages that are not blank as one text, NULL where there is none."""
    shown = F.filter(X.col(pages), lambda p: ~X.is_blank(p))
    return F.when(F.size(shown) > 0, F.array_join(shown, sep))


def ordered_text(rows: DataFrame, key: str, pos: str, text: str, sep: str, run: int = 256) -> DataFrame:
    """(key, texto): the texts of a key joined in order of ``pos``.

    Runs of neighbours are joined first, so no task gathers more than a run of
    rows or the runs of one key, whose joined text is the result itself.
    """
    part = F.floor(F.col(pos) / F.lit(run)).alias("_run")
    runs = rows.groupBy(key, part).agg(
        _joined(F.struct(F.col(pos).alias("p"), F.col(text).alias("t")), sep).alias("_text")
    )
    return runs.groupBy(key).agg(
        _joined(F.struct(F.col("_run").alias("p"), F.col("_text").alias("t")), sep).alias("texto")
    )


def _joined(item: Column, sep: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["t"]), sep)
