"""Plain text files: web dumps with a scraper header, menus and a preamble."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as X


def text_documents(files: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds url, texto and estado read from each file's text, which is dropped."""
    lined = files.withColumn("url", X.scraper_url(raw)).withColumn(
        "_lines", F.split(X.drop_scraper_header(raw), "\n")
    )
    kept = lined.withColumn("_lines", X.drop_repeated_menu_lines("_lines"))
    body = F.slice(
        F.col("_lines"), X.preamble_size("_lines") + 1, F.greatest(F.size("_lines"), F.lit(1))
    )
    return (
        kept.withColumn("texto", F.array_join(body, "\n"))
        .withColumn("estado", F.when(X.is_blank("texto"), "vacio").otherwise("ok"))
        .drop("_lines", raw)
    )
