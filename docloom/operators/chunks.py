"""Documents to chunks and chunks to fragments.

Every step works inside one row, so nothing here shuffles; a chunk table has as
many partitions as the documents it came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom import schemas
from docloom.functions import pack
from docloom.functions import text as X
from docloom.functions.arrays import explode_items
from docloom.functions.segment import Guarded, Segmenter, by_language


def valid_documents(documents: DataFrame) -> DataFrame:
    """Documents that can be chunked: extracted well and with text."""
    return documents.filter((F.col("estado") == "ok") & F.col("texto").isNotNull())


def sentences(
    documents: DataFrame, text: str = "texto", language: str = "idioma",
    segmenter: Segmenter = by_language,
) -> DataFrame:
    """One row per sentence: the other columns, ``pos`` and ``oracion``."""
    rest = [c for c in documents.columns if c != text]
    cleaned = documents.withColumn(text, X.clean_text(text))
    return explode_items(
        cleaned, rest, segmenter(F.col(text), F.col(language)), "pos", "oracion"
    )


def _language(documents: DataFrame) -> Column:
    # A missing column means English; a NULL value is a language of its own.
    return F.col("idioma") if "idioma" in documents.columns else F.lit("en")


def chunk_documents(
    documents: DataFrame,
    segmenter: Segmenter = by_language,
    limit: int = V.CHUNK_CHARS,
    count_tokens=None,
    errors: bool = False,
) -> DataFrame:
    """Chunk table of a document table, with the fields chunks inherit.

    ``count_tokens`` is a Column function of the text; without one, tokens are words.
    Documents whose phenomenon is NULL keep their chunks.  ``last`` marks the last
    chunk of its document, known here for free.  With ``errors`` a document on which a
    ``Guarded`` segmenter failed gives one row without text, its ``error`` filled, in the same pass;
    without, it gives no row.
    """
    inherited = [
        (F.col(f.name) if f.name in documents.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.CHUNKS
        if f.name in V.INHERITED and f.name != "idioma"
    ]
    packed = (
        documents.select(
            "doc_id", *inherited, _language(documents).alias("idioma"),
            X.clean_text("texto").alias("texto"),
        )
    )
    pieces = pack.pack_chunks("_sentences", limit)
    guarded = errors and isinstance(segmenter, Guarded)
    if guarded:
        found = packed.withColumn("_found", segmenter.checked("texto", "idioma"))
        packed = found.withColumns({"_sentences": F.col("_found.oraciones"), "error": F.col("_found.error")}).drop("_found")
        pieces = F.when(F.col("error").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(pieces)
    else:
        packed = packed.withColumn("_sentences", segmenter(F.col("texto"), F.col("idioma")))
        if errors:
            packed = packed.withColumn("error", F.lit(None).cast("string"))
    packed = packed.drop("texto").withColumn("_chunks", pieces).drop("_sentences")
    also = ["error"] if errors else []
    keep = ["doc_id", *V.INHERITED, *also, F.size("_chunks").alias("_n")]
    exploded = explode_items(packed, keep, "_chunks", "posicion", "texto").withColumn(
        "_words", X.stripped_word_count("texto").cast("bigint")
    )
    return exploded.select(
        X.chunk_id("doc_id", "posicion").alias("chunk_id"),
        "doc_id",
        "posicion",
        "texto",
        (count_tokens("texto") if count_tokens else F.col("_words")).alias("num_tokens"),
        *V.INHERITED,
        X.char_count("texto").alias("n_caracteres_chunk"),
        F.col("_words").alias("n_palabras_chunk"),
        (F.col("posicion") == F.col("_n") - 1).alias("last"),
        *also,
    )


def chunking_errors(documents: DataFrame, segmenter: Segmenter) -> DataFrame:
    """(doc_id, error) of the documents on which the segmenter fails."""
    if not isinstance(segmenter, Guarded):
        return documents.select("doc_id", F.lit(None).cast("string").alias("error")).limit(0)
    cut = segmenter.checked(X.clean_text("texto"), _language(documents))
    return documents.select("doc_id", cut["error"].alias("error")).filter(F.col("error").isNotNull())


def fragment_chunks(
    chunks: DataFrame, segmenter: Segmenter = by_language, limit: int = V.FRAGMENT_WORDS
) -> DataFrame:
    """Fragments of each chunk's text: the other columns, ``frag_pos`` and ``text``."""
    rest = [c for c in chunks.columns if c not in ("texto", "idioma")]
    cut = chunks.withColumn("_sentences", segmenter(F.col("texto"), _language(chunks)))
    return explode_items(
        cut, rest, pack.pack_fragments("texto", "_sentences", limit), "frag_pos", "text"
    )


def token_bucket(tokens: Column | str) -> Column:
    """Encoding bucket: texts of similar length are encoded together."""
    return F.when(X.col(tokens) <= V.SHORT_TOKENS, F.lit("short")).otherwise(F.lit("long"))


def metadata_records(chunks: DataFrame, *also: str) -> DataFrame:
    """Metadata of the index: required fields, the extra ones present, ``also``, no others.

    A missing required column fails when the plan is analysed.
    """
    extra = [c for c in V.METADATA_EXTRA if c in chunks.columns]
    numbers = ("fenomeno", "posicion", "num_tokens")
    return chunks.select(
        *[F.col(c).cast("bigint").alias(c) if c in numbers else F.col(c)
          for c in V.METADATA_REQUIRED],
        *extra,
        *also,
    )


def blank_sources(chunks: DataFrame) -> DataFrame:
    """(n, example): how many chunks lack ``fuente``, the key answers are matched on."""
    blank = F.coalesce(X.is_blank(F.col("fuente").cast("string")), F.lit(True))
    return chunks.agg(
        F.count_if(blank).alias("n"), F.min(F.when(blank, F.col("chunk_id"))).alias("example")
    )


def assert_sources(chunks: DataFrame) -> None:
    """Fail on chunks without ``fuente`` before any work is done on them."""
    found = blank_sources(chunks).first()
    if found.n:
        raise ValueError(f"{found.n} chunks with an empty fuente, {found.example} among them")
