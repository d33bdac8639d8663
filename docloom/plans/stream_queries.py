"""Incremental runs over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docloom.functions.language import sample, trigram_detector, trigram_profiles
from docloom import fixed_values as V
from docloom.operators.chunks import chunk_documents
from docloom.plans import sql as Q
from docloom.plans.registry import corpus, query, table
from docloom.session import checkpoint_dir
from docloom.streaming.incremental import append_available, document_stream


@query(
    "stream_chunks",
    f"WITH {Q.CHUNKS} SELECT chunk_id, doc_id, posicion, texto, num_tokens::BIGINT AS num_tokens FROM chunks",
)
def stream_chunks(spark, folder):
    """All document files through the stream, twice: the second run finds nothing new."""
    schema = table(spark, folder, "documents").schema
    # The table is one file or a folder of files, whatever their names: all of them are read.  A stream
    # takes a path to be a folder unless it is a pattern; this one stands for the table alone.
    rows = document_stream(spark, f"{folder}/documents.parque[t]", schema, pattern="*").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("texto"),
        F.col("lang").alias("idioma"),
    )
    run = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    chunks = chunk_documents(rows)
    for _ in range(2):
        append_available(chunks, f"{run}/chunks", f"{run}/state").awaitTermination()
    # Without a document no file tells the schema.
    done = spark.read.schema(chunks.schema).parquet(f"{run}/chunks")
    return done.select("chunk_id", "doc_id", "posicion", "texto", "num_tokens")


@query(
    "language_sample",
    f"""WITH s AS (SELECT doc_id, {Q.strip('substr(text, 1, 5000)')} AS head FROM documents)
    SELECT doc_id, CASE WHEN length(head) >= 30 THEN head END AS muestra FROM s""",
)
def language_sample(spark, folder):
    return table(spark, folder, "documents").select("doc_id", sample("text").alias("muestra"))


@query(
    "language_id",
    f"""WITH g AS (SELECT lang AS idioma, unnest(list_transform(range(1, greatest(length(text) - 1, 2)), lambda i: substr(lower(text), i, 3))) AS gram
        FROM documents),
    c AS (SELECT idioma, gram, count(*) AS n FROM g GROUP BY ALL),
    t AS (SELECT idioma, sum(n) + 2000 AS total FROM c GROUP BY idioma),
    p AS (SELECT idioma, gram, ln((n + 1) / total) AS lp FROM c JOIN t USING (idioma)),
    h AS (SELECT doc_id, lower({Q.strip('substr(text, 1, 5000)')}) AS head FROM documents WHERE length({Q.strip('substr(text, 1, 5000)')}) >= 30),
    d AS (SELECT doc_id, gram, count(*) AS m FROM (SELECT doc_id, unnest(list_transform(range(1, length(head) - 1), lambda i: substr(head, i, 3))) AS gram FROM h) GROUP BY ALL),
    s AS (SELECT doc_id, t.idioma, sum(m * coalesce(lp, -ln(total))) AS score FROM d CROSS JOIN t LEFT JOIN p ON p.idioma = t.idioma AND p.gram = d.gram GROUP BY ALL),
    b AS (SELECT doc_id, max(score) AS top FROM s GROUP BY doc_id),
    r AS (SELECT doc_id, arg_max(idioma, score) AS best, 1 / sum(exp(score - top)) AS prob FROM s JOIN b USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CASE WHEN prob >= 0.6 THEN best ELSE '{V.UNKNOWN}' END AS idioma FROM documents LEFT JOIN r USING (doc_id)""",
)
def language_id(spark, folder):
    # Learned from every document that has a language; every document is given one.
    detect = trigram_detector(trigram_profiles(corpus(spark, folder)))
    return table(spark, folder, "documents").select(
        "doc_id", detect(F.col("text")).alias("idioma")
    )
