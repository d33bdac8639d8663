"""Vector search, ranking and answers over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import text as X
from docloom.functions.arrays import explode_items
from docloom.functions.vectors import unit_norm_report
from docloom.operators import chunks as C
from docloom.operators import encode, retrieve, search
from docloom.operators.compact import first_per_group
from docloom.operators.row_ids import with_row_id
from docloom.operators.stats import fragments_within_limit
from docloom.plans import sql as Q
from docloom.plans.registry import corpus, query, table
from docloom.session import cut_lineage
from docloom.sources.index import alignment

DIM = 64


@query(
    "unit_norm",
    """SELECT bool_and(abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) < 1e-3) AS ok,
        count(*)::BIGINT AS n, count(DISTINCT len(embedding))::BIGINT AS dims FROM embeddings""",
)
def unit_norm(spark, folder):
    return unit_norm_report(table(spark, folder, "embeddings"), "embedding")


def _hashed_sql(src: str, out: str) -> str:
    """Sparse unit vectors (key, b, v) of ``src(key, txt)`` by signed word hashing."""
    return f"""
{out}_w AS (SELECT key, unnest({Q.words('lower(txt)')}[1:400]) AS w FROM {src}),
{out}_h AS (SELECT key, ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM} AS b,
    CASE WHEN substr(md5(w), 9, 1) < '8' THEN 1 ELSE -1 END AS sign FROM {out}_w),
{out}_s AS (SELECT key, b, sum(sign)::DOUBLE AS v FROM {out}_h GROUP BY key, b),
{out}_n AS (SELECT key, sqrt(sum(v * v)) AS n FROM {out}_s GROUP BY key),
{out} AS (SELECT key, b, (v / n)::FLOAT AS v FROM {out}_s JOIN {out}_n USING (key) WHERE n > 0 AND v <> 0
    UNION ALL SELECT key, 0, 1::FLOAT FROM {src} WHERE key NOT IN (SELECT key FROM {out}_n WHERE n > 0))"""


# The mean vector of every label is a query; five neighbouring vectors are a document.
TOPK_SQL = """x AS (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
m AS (SELECT label, i, round(avg(v::DOUBLE), 6) AS v FROM x GROUP BY label, i),
q AS (SELECT label::VARCHAR AS query_id, list(v ORDER BY i) AS qv FROM m GROUP BY label),
s AS (SELECT query_id, vec_id, round(list_inner_product(qv, embedding::DOUBLE[]), 10) AS score FROM q, embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 30),
pool AS (SELECT *, 'd' || (vec_id // 5) AS doc_id, 'c' || vec_id AS chunk_id FROM r)"""


def _centroids(spark, folder):
    """One query per label: few rows, made from all vectors by a partial aggregation."""
    items = explode_items(
        table(spark, folder, "embeddings"), ["label"], "embedding", "i", "v"
    )
    means = items.groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("v"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"])
    return means.groupBy(F.col("label").cast("string").alias("query_id")).agg(ordered.alias("vector"))


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.concat(F.lit("c"), "vec_id").alias("chunk_id"),
        F.col("embedding").alias("vector"),
    )


def _pool(spark, folder):
    found = search.top_k(_centroids(spark, folder), _vectors(spark, folder), 30)
    return found.select(
        "*",
        F.concat(F.lit("d"), F.floor(F.col("row_id") / 5)).alias("doc_id"),
        F.concat(F.lit("c"), "row_id").alias("chunk_id"),
    )


@query(
    "top_k",
    f"WITH {TOPK_SQL} SELECT query_id, rank::BIGINT AS rank, vec_id, round(score, 6) AS score FROM pool",
)
def top_k(spark, folder):
    return _pool(spark, folder).select(
        "query_id", "rank", F.col("row_id").alias("vec_id"), F.round("score", 6).alias("score")
    )


@query(
    "top_k_many_queries",
    f"""WITH qs AS (SELECT item_id AS key, text AS txt FROM benchmark), {_hashed_sql('qs', 'qv')},
    x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS b FROM embeddings),
    s AS (SELECT key AS query_id, vec_id, round(sum(qv.v::DOUBLE * x.v), 10) AS score FROM qv JOIN x USING (b) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 5)
    SELECT query_id, rank::BIGINT AS rank, vec_id, round(score, 6) AS score FROM r""",
)
def top_k_many_queries(spark, folder):
    # The bound on the query matrix is 0 on purpose: this is the path for query sets
    # too large to send to every task.
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    queries = encode.encode_texts(asked, encode.HashingEncoder(DIM), ["query_id"], "text")
    found = search.top_k(queries, _vectors(spark, folder), 5, max_query_bytes=0)
    return found.select(
        "query_id", "rank", F.col("row_id").alias("vec_id"), F.round("score", 6).alias("score")
    )


RANKED_SQL = f"""{TOPK_SQL},
best AS (SELECT query_id, doc_id, max(score) AS score, min(rank) AS first FROM pool GROUP BY ALL),
docs AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first) AS rank
    FROM best QUALIFY rank <= 3)"""


@query(
    "rank_documents",
    f"WITH {RANKED_SQL} SELECT query_id, rank::BIGINT AS rank, doc_id, round(score, 6) AS score FROM docs",
)
def rank_documents(spark, folder):
    ranked = retrieve.rank_documents(_pool(spark, folder))
    return ranked.withColumn("score", F.round("score", 6))


FRAGMENT_SQL = f"""{TOPK_SQL},
src AS (SELECT query_id, chunk_id, pool.doc_id, rank AS chunk_rank, text AS txt FROM pool JOIN documents d ON d.doc_id = vec_id
    WHERE rank <= 10),
{Q.fragments('src', 'query_id, chunk_id, doc_id, chunk_rank')},
frags AS (SELECT query_id, chunk_id, doc_id, text, row_number() OVER (PARTITION BY query_id ORDER BY chunk_rank, frag_pos) AS rank
    FROM fr QUALIFY rank <= 10)"""


def _pool_with_texts(spark, folder):
    """The pool with the text of the document that shares the vector's number."""
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("texto"), F.col("lang").alias("idioma")
    )
    return retrieve.with_metadata(_pool(spark, folder), texts, "row_id", None)


@query(
    "rank_fragments",
    f"WITH {FRAGMENT_SQL} SELECT query_id, rank::BIGINT AS rank, chunk_id, doc_id, text FROM frags",
)
def rank_fragments(spark, folder):
    return retrieve.rank_fragments(_pool_with_texts(spark, folder))


@query(
    "fragments_within_limit",
    f"""WITH {FRAGMENT_SQL} SELECT query_id, count(*)::BIGINT AS n,
        count(*) FILTER (WHERE {Q.n_words('text')} <= 250)::BIGINT AS within FROM frags GROUP BY query_id""",
)
def fragment_limit(spark, folder):
    return fragments_within_limit(retrieve.rank_fragments(_pool_with_texts(spark, folder)))


# -- encoding -----------------------------------------------------------------------


@query(
    "encode_texts",
    f"""WITH src AS (SELECT doc_id AS key, text AS txt FROM documents), {_hashed_sql('src', 'vec')}
    SELECT key AS doc_id, b::BIGINT AS dim, round(v::DOUBLE, 5) AS value FROM vec""",
)
def encode_texts(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("texto"), X.word_count("text").alias("num_tokens")
    )
    vectors = encode.encode_texts(rows, encode.HashingEncoder(DIM), ["doc_id"], tokens="num_tokens")
    items = explode_items(vectors, ["doc_id"], "vector", "dim", "value")
    value = F.round(F.col("value").cast("double"), 5)
    return items.filter(F.col("value") != 0).select("doc_id", "dim", value.alias("value"))


@query(
    "encode_missing",
    """SELECT doc_id::VARCHAR AS chunk_id, 'hashing-64' AS encoder_id, sha1(text) AS text_hash FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def encode_missing(spark, folder):
    # A cache of the labelled documents, stale where the quality is 0.
    documents = table(spark, folder, "documents")
    cached = documents.join(table(spark, folder, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("chunk_id"), F.lit(f"hashing-{DIM}").alias("encoder_id"),
        F.sha1(F.when(F.col("quality") == 1, F.col("text")).otherwise("old").cast("binary"))
        .alias("text_hash"),
        F.array_repeat(F.lit(0.125).cast("float"), DIM).alias("vector"),
    )
    chunks = documents.select(
        F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("texto"),
        X.word_count("text").alias("num_tokens"),
    )
    made = encode.encode_missing(chunks, cached, encode.HashingEncoder(DIM))
    return made.select(*encode.CACHE_KEY)


@query(
    "index_rows",
    f"""WITH {Q.CHUNKS} SELECT row_number() OVER (ORDER BY doc_id, posicion) - 1 AS row_id, chunk_id FROM chunks""",
)
def index_rows(spark, folder):
    chunks = C.chunk_documents(corpus(spark, folder)).select("chunk_id", "doc_id", "posicion")
    return with_row_id(chunks, ["doc_id", "posicion"]).select("row_id", "chunk_id")


@query(
    "index_alignment",
    """WITH k AS (SELECT vec_id AS k, 1 AS v, 0 AS m FROM embeddings UNION ALL SELECT doc_id, 0, 1 FROM labels),
    g AS (SELECT k, sum(v) AS v, sum(m) AS m FROM k GROUP BY k)
    SELECT sum(v)::BIGINT AS vectors, sum(m)::BIGINT AS records, count(*) FILTER (WHERE v <> 1 OR m <> 1)::BIGINT AS unmatched FROM g""",
)
def index_alignment(spark, folder):
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"))
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("chunk_id"))
    return alignment(vectors, labels)


# -- answers ----------------------------------------------------------------------

# The whole chain: the passages of ``benchmark`` are the queries, the chunks of
# ``documents`` the index.
ANSWER_SQL = f"""{Q.CHUNKS},
src AS (SELECT row_number() OVER (ORDER BY doc_id, posicion) - 1 AS key, texto AS txt, chunk_id, doc_id FROM chunks),
{_hashed_sql('src', 'cv')},
qs AS (SELECT item_id::VARCHAR AS key, text AS txt FROM benchmark),
{_hashed_sql('qs', 'qv')},
sc AS (SELECT qv.key AS query_id, cv.key AS row_id, round(sum(qv.v::DOUBLE * cv.v::DOUBLE), 10) AS score
    FROM qv JOIN cv USING (b) GROUP BY ALL),
pool AS (SELECT query_id, row_id, score, chunk_id, doc_id, txt, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank
    FROM sc JOIN src ON src.key = sc.row_id QUALIFY rank <= 30),
best AS (SELECT query_id, doc_id, max(score) AS score, min(rank) AS first FROM pool GROUP BY ALL),
docs AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first) AS rank
    FROM best QUALIFY rank <= 3),
near AS (SELECT query_id, chunk_id, doc_id, rank AS chunk_rank, txt FROM pool WHERE rank <= 10),
{Q.fragments('near', 'query_id, chunk_id, doc_id, chunk_rank')},
frags AS (SELECT query_id, chunk_id, doc_id, text, row_number() OVER (PARTITION BY query_id ORDER BY chunk_rank, frag_pos) AS rank
    FROM fr QUALIFY rank <= 10)"""


@query(
    "answers",
    f"""WITH {ANSWER_SQL}
    SELECT query_id, 'document' AS kind, rank::BIGINT AS rank, doc_id, NULL::VARCHAR AS chunk_id, NULL::VARCHAR AS text FROM docs
    UNION ALL SELECT query_id, 'fragment', rank, doc_id, chunk_id, text FROM frags""",
)
def answers(spark, folder):
    encoder = encode.HashingEncoder(DIM)
    # Chunks are cut and encoded in one pass, and their texts stay where they are made: keys and vectors are
    # kept, numbered and searched.
    documents = corpus(spark, folder)
    keys = ["chunk_id", "doc_id", "posicion"]
    chunks = C.chunk_documents(documents)
    vectors = cut_lineage(encode.encode_texts(chunks, encoder, keys, tokens="num_tokens", spread=False))
    numbers = with_row_id(vectors.select(*keys), ["doc_id", "posicion"])
    index = vectors.select("chunk_id", "vector").join(numbers.select("chunk_id", "row_id"), "chunk_id")

    def texts(ranked, n):
        """The ranked chunks: their documents, and no others, are cut once more."""
        wanted = retrieve.few(ranked.select("row_id").distinct(), n)
        near = cut_lineage(numbers.join(wanted, "row_id", "left_semi"))
        cut = C.chunk_documents(documents.join(retrieve.few(near.select("doc_id").distinct(), n), "doc_id", "left_semi"))
        return cut.join(retrieve.few(near.select("chunk_id", "row_id"), n), "chunk_id")

    asked = table(spark, folder, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), "text"
    )
    queries = cut_lineage(encode.encode_texts(asked, encoder, ["query_id"], "text"))
    nested = cut_lineage(retrieve.answer(queries, index, texts))
    documents = nested.select("query_id", F.inline("documents")).select(
        "query_id", F.lit("document").alias("kind"), "rank", "doc_id",
        F.lit(None).cast("string").alias("chunk_id"), F.lit(None).cast("string").alias("text"),
    )
    fragments = nested.select("query_id", F.inline("fragments")).select(
        "query_id", F.lit("fragment").alias("kind"), "rank", "doc_id", "chunk_id", "text"
    )
    return documents.unionByName(fragments)


FIRST_SQL = """f AS (SELECT source AS query_id, doc_id, text, n_chars, lang,
    row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents QUALIFY rank <= 3)"""


def _longest(spark, folder):
    rows = table(spark, folder, "documents").select(
        F.col("source").alias("query_id"), "doc_id", F.col("text").alias("texto"), "n_chars",
        F.when(F.col("lang") == "en", 1).when(F.col("lang") == "fr", 2).alias("fenomeno"),
    )
    return first_per_group(rows, ["query_id"], [F.desc("n_chars"), F.col("doc_id")], 3, "rank")


@query(
    "keyword_relevance",
    f"""WITH {FIRST_SQL}, k AS (SELECT DISTINCT source AS query_id, 'THE ' || right(source, 1) AS a, 'eau' || right(source, 1) AS b FROM documents)
    SELECT query_id, bool_or(contains(lower(text), lower(a)) OR contains(lower(text), b) OR contains(lower(text), 'êpa ')) AS relevant
    FROM f JOIN k USING (query_id) GROUP BY query_id""",
)
def keyword_relevance(spark, folder):
    last = F.right("query_id", F.lit(1))
    keywords = table(spark, folder, "documents").select(F.col("source").alias("query_id")).distinct()
    keywords = keywords.withColumn(
        "keywords", F.array(F.concat(F.lit("THE "), last), F.concat(F.lit("eau"), last), F.lit("ÊPA "))
    )
    return retrieve.keyword_relevance(_longest(spark, folder), keywords)


@query(
    "sanity_rows",
    f"""WITH {FIRST_SQL} SELECT query_id, rank::BIGINT AS rank, n_chars::DOUBLE AS score, doc_id,
        CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 END::INT AS fenomeno, lang = 'en' AS match,
        replace(substr(text, 1, 200), chr(10), ' ') AS preview FROM f""",
)
def sanity_rows(spark, folder):
    found = _longest(spark, folder).withColumn("score", F.col("n_chars").cast("double"))
    return retrieve.sanity_rows(found, F.lit(1))
