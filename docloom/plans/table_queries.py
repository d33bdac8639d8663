"""Inventory, compaction, statistics, rows and JSON over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.operators import chunks as C
from docloom.operators import compact, stats, tiles
from docloom.operators.json_documents import json_documents
from docloom.plans import log_table
from docloom.plans import sql as Q
from docloom.plans.registry import corpus, query, table
from docloom.session import checkpoint_dir, cut_lineage
from docloom.sources.csv_files import csv_documents, csv_rows
from docloom.sources.inventory import inventory, is_tile, reader
from docloom.sources.jsonl import parse_lines

# -- inventory ------------------------------------------------------------------

# An inventory made from ``pages``: the type and extension follow the page's address.
INVENTORY_SQL = """inv AS (SELECT page_id AS pos, 'D' || page_id AS "DOC_ID",
    split_part(url, '/', 3) || '//' AS "Carpeta",
    'p' || page_id || CASE WHEN html LIKE '%lang="fr"%' THEN '.PDF' WHEN html LIKE '%lang="de"%' THEN '.tar.json'
        WHEN html LIKE '%lang="es"%' THEN '.pbf' WHEN url LIKE 'https%' THEN '.webp' ELSE '.dat' END AS name,
    CASE WHEN url LIKE '%www%' THEN 'Texto' WHEN html LIKE '%lang="es"%' THEN 'Otro' ELSE 'Imagen' END AS "Tipo",
    CASE WHEN html LIKE '%lang="fr"%' THEN ' F1 ' WHEN html LIKE '%lang="en"%' THEN 'F3' ELSE 'F9' END AS fen
    FROM pages)"""


def _inventory_rows(spark, folder):
    lang = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    suffix = (
        F.when(lang == "fr", ".PDF").when(lang == "de", ".tar.json").when(lang == "es", ".pbf")
        .when(F.col("url").startswith("https"), ".webp").otherwise(".dat")
    )
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("pos"),
        F.concat(F.lit("D"), "page_id").alias("DOC_ID"),
        F.concat(F.split_part("url", F.lit("/"), F.lit(3)), F.lit("//")).alias("Carpeta"),
        F.concat(F.lit("p"), "page_id", suffix).alias("Nombre estandarizado"),
        F.when(F.contains("url", F.lit("www")), "Texto").when(lang == "es", "Otro")
        .otherwise("Imagen").alias("Tipo"),
        F.when(lang == "fr", " F1 ").when(lang == "en", "F3").otherwise("F9").alias("Fenómeno"),
        F.lit("obs").alias("Observatorio"),
        F.lit(7).alias("Código Observatorio"),
    )


@query(
    "inventory_routes",
    f"""WITH {INVENTORY_SQL}, e AS (SELECT *, lower(regexp_extract(name, '.+\\.([^.]+)$', 1)) AS ext FROM inv)
    SELECT "DOC_ID" AS doc_id, rtrim("Carpeta", '/') || '/' || name AS ruta_relativa,
      CASE trim(fen) WHEN 'F1' THEN 1 WHEN 'F2' THEN 2 WHEN 'F3' THEN 3 END::BIGINT AS fenomeno, ext AS formato,
      CASE WHEN ext = 'pdf' THEN 'pdf' WHEN ext = 'json' THEN 'json' WHEN "Tipo" = 'Texto' OR ext = 'txt' THEN 'txt'
        WHEN ext = 'webp' THEN 'image' WHEN ext = 'pbf' THEN 'pbf' ELSE 'unsupported' END AS reader,
      ext = 'pbf' AS tile FROM e""",
)
def inventory_routes(spark, folder):
    rows = inventory(_inventory_rows(spark, folder))
    path = "ruta_relativa"
    return rows.select(
        "doc_id", path, "fenomeno", X.extension(path).alias("formato"),
        reader("tipo_adl", path).alias("reader"), is_tile(path).alias("tile"),
    )


@query(
    "stratified_head",
    f"""WITH {INVENTORY_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY "Tipo" ORDER BY pos) AS rn,
        greatest(1, 50 // (SELECT count(DISTINCT "Tipo") FROM inv)) AS quota FROM inv)
    SELECT pos, "DOC_ID" AS doc_id, "Tipo" AS tipo_adl FROM f WHERE rn <= quota ORDER BY pos LIMIT 50""",
)
def stratified_sample(spark, folder):
    return inventory(_inventory_rows(spark, folder), limit=50).select("pos", "doc_id", "tipo_adl")


@query(
    "inventory_types",
    f"""WITH {INVENTORY_SQL} SELECT "DOC_ID" AS doc_id, "Tipo" AS tipo_adl FROM inv WHERE "Tipo" IN ('Texto', 'Otro')""",
)
def inventory_types(spark, folder):
    rows = inventory(_inventory_rows(spark, folder), types=["Texto", "Otro"])
    return rows.select("doc_id", "tipo_adl")


# -- document fields ------------------------------------------------------------


@query(
    "document_titles",
    r"""WITH t AS (SELECT p_partkey, '  ' || CASE WHEN p_size % 3 = 0 THEN p_name || '.Docx' WHEN p_size % 3 = 1
        THEN substr(p_brand, 1, 3) ELSE p_name || ': ' || p_type END AS t FROM part), s AS (SELECT p_partkey, trim(t) AS t FROM t)
    SELECT p_partkey, CASE WHEN length(t) > 3 AND length(t) < 300 AND
        NOT regexp_full_match(t, '(?i)[\w\-. ]+\.(indd|pdf|docx?|qxd)') THEN t END AS titulo FROM s""",
)
def document_titles(spark, folder):
    size = F.col("p_size") % 3
    raw = F.when(size == 0, F.concat("p_name", F.lit(".Docx"))).when(
        size == 1, F.substring("p_brand", 1, 3)
    ).otherwise(F.concat("p_name", F.lit(": "), "p_type"))
    return table(spark, folder, "part").select(
        "p_partkey", X.document_title(F.concat(F.lit("  "), raw)).alias("titulo")
    )


@query(
    "document_status",
    f"""SELECT doc_id, CASE WHEN {Q.strip('text')} = '' OR n_chars < 60 THEN 'vacio' ELSE 'ok' END AS estado,
      CASE lang WHEN 'en' THEN source WHEN 'fr' THEN 'metodo=tesseract_ocr' END AS detalle,
      substr(text, 1, 300) AS recorte, replace(substr(text, 1, 200), chr(10), ' ') AS vista,
      n_chars / greatest(len(string_split(text, chr(10))), 1) < 100 AS escaneado,
      length({Q.strip('text')}) >= greatest(50, len(string_split(text, chr(10))) * 10) AS ocr_util
    FROM documents""",
)
def document_status(spark, folder):
    pages = F.size(F.split("text", "\n"))
    kept = F.when(F.col("n_chars") < 60, "").otherwise(X.strip("text"))
    method = F.when(F.col("lang") == "de", "pdfplumber").when(F.col("lang") == "fr", "tesseract_ocr")
    return table(spark, folder, "documents").select(
        "doc_id",
        X.status(F.lit("ok"), kept).alias("estado"),
        X.detail(F.when(F.col("lang") == "en", F.col("source")).otherwise(""), method).alias("detalle"),
        X.error_detail("text").alias("recorte"),
        X.preview("text").alias("vista"),
        X.needs_ocr("n_chars", pages).alias("escaneado"),
        X.ocr_accepted("text", pages).alias("ocr_util"),
    )


@query(
    "row_text",
    """WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'NaN' ELSE c_name END AS name,
        CASE WHEN c_nationkey > 12 THEN ' ' || c_nationkey || ' ' ELSE '  ' END AS nation,
        CASE WHEN c_mktsegment LIKE 'B%' THEN NULL ELSE c_mktsegment END AS segment FROM customer)
    SELECT c_custkey, concat_ws(' | ', CASE WHEN name <> 'NaN' THEN 'name: ' || name END,
        CASE WHEN trim(nation) <> '' THEN 'nation: ' || trim(nation) END, 'segment: ' || segment) AS linea FROM c
    WHERE name <> 'NaN' OR trim(nation) <> '' OR segment IS NOT NULL""",
)
def row_lines(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "NaN").otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") > 12, F.concat(F.lit(" "), "c_nationkey", F.lit(" ")))
        .otherwise("  ").alias("nation"),
        F.when(~F.col("c_mktsegment").startswith("B"), F.col("c_mktsegment")).alias("segment"),
        F.lit("1").alias("Unnamed: 0"),
    )
    line = X.row_text(["Unnamed: 0", "name", "nation", "segment"])
    return rows.select("c_custkey", line.alias("linea")).filter(F.col("linea") != "")


# -- compaction -------------------------------------------------------------------


@query(
    "latest_wins",
    """SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_wins(spark, folder):
    log = compact.latest_wins(table(spark, folder, "events"), "user_id", ["ts", "event_id"])
    return log.select("user_id", "event_id", "event_type", "value")


def _features(spark, folder):
    """Events as tile features: a type is a layer, an hour a tile; key 0 has no id."""
    k = F.get_json_object("props", "$.k")
    no_id = F.when(k != "0", k)

    def prop(name, value):
        return F.struct(F.lit(name).alias("k"), value.cast("string").alias("v"))

    return table(spark, folder, "events").select(
        F.concat(F.lit("t/"), F.date_format("ts", "yyyyMMddHH"), F.lit(".pbf")).alias("path"),
        F.col("event_type").alias("layer"),
        F.length("event_type").cast("bigint").alias("layer_pos"),
        F.col("event_id").alias("feature_pos"),
        F.array(
            prop("fid", no_id), prop("user", F.col("user_id")),
            prop("value", F.when(F.col("value") > 5, F.col("value").cast("int").cast("string")).otherwise("None")),
        ).alias("props"),
    )


FEATURES_SQL = """f AS (SELECT 't/' || strftime(ts, '%Y%m%d%H') || '.pbf' AS path, event_type AS layer,
    length(event_type) AS layer_pos, event_id, user_id, value, nullif(props ->> '$.k', '0') AS id FROM events),
kept AS (SELECT * FROM f QUALIFY id IS NULL OR
    row_number() OVER (PARTITION BY layer, id ORDER BY path, layer_pos, event_id) = 1)"""


@query(
    "feature_dedup",
    f"WITH {FEATURES_SQL} SELECT event_id, layer, id, path FROM kept",
)
def feature_dedup(spark, folder):
    features = _features(spark, folder).withColumn("id", tiles.feature_id(F.col("props")))
    kept = compact.first_wins_features(features)
    return kept.select(F.col("feature_pos").alias("event_id"), "layer", "id", "path")


TILES_SQL = f"""WITH {FEATURES_SQL}, l AS (SELECT path, layer_pos, event_id, concat_ws(' | ', 'fid: ' || id, 'user: ' || user_id,
        CASE WHEN value > 5 THEN 'value: ' || trunc(value)::INT END) AS linea FROM kept),
    x AS (SELECT path, string_agg(linea, chr(10) ORDER BY layer_pos, event_id) AS texto, count(*) AS n FROM l GROUP BY path),
    a AS (SELECT path, count(*) AS total FROM f GROUP BY path)
    SELECT a.path, coalesce(texto, '') AS texto, CASE WHEN texto IS NULL THEN 'duplicado_pbf' ELSE 'ok' END AS estado,
      total::BIGINT AS filas_totales, 'features=' || total || ' nuevas=' || coalesce(n, 0) AS detalle
    FROM a LEFT JOIN x USING (path)"""


@query("tile_documents", TILES_SQL)
def tile_texts(spark, folder):
    features = _features(spark, folder)
    return tiles.tile_documents(features, features.select("path").distinct())


@query("tiles_arriving", TILES_SQL)
def tiles_arriving(spark, folder):
    """The tiles in three arrivals; each writes its own and those that lose a feature to it, the last row of a tile counts."""
    run = f"{checkpoint_dir(spark)}/tiles-{uuid.uuid4().hex}"
    features = _features(spark, folder)
    for step in range(3):
        new = features.where(F.pmod(F.xxhash64("path"), F.lit(3)) == step)
        tiles.feature_owners(new).write.mode("append").parquet(f"{run}/owners")
        owners = spark.read.parquet(f"{run}/owners")
        # Read back from files its size is known: a short list of tiles goes to the features, which stay where they are.
        new.select("path").distinct().unionAll(tiles.losing_tiles(new, owners)).write.parquet(f"{run}/changed-{step}")
        changed = spark.read.parquet(f"{run}/changed-{step}")
        made = tiles.tile_documents(features.join(changed, "path", "left_semi"), changed, owners)
        made.withColumn("step", F.lit(step)).write.mode("append").parquet(f"{run}/documents")
    return compact.latest_wins(spark.read.parquet(f"{run}/documents"), "path", "step").drop("step")


@query(
    "resume_pending",
    "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def resume_pending(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return compact.pending(documents, table(spark, folder, "labels"))


@query(
    "missing_after_passes",
    """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels UNION SELECT conv_id FROM conversations)""",
)
def missing_after_passes(spark, folder):
    done = compact.done_keys(
        table(spark, folder, "labels"),
        table(spark, folder, "conversations").select(F.col("conv_id").alias("doc_id")),
    )
    return compact.pending(table(spark, folder, "documents").select("doc_id"), done)


# A status log made from events: users are documents, errors some of them for memory.
STATUS = """CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END"""
REASON = """CASE WHEN value > 20 THEN 'MemoryError: x' WHEN value > 10 THEN 'Unable to allocate'
    WHEN value > 5 THEN 'bad file' END"""


def _status_log(spark, folder):
    return table(spark, folder, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"),
        F.expr(STATUS).alias("estado"), F.expr(REASON).alias("detalle"),
    )


@query(
    "memory_retries",
    f"""WITH s AS (SELECT user_id, {STATUS} AS estado, {REASON} AS detalle FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    SELECT c_custkey AS doc_id, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM s WHERE estado = 'error'
      AND (detalle LIKE '%MemoryError%' OR detalle LIKE '%Unable to allocate%'))""",
)
def memory_retries(spark, folder):
    wanted = table(spark, folder, "customer").select(F.col("c_custkey").alias("doc_id"), "c_name")
    return compact.among(wanted, compact.out_of_memory(_status_log(spark, folder)))


# Failures of all kinds planted by event: memory, an isolated file, any other; a view is a state of its own.
LADDER = f"""CASE WHEN event_type = 'error' AND value > 20 THEN 'MemoryError: x' WHEN event_type = 'error' AND value > 10
    THEN '{V.LOST_DETAIL}' WHEN event_type = 'error' THEN 'bad file' END"""
LADDER_STATE = "CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN 'vacio' ELSE 'ok' END"


@query(
    "attempt_ladder",
    f"""WITH l AS (SELECT user_id AS doc_id, event_id, 1 + event_id % 3 AS tries, {LADDER_STATE} AS estado, {LADDER} AS detalle FROM events),
    k AS (SELECT doc_id, sum(tries)::BIGINT AS intentos, bool_or(estado = 'error') AS failed, arg_max(estado, event_id) AS estado,
      arg_max(coalesce(detalle, ''), event_id) AS detalle FROM l GROUP BY doc_id)
    SELECT doc_id, intentos, CASE WHEN estado = 'vacio' THEN 'vacio' WHEN estado = 'ok' AND failed THEN 'reintento' WHEN estado = 'ok'
      THEN 'primera' WHEN detalle LIKE '%MemoryError%' THEN 'memoria' WHEN detalle LIKE '%pasada' THEN 'aislado' ELSE 'error' END AS peldano
    FROM k""",
)
def attempt_ladder(spark, folder):
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), (1 + F.col("event_id") % 3).alias("intentos"),
        F.expr(LADDER_STATE).alias("estado"), F.expr(LADDER).alias("detalle"),
    )
    return compact.attempt_ladder(log)


@query(
    "passes_compacted",
    f"""WITH p AS (SELECT user_id AS doc_id, event_id, {STATUS} AS estado, 0 AS pass FROM events WHERE event_type <> 'click'
        UNION ALL SELECT user_id, event_id, 'retry', 1 FROM events WHERE event_type = 'error' AND value > 20)
    SELECT doc_id, event_id AS seq, estado, pass::BIGINT AS pass FROM p
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pass DESC, event_id DESC) = 1""",
)
def passes_compacted(spark, folder):
    events = table(spark, folder, "events")
    first = events.filter(F.col("event_type") != "click").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), F.expr(STATUS).alias("estado")
    )
    retry = events.filter((F.col("event_type") == "error") & (F.col("value") > 20)).select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), F.lit("retry").alias("estado")
    )
    return compact.latest_wins(compact.append_passes(first, retry), "doc_id", ["pass", "seq"])


@query(
    "log_buckets",
    f"""WITH s AS (SELECT user_id, event_id, {STATUS} AS estado, {REASON} AS detalle FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    SELECT user_id AS doc_id, estado, detalle FROM s""",
)
def log_buckets(spark, folder):
    """The events as a log of three runs, compacted after each: the later runs rewrite the buckets they touch."""
    out = f"{checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    log = _status_log(spark, folder)
    ends = log.agg(F.percentile_approx("seq", F.array(F.lit(0.9), F.lit(0.99), F.lit(1.0)), F.lit(1000))).first()[0]
    since = 0
    for end in ends:
        log_table.compact(spark, log.where(F.col("seq") <= end), f"{out}/documentos", ["doc_id", "estado", "detalle"], since)
        since = end
    return log_table.read(spark, f"{out}/documentos")


@query(
    "jsonl_rows",
    """SELECT event_id AS seq, user_id::VARCHAR AS doc_id, event_type AS estado FROM events
    WHERE event_type <> 'error' AND user_id IS NOT NULL""",
)
def jsonl_rows(spark, folder):
    # Lines of one kind are torn in the middle, as an interrupted writer leaves them.
    line = F.to_json(
        F.struct(F.col("user_id").cast("string").alias("doc_id"), F.col("event_type").alias("estado"))
    )
    torn = F.when(F.col("event_type") == "error", F.substring(line, 1, 20)).otherwise(line)
    lines = table(spark, folder, "events").select(F.col("event_id").alias("seq"), torn.alias("value"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_id", "estado")])
    return parse_lines(lines, schema)


# -- statistics -------------------------------------------------------------------


def _with_states(spark, folder):
    """Documents with states taken from labels, to have something to summarise."""
    labels = table(spark, folder, "labels")
    rows = table(spark, folder, "documents").join(labels, "doc_id", "left")
    return rows.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("source").alias("fuente"),
        F.when(F.col("toxic") == 1, "error").when(F.col("quality") == 0, "vacio")
        .when(F.col("quality") == 1, "ok").when(F.col("lang") != "de", "ok").alias("estado"),
        F.when(F.col("lang") != "es", F.concat("lang", F.lit("x"))).alias("formato"),
        F.when(F.col("n_chars") > 1000, F.lit(1)).when(F.col("n_chars") > 300, F.lit(2))
        .cast("bigint").alias("fenomeno"),
        F.col("lang").alias("idioma"),
        F.col("text").alias("texto"),
        X.word_count("text").alias("n_palabras"),
        F.col("n_chars").alias("n_caracteres"),
        F.when(F.col("quality").isNotNull(), F.col("toxic") == 1).alias("truncado"),
    )


STATES_SQL = f"""d AS (SELECT doc_id, source, lang AS idioma, text, {Q.n_words('text')} AS n_palabras, n_chars,
    CASE WHEN toxic = 1 THEN 'error' WHEN quality = 0 THEN 'vacio' WHEN quality = 1 THEN 'ok'
      WHEN lang <> 'de' THEN 'ok' END AS estado,
    CASE WHEN lang <> 'es' THEN lang || 'x' END AS formato,
    CASE WHEN n_chars > 1000 THEN 1 WHEN n_chars > 300 THEN 2 END AS fenomeno,
    toxic = 1 AS truncado FROM documents LEFT JOIN labels USING (doc_id))"""
TOP_SQL = """SELECT idioma, count(*) AS n FROM d WHERE estado = 'ok' AND idioma IS NOT NULL
    GROUP BY idioma ORDER BY n DESC, idioma LIMIT 12"""


@query(
    "corpus_summary",
    f"""WITH {STATES_SQL}, top AS ({TOP_SQL})
    SELECT 'documentos_totales' AS metric, NULL::VARCHAR AS key, count(*)::BIGINT AS value FROM d
    UNION ALL SELECT 'documentos_ok', NULL, count(*) FILTER (WHERE estado = 'ok') FROM d
    UNION ALL SELECT 'documentos_no_ok', NULL, count(*) FILTER (WHERE estado IS DISTINCT FROM 'ok') FROM d
    UNION ALL SELECT 'palabras_totales', NULL, sum(n_palabras)::BIGINT FROM d
    UNION ALL SELECT 'caracteres_totales', NULL, sum(n_chars)::BIGINT FROM d
    UNION ALL SELECT 'truncados', NULL, count(*) FILTER (WHERE truncado) FROM d
    UNION ALL SELECT 'por_estado', estado, count(*) FROM d WHERE estado IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'por_formato', formato, count(*) FROM d WHERE formato IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'ok_por_formato', formato, count(*) FROM d WHERE formato IS NOT NULL AND estado = 'ok' GROUP BY 2
    UNION ALL SELECT 'por_fenomeno', fenomeno::VARCHAR, count(*) FROM d WHERE fenomeno IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'por_idioma', idioma, n FROM top""",
)
def corpus_summary(spark, folder):
    return stats.corpus_summary(_with_states(spark, folder))


@query("top_languages", f"WITH {STATES_SQL} {TOP_SQL}")
def top_languages(spark, folder):
    return stats.top_languages(_with_states(spark, folder))


@query(
    "error_rows",
    f"""WITH {STATES_SQL} SELECT doc_id::VARCHAR AS doc_id, source AS fuente, estado, formato, fenomeno::BIGINT AS fenomeno,
        idioma, n_palabras::BIGINT AS n_palabras, n_chars AS n_caracteres, truncado FROM d WHERE estado IS DISTINCT FROM 'ok'""",
)
def error_rows(spark, folder):
    return stats.error_rows(_with_states(spark, folder))


@query(
    "metadata_table",
    f"""WITH {STATES_SQL} SELECT doc_id::VARCHAR AS doc_id, source AS fuente, estado, formato, fenomeno::BIGINT AS fenomeno,
        idioma, n_palabras::BIGINT AS n_palabras, n_chars AS n_caracteres, truncado FROM d""",
)
def metadata_table(spark, folder):
    return stats.metadata_table(_with_states(spark, folder))


def _chunks(spark, folder):
    return C.chunk_documents(corpus(spark, folder))


@query(
    "chunk_statistics",
    f"""WITH {Q.CHUNKS} SELECT count(DISTINCT doc_id)::BIGINT AS documents, count(*)::BIGINT AS chunks,
        avg(n_caracteres_chunk) AS mean_chars, avg(num_tokens) AS mean_words, avg(num_tokens) AS mean_tokens,
        count(*) / count(DISTINCT doc_id) AS chunks_per_document FROM chunks""",
)
def chunk_statistics(spark, folder):
    return stats.chunk_statistics(_chunks(spark, folder))


@query(
    "length_percentiles",
    f"""WITH {Q.CHUNKS} SELECT quantile_cont(num_tokens, 0.5) AS p50, quantile_cont(num_tokens, 0.9) AS p90,
        max(num_tokens)::BIGINT AS max FROM chunks""",
)
def length_percentiles(spark, folder):
    return stats.length_percentiles(_chunks(spark, folder))


@query(
    "token_buckets",
    f"""SELECT CASE WHEN {Q.n_words('text')} <= 1500 THEN 'short' ELSE 'long' END AS bucket, count(*)::BIGINT AS n,
        sum({Q.n_words('text')})::BIGINT AS tokens FROM documents GROUP BY 1""",
)
def token_buckets(spark, folder):
    rows = table(spark, folder, "documents").select(X.word_count("text").alias("tokens"))
    return rows.groupBy(C.token_bucket("tokens").alias("bucket")).agg(
        F.count("*").alias("n"), F.sum("tokens").alias("tokens")
    )


@query(
    "boundary_share",
    f"""WITH {Q.CHUNKS}, b AS (SELECT lang, last OR regexp_matches(right(texto, 5), '{V.CLOSING.replace("'", "''")}') AS ok FROM chunks)
    SELECT lang AS idioma, count(*)::BIGINT AS n, count(*) FILTER (WHERE ok)::BIGINT AS ok,
        100.0::DOUBLE * count(*) FILTER (WHERE ok) / count(*) AS pct FROM b GROUP BY lang""",
)
def boundary_share(spark, folder):
    return stats.boundary_share(_chunks(spark, folder))


# -- JSON ---------------------------------------------------------------------------

PARAGRAPHS = "string_split(text, chr(10))"


def _json_files(spark, folder):
    """Documents as JSON files: every language in another of the known layouts."""
    rows = table(spark, folder, "documents").withColumn("ps", F.split("text", "\n"))
    title = F.concat(F.lit(" "), "source", F.lit(" "), "doc_id").alias("title")
    lists = (
        F.array("source", F.lit(" "), "lang").alias("tags"),
        F.array(F.col("n_chars")).alias("keywords"),
        F.array(F.lit("A"), F.col("source")).alias("authors"),
    )
    common = (F.concat(F.lit("http://x/"), "doc_id").alias("source_url"), *lists)
    article = F.struct(title, *common, F.col("ps").alias("body_paragraphs"), F.col("text").alias("body_text"))
    section = F.struct(F.col("source").alias("heading"), F.col("ps").alias("paragraphs"))
    sections = F.struct(title, *common, F.array(section).alias("sections"), F.array("lang").alias("lists"))
    abstract = F.struct(title, *common, F.col("text").alias("abstract"), F.col("text").alias("excerpt"))
    report = F.struct(
        *common,
        F.struct(F.struct(F.col("text").alias("z"), F.col("text").alias("a")).alias("sections")).alias("content"),
        F.struct(F.col("source").alias("title"), F.lit("about").alias("description")).alias("metadata"),
    )
    raw = (
        F.when(F.col("lang") == "en", F.to_json(article)).when(F.col("lang") == "fr", F.to_json(sections))
        .when(F.col("lang") == "de", F.to_json(abstract)).otherwise(F.to_json(report))
    )
    return rows.select("doc_id", raw.alias("raw"))


@query(
    "json_documents",
    f"""WITH p AS (SELECT doc_id, lang, source, n_chars, {Q.strip('text')} AS txt, source || ' ' || doc_id AS title,
        array_to_string(list_filter(list_transform({PARAGRAPHS}, lambda x: {Q.strip('x')}), lambda x: x <> ''), chr(10)||chr(10)) AS ps
        FROM documents), j AS (SELECT *, chr(10)||chr(10) AS gap FROM p)
    SELECT doc_id, CASE lang WHEN 'en' THEN 'articulo' WHEN 'fr' THEN 'pagina_secciones' WHEN 'de' THEN 'resumen_academico'
        ELSE 'reporte_secciones' END AS subtipo_json, CASE WHEN lang = 'es' THEN source ELSE title END AS titulo,
      'A; ' || source AS autores, source || '; ' || lang || '; ' || n_chars AS etiquetas, 'http://x/' || doc_id AS url,
      CASE lang WHEN 'en' THEN title || gap || ps WHEN 'fr' THEN title || gap || source || gap || ps || gap || lang
        WHEN 'de' THEN title || gap || txt ELSE 'z' || gap || txt || gap || 'about' || gap || 'a' || gap || txt END AS texto,
      'ok' AS estado FROM j""",
)
def json_files(spark, folder):
    return json_documents(_json_files(spark, folder)).select(
        "doc_id", "subtipo_json", "titulo", "autores", "etiquetas", "url", "texto", "estado"
    )


@query(
    "json_alerts",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'sin_cuerpo' ELSE 'alerta_temprana' END AS subtipo_json,
      event_type AS titulo, CASE WHEN event_type <> 'error' THEN 'd' || user_id END AS fecha,
      CASE WHEN event_type = 'error' THEN event_type ELSE event_type || chr(10) || chr(10) || 'Tipo de alerta: ' || event_type || '. Municipios: ' || user_id || '.' END AS texto
    FROM events""",
)
def json_alerts(spark, folder):
    alert = F.struct(
        F.col("event_type").alias("tipo"), F.concat(F.lit("d"), "user_id").alias("fecha_emision"),
        F.col("user_id").cast("string").alias("municipios"),
    )
    shown = F.when(F.col("event_type") != "error", alert).alias("alerta_meta")
    raw = F.to_json(F.struct(F.lit("").alias("title"), F.col("event_type").alias("titulo"), shown))
    files = table(spark, folder, "events").select("event_id", raw.alias("raw"))
    return json_documents(files).select("event_id", "subtipo_json", "titulo", "fecha", "texto")


@query(
    "json_catalogs",
    """SELECT o_orderkey, 'b: ' || o_orderstatus || ' | a: ' || o_custkey || '.0' || chr(10) ||
        'b: ' || o_orderpriority || ' | c: True' AS texto, 2::BIGINT AS filas_totales FROM orders""",
)
def json_catalogs(spark, folder):
    raw = F.format_string(
        '[{"b": "%s", "Unnamed: 0": 1, "a": %d}, {"b": "%s", "c": true, "a": null}]',
        "o_orderstatus", "o_custkey", "o_orderpriority",
    )
    files = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    return json_documents(files).select("o_orderkey", "texto", "filas_totales")


# -- CSV ------------------------------------------------------------------------


@query(
    "csv_documents",
    """SELECT c_nationkey::VARCHAR AS doc_id, count(*)::BIGINT AS filas_totales,
        string_agg('c_custkey: ' || c_custkey || ' | c_name: ' || c_name ||
            CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE ' | c_mktsegment: ' || replace(c_mktsegment, 'A', ';"') END,
            chr(10) ORDER BY c_custkey) AS texto
    FROM customer WHERE c_custkey % 11 <> 0 GROUP BY c_nationkey""",
)
def csv_files(spark, folder):
    """Customers written as a CSV file for each nation, with quoted cells, short rows and long ones, and read back."""
    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    segment = F.concat(F.lit('"'), F.replace("c_mktsegment", F.lit("A"), F.lit(';""')), F.lit('"'))
    last = F.when(F.col("c_mktsegment") != "FURNITURE", segment)
    more = F.when(F.col("c_custkey") % 11 == 0, F.lit("x;y"))
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", last, more)
    rows = table(spark, folder, "customer").select("c_nationkey", "c_custkey", line.alias("value"))
    heads = rows.select("c_nationkey").distinct().select(
        "c_nationkey", F.lit(-1).cast("bigint"), F.lit("c_custkey;c_name;c_mktsegment")
    )
    ordered = rows.unionAll(heads).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    schema = "c_custkey STRING, c_name STRING, c_mktsegment STRING"
    read = csv_rows(spark, f"{path}/*", ";", schema=schema)
    return csv_documents(read, F.regexp_extract("_file", "c_nationkey=([^/]*)/", 1))


@query(
    "json_large_numbers",
    """SELECT o_orderkey::VARCHAR AS doc_id, (o_orderkey::HUGEINT * 100000000000000000000 + 7)::VARCHAR AS url,
        'second' AS titulo FROM orders""",
)
def json_large_numbers(spark, folder):
    """Orders as files with an integer beyond 64 bits and a repeated key, of which the last one counts."""
    # A setting of the session's JSON parser; the command line sets it for all its work.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    key = F.col("o_orderkey").cast("string")
    number = F.when(F.col("o_orderkey") == 0, "7").otherwise(F.concat(key, F.lit("0" * 19 + "7")))
    raw = F.concat(F.lit('{"title": "first", "url": '), number, F.lit(', "title": "second", "abstract": "x"}'))
    files = table(spark, folder, "orders").select(key.alias("doc_id"), raw.alias("raw"))
    return json_documents(files).select("doc_id", "url", "titulo")
