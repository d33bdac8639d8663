"""Text cleaning, measuring, segmentation and chunking over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import segment
from docloom.functions import text as X
from docloom.functions.arrays import explode_items
from docloom.functions.tokens import rank_counter
from docloom.operators import chunks as C
from docloom.operators.pages import boilerplate, ordered_text, strip_page_array, strip_page_lines
from docloom.plans import sql as Q
from docloom.plans.registry import as_pages, corpus, query, table

# The documents are clean already, so the cleaning queries soil them first: accents
# decomposed, odd and zero-width spaces, tabs, leader dots, control characters.
SOIL = (
    ("\u00e9", "e\u0301"), ("\u00f1", "n\u0303"), (", ", ",\u00a0\t\u200b "),
    (" of ", "\u2003of\u00ad "), (".\n", " . . . . . 14\r\n\r\n\r\n \n"),
    (" la ", " \x07la\t\t"),
)


def _soiled(c):
    for old, new in SOIL:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _soiled_sql(x: str) -> str:
    for old, new in SOIL:
        x = f"replace({x}, '{old}', '{new}')"
    return x


def _lines(spark, folder):
    """Lines of all documents with their position."""
    rows = table(spark, folder, "documents")
    return explode_items(rows, ["doc_id"], F.split("text", "\n"), "pos", "linea")


LINES = """lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS linea,
    unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)"""


def _full_clean_sql(x: str) -> str:
    t = f"nfc_normalize(coalesce({x}, ''))"
    t = f"regexp_replace({t}, '[\\x{{ad}}\\x{{200b}}-\\x{{200f}}\\x{{2028}}\\x{{2029}}\\x{{feff}}\\x{{202a}}-\\x{{202e}}]', '', 'g')"
    t = f"regexp_replace({t}, '{V.ODD_SPACES}', ' ', 'g')"
    t = f"regexp_replace({t}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')"
    t = f"regexp_replace({t}, '\\r\\n?', chr(10), 'g')"
    t = f"regexp_replace({t}, '(?:\\.{V.WS}?){{4,}}', ' ', 'g')"
    t = f"regexp_replace({t}, '[ \\t]+', ' ', 'g')"
    t = f"regexp_replace({t}, '[ \\t]+\\n', chr(10), 'g')"
    return Q.strip(f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query("clean_document", f"SELECT doc_id, {_full_clean_sql(_soiled_sql('text'))} AS texto FROM documents")
def clean_document(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", X.clean_document(_soiled(F.col("text"))).alias("texto"))


@query("clean_text", f"SELECT doc_id, {Q.light_clean(_soiled_sql('text'))} AS texto FROM documents")
def clean_text(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", X.clean_text(_soiled(F.col("text"))).alias("texto"))


@query(
    "text_stats",
    f"""SELECT doc_id, {Q.n_words('text')}::BIGINT AS n_palabras, length(text)::BIGINT AS n_caracteres,
        CASE WHEN text <> '' THEN sha1(text) END AS hash_sha1 FROM documents""",
)
def text_stats(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", X.word_count("text").alias("n_palabras"),
        X.char_count("text").alias("n_caracteres"), X.sha1_hex("text").alias("hash_sha1"),
    )


# A page label in front of some lines, so that the number test has something to find.
PAGED = """CASE WHEN pos = 0 THEN ' - ' || (doc_id % 20000) || ' -'
    WHEN pos = 1 THEN 'Página ' || doc_id || ' de ' || pos ELSE linea END"""


@query(
    "line_signatures",
    rf"""WITH {LINES}, p AS (SELECT doc_id, pos, {PAGED} AS l FROM lines)
    SELECT doc_id, pos::BIGINT AS pos,
      regexp_replace(regexp_replace(lower({Q.strip('l')}), '\p{{Nd}}+', '#', 'g'), '{V.WS}+', ' ', 'g') AS firma,
      regexp_matches(l, '\A{V.WS}*[-–—|]*{V.WS}*\p{{Nd}}{{1,4}}{V.WS}*[-–—|]*{V.WS}*\z') OR
      regexp_matches(l, '(?i)\A{V.WS}*(p[aá]g(ina)?\.?|page|pag\.){V.WS}*\p{{Nd}}+{V.WS}*(de|of|/)?{V.WS}*\p{{Nd}}*{V.WS}*\z')
        AS es_numeracion
    FROM p""",
)
def line_signatures(spark, folder):
    line = F.expr(PAGED)
    return _lines(spark, folder).select(
        "doc_id", "pos", X.line_signature(line).alias("firma"),
        X.is_page_number(line).alias("es_numeracion"),
    )


@query(
    "hyphen_paragraphs",
    rf"""WITH s AS (SELECT doc_id, regexp_replace(replace(replace(text, 'ing ', 'i-' || chr(10) || 'ng '),
          '.' || chr(10), '.' || chr(10) || ' ' || chr(10)), '{V.HYPHEN_BREAK}', '\1\2', 'g') AS t FROM documents)
    SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex(t, '\n{V.WS}*\n'),
        lambda b: array_to_string(list_filter(list_transform(string_split(b, chr(10)), lambda l: {Q.strip('l')}),
            lambda l: l <> ''), ' ')), lambda b: b <> ''), chr(10) || chr(10)) AS texto FROM s""",
)
def hyphen_paragraphs(spark, folder):
    broken = F.replace(
        F.replace("text", F.lit("ing "), F.lit("i-\nng ")), F.lit(".\n"), F.lit(".\n \n")
    )
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", X.rebuild_paragraphs(broken).alias("texto"))


@query(
    "sentence_split",
    f"""WITH s AS (SELECT doc_id, {Q.split_sentences(Q.light_clean('text'))} AS ss FROM documents)
    SELECT doc_id, unnest(range(len(ss)))::BIGINT AS pos, unnest(ss) AS oracion FROM s""",
)
def sentence_split(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return C.sentences(rows, "text", "lang").select("doc_id", "pos", "oracion")


@query(
    "sentence_cjk",
    f"""WITH s AS (SELECT doc_id, {Q.split_sentences(Q.light_clean("replace(text, '.', '。')"), '[。！？\\n]', V.WS + '*')} AS ss
        FROM documents)
    SELECT doc_id, unnest(range(len(ss)))::BIGINT AS pos, unnest(ss) AS oracion FROM s""",
)
def sentence_cjk(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", F.replace("text", F.lit("."), F.lit("。")).alias("text"), F.lit("zh").alias("lang")
    )
    return C.sentences(rows, "text", "lang").select("doc_id", "pos", "oracion")


@query(
    "sentence_strict_routing",
    f"""WITH t AS (SELECT doc_id, lang, {Q.light_clean('text')} AS txt FROM documents), s AS (
        SELECT doc_id, CASE WHEN lang = 'de' THEN CASE WHEN txt <> '' THEN [txt] ELSE [] END
          ELSE {Q.split_sentences('txt')} END AS ss FROM t)
    SELECT doc_id, unnest(range(len(ss)))::BIGINT AS pos, unnest(ss) AS oracion FROM s""",
)
def sentence_strict_routing(spark, folder):
    # German is relabelled with a code no route knows, so its texts stay whole.
    lang = F.when(F.col("lang") == "de", F.lit("sv")).otherwise(F.col("lang"))
    rows = table(spark, folder, "documents").select("doc_id", "text", lang.alias("lang"))
    return C.sentences(rows, "text", "lang", segment.by_strict_routing).select(
        "doc_id", "pos", "oracion"
    )


@query(
    "chunks",
    f"""WITH {Q.CHUNKS} SELECT chunk_id, doc_id, posicion, texto, num_tokens::BIGINT AS num_tokens,
        source AS fuente, lang AS idioma, n_caracteres_chunk::BIGINT AS n_caracteres_chunk,
        num_tokens::BIGINT AS n_palabras_chunk, last FROM chunks""",
)
def chunks(spark, folder):
    return C.chunk_documents(C.valid_documents(corpus(spark, folder))).select(
        "chunk_id", "doc_id", "posicion", "texto", "num_tokens", "fuente", "idioma",
        "n_caracteres_chunk", "n_palabras_chunk", "last",
    )


def _strict_lines(text, language):
    """Lines as sentences; a text with an address in it is refused."""
    at = text.find("@")
    if at >= 0:
        raise ValueError(f"{language}: '@' at {at}")
    return [line.strip(V.BLANKS) for line in text.split("\n") if line.strip(V.BLANKS)]


STRICT_LINES = segment.Guarded(_strict_lines)


@query(
    "chunking_errors",
    f"""WITH t AS (SELECT doc_id, lang, {Q.light_clean('text')} AS txt FROM documents),
    l AS (SELECT *, list_filter(list_transform(string_split(txt, chr(10)), lambda s: {Q.strip('s')}), lambda s: s <> '') AS ss
      FROM t),
    p AS (SELECT *, {Q.packed('ss', 'length(s)', V.CHUNK_CHARS)} AS cs FROM l WHERE len(ss) > 0)
    SELECT doc_id::VARCHAR AS doc_id, CASE WHEN strpos(txt, '@') = 0 THEN list_max(cs) + 1 ELSE 0 END AS n_chunks,
      CASE WHEN strpos(txt, '@') > 0 THEN lang || ': ''@'' at ' || (strpos(txt, '@') - 1) END AS error
    FROM p""",
)
def chunking_errors(spark, folder):
    """Chunks of every document, or why it could not be cut, from one pass."""
    rows = C.chunk_documents(C.valid_documents(corpus(spark, folder)), STRICT_LINES, errors=True)
    # A document's chunks are in one task, so this combines before the shuffle.
    return rows.groupBy("doc_id").agg(F.count("texto").alias("n_chunks"), F.max("error").alias("error"))


#: A rank file of a public byte-pair vocabulary; it is not part of this repository.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


# SQL cannot express merging by rank: tested against plain Python.
@query("chunk_tokens")
def chunk_tokens(spark, folder, ranks=RANKS):
    made = C.chunk_documents(
        C.valid_documents(corpus(spark, folder)), count_tokens=rank_counter(spark, ranks)
    )
    bucket = C.token_bucket("num_tokens").alias("bucket")
    return made.select("chunk_id", "doc_id", "posicion", "num_tokens", "n_palabras_chunk", bucket)


@query(
    "fragments",
    f"""WITH src AS (SELECT doc_id, text AS txt FROM documents), {Q.fragments('src', 'doc_id')}
    SELECT doc_id, frag_pos::BIGINT AS frag_pos, text, {Q.n_words('text')}::BIGINT AS n_words FROM fr""",
)
def fragments(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("texto"), F.col("lang").alias("idioma")
    )
    return C.fragment_chunks(rows).withColumn("n_words", X.word_count("text"))


@query(
    "first_words",
    f"""SELECT doc_id, CASE WHEN {Q.n_words('text')} > 400
        THEN array_to_string({Q.words('text')}[1:400], ' ') ELSE text END AS texto FROM documents""",
)
def first_words(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.first_words("text").alias("texto"))


@query(
    "metadata_records",
    f"""WITH {Q.CHUNKS} SELECT doc_id, chunk_id, source AS fuente, 'txt' AS formato,
        length(source)::BIGINT AS fenomeno, posicion, num_tokens::BIGINT AS num_tokens, texto, lang AS idioma
    FROM chunks""",
)
def metadata_records(spark, folder):
    coded = corpus(spark, folder).withColumn("fenomeno", F.length("fuente").cast("string"))
    made = C.chunk_documents(coded).drop("observatorio", "titulo", "url", "fecha")
    C.assert_sources(made)
    return C.metadata_records(made)


@query(
    "page_boilerplate",
    rf"""WITH p AS (SELECT source AS doc_id, doc_id AS page,
        list_filter(string_split(text, chr(10)), lambda l: {Q.strip('l')} <> '') AS ls FROM documents),
    c AS (SELECT DISTINCT doc_id, page, unnest(ls[1:3] || ls[greatest(len(ls) - 2, 1):]) AS l FROM p),
    g AS (SELECT doc_id, regexp_replace(regexp_replace(lower({Q.strip('l')}), '\p{{Nd}}+', '#', 'g'), '{V.WS}+', ' ', 'g') AS firma FROM c),
    n AS (SELECT doc_id, firma, count(*) AS n FROM g WHERE length(firma) BETWEEN 1 AND 120 GROUP BY ALL),
    z AS (SELECT source AS doc_id, count(*) AS pages FROM documents GROUP BY ALL HAVING count(*) >= 4)
    SELECT doc_id, firma, n::BIGINT AS n FROM n JOIN z USING (doc_id)
    WHERE n >= greatest(3, floor(pages * 0.05))""",
)
def page_boilerplate(spark, folder):
    return boilerplate(as_pages(spark, folder), ratio=0.05)


@query(
    "strip_page_lines",
    rf"""WITH p AS (SELECT source, doc_id, string_split(text, chr(10)) AS al,
        list_filter(string_split(text, chr(10)), lambda l: {Q.strip('l')} <> '') AS ls FROM documents),
    c AS (SELECT DISTINCT source, doc_id, unnest(ls[1:3] || ls[greatest(len(ls) - 2, 1):]) AS l FROM p),
    g AS (SELECT source, regexp_replace(regexp_replace(lower({Q.strip('l')}), '\p{{Nd}}+', '#', 'g'), '{V.WS}+', ' ', 'g') AS firma FROM c),
    n AS (SELECT source, firma, count(*) AS n FROM g WHERE length(firma) BETWEEN 1 AND 120 GROUP BY ALL),
    z AS (SELECT source, count(*) AS pages FROM documents GROUP BY ALL HAVING count(*) >= 4),
    b AS (SELECT source, firma FROM n JOIN z USING (source) WHERE n >= greatest(3, floor(pages * 0.05))),
    al AS (SELECT source, doc_id, unnest(al) AS l, unnest(range(len(al))) AS i FROM p),
    s AS (SELECT *, regexp_replace(regexp_replace(lower({Q.strip('l')}), '\p{{Nd}}+', '#', 'g'), '{V.WS}+', ' ', 'g') AS firma FROM al),
    k AS (SELECT s.* FROM s WHERE {Q.strip('l')} <> '' AND NOT regexp_matches(l, '\A{V.WS}*[-–—|]*{V.WS}*\p{{Nd}}{{1,4}}{V.WS}*[-–—|]*{V.WS}*\z')
        AND NOT EXISTS (SELECT 1 FROM b WHERE b.source = s.source AND b.firma = s.firma)),
    -- No document holds a blank line, so a page rebuilds to one paragraph.
    j AS (SELECT source, doc_id, string_agg({Q.strip('l')}, ' ' ORDER BY i) AS texto FROM k GROUP BY ALL)
    SELECT d.source AS doc_id, d.doc_id AS page, coalesce(j.texto, '') AS texto
    FROM documents d LEFT JOIN j USING (source, doc_id)""",
)
def page_lines(spark, folder):
    return strip_page_lines(as_pages(spark, folder), ratio=0.05)


@query(
    "page_arrays",
    rf"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS linea,
        unnest(range(len(string_split(text, chr(10))))) AS page FROM documents),
    al AS (SELECT doc_id, page, unnest(CASE WHEN page % 4 = 3 THEN [linea, (page + 1)::VARCHAR]
        ELSE ['Informe ' || doc_id, linea, (page + 1)::VARCHAR] END) AS l,
        unnest(range(CASE WHEN page % 4 = 3 THEN 2 ELSE 3 END)) AS i FROM p),
    s AS (SELECT *, regexp_replace(regexp_replace(lower({Q.strip('l')}), '\p{{Nd}}+', '#', 'g'), '{V.WS}+', ' ', 'g') AS firma
        FROM al WHERE {Q.strip('l')} <> ''),
    c AS (SELECT DISTINCT doc_id, page, l, firma FROM s),
    n AS (SELECT doc_id, firma, count(*) AS n FROM c WHERE length(firma) BETWEEN 1 AND 120 GROUP BY ALL),
    z AS (SELECT doc_id, count(*) AS pages FROM p GROUP BY ALL),
    b AS (SELECT doc_id, firma FROM n JOIN z USING (doc_id) WHERE pages >= 4 AND n >= greatest(3, floor(pages * 0.5))),
    k AS (SELECT s.* FROM s WHERE NOT regexp_matches(l, '\A{V.WS}*[-–—|]*{V.WS}*\p{{Nd}}{{1,4}}{V.WS}*[-–—|]*{V.WS}*\z')
        AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = s.doc_id AND b.firma = s.firma)),
    j AS (SELECT doc_id, page, string_agg({Q.strip('l')}, ' ' ORDER BY i) AS texto FROM k GROUP BY ALL)
    SELECT p.doc_id, p.page::BIGINT AS page, coalesce(j.texto, '') AS texto FROM p LEFT JOIN j USING (doc_id, page)""",
)
def page_arrays(spark, folder):
    # A line is a page under a heading, which every fourth page lacks, and over its number.
    rows = table(spark, folder, "documents")
    heading = F.concat(F.lit("Informe "), "doc_id", F.lit("\n"))
    paged = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.concat(F.when(i % 4 == 3, "").otherwise(heading), x, F.lit("\n"), (i + 1).cast("string")),
    )
    stripped = rows.select("doc_id", strip_page_array(paged).alias("_pages"))
    return explode_items(stripped, ["doc_id"], "_pages", "page", "texto")


MENU = f"""menu AS (SELECT doc_id, linea, pos, lag({Q.strip('linea')}) OVER (PARTITION BY doc_id ORDER BY pos) AS previa FROM lines),
kept AS (SELECT doc_id, linea, pos FROM menu WHERE NOT ({Q.strip('linea')} <> '' AND {Q.strip('linea')} = coalesce(previa, '')
    AND length({Q.strip('linea')}) < 60))"""


@query(
    "menu_lines",
    f"""WITH {LINES}, {MENU} SELECT doc_id,
        (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::BIGINT AS pos, linea FROM kept""",
)
def menu_lines(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("_lines"))
    return explode_items(rows, ["doc_id"], X.drop_repeated_menu_lines("_lines"), "pos", "linea")


PREAMBLE = f"""num AS (SELECT doc_id, linea, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM kept),
fp AS (SELECT doc_id, min(i) FILTER (WHERE {Q.n_words('linea')} >= 12 AND
    right({Q.strip('linea')}, 1) IN ('.', '!', '?', ':', ';')) AS first_pos FROM num GROUP BY doc_id),
pre AS (SELECT doc_id, count(*) FILTER (WHERE i < first_pos AND {Q.strip('linea')} <> '') AS h,
    count(*) FILTER (WHERE i < first_pos AND {Q.strip('linea')} <> '' AND {Q.n_words('linea')} < 8) AS c
    FROM num JOIN fp USING (doc_id) GROUP BY doc_id),
cutoff AS (SELECT doc_id, coalesce(first_pos, -1) AS first_pos,
    CASE WHEN first_pos > 0 AND h > 0 AND c / h >= 0.8 THEN first_pos ELSE 0 END AS n_removed
    FROM fp JOIN pre USING (doc_id))"""


@query(
    "web_preamble",
    f"""WITH {LINES}, {MENU}, {PREAMBLE}
    SELECT doc_id, first_pos::BIGINT AS first_pos, n_removed::BIGINT AS n_removed FROM cutoff""",
)
def web_preamble(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("_lines"))
    kept = rows.withColumn("_lines", X.drop_repeated_menu_lines("_lines"))
    return kept.select(
        "doc_id", X.first_prose("_lines").cast("bigint").alias("first_pos"),
        X.preamble_size("_lines").cast("bigint").alias("n_removed"),
    )


@query(
    "text_dumps",
    f"""WITH {LINES}, {MENU}, {PREAMBLE},
    body AS (SELECT doc_id, string_agg(linea, chr(10) ORDER BY i) AS texto FROM num JOIN cutoff USING (doc_id)
        WHERE i >= n_removed GROUP BY doc_id)
    SELECT d.doc_id, 'http://' || source || '/' || d.doc_id AS url, coalesce(texto, '') AS texto,
        CASE WHEN {Q.strip("coalesce(texto, '')")} <> '' THEN 'ok' ELSE 'vacio' END AS estado
    FROM documents d LEFT JOIN body USING (doc_id)""",
)
def text_dumps(spark, folder):
    from docloom.sources.text_files import text_documents

    header = F.concat(
        F.lit("SOURCE: http://"), "source", F.lit("/"), "doc_id", F.lit("\nSCRAPED: 2024-01-01\n===\n")
    )
    raw = table(spark, folder, "documents").select(
        "doc_id", F.concat(header, "text").alias("raw")
    )
    return text_documents(raw).select("doc_id", "url", "texto", "estado")


@query(
    "ordered_text",
    """SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS texto
    FROM conversations GROUP BY conv_id""",
)
def turns_joined(spark, folder):
    return ordered_text(
        table(spark, folder, "conversations"), "conv_id", "turn", "text", "\n\n", run=4
    )
