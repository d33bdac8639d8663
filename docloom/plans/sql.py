"""SQL fragments the checking queries share.

RE2 has no lookbehind, so splits mark the gap with a control character that the
texts do not hold.
"""

from docloom import fixed_values as V

WS = V.WS
CUT = "chr(1)"


def strip(x: str) -> str:
    return f"trim({x}, '{V.BLANKS}')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"len({words(x)})"


def light_clean(x: str) -> str:
    lf = f"regexp_replace(coalesce({x}, ''), '\\r\\n?', chr(10), 'g')"
    spaces = f"regexp_replace({lf}, '[ \\t]+', ' ', 'g')"
    return strip(f"regexp_replace({spaces}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def split_sentences(x: str, marks: str = r"[.!?…\n]", gap: str = WS + "+") -> str:
    marked = f"regexp_replace({x}, '({marks}){gap}', '\\1' || {CUT}, 'g')"
    parts = f"string_split({marked}, {CUT})"
    return f"list_filter(list_transform({parts}, lambda s: {strip('s')}), lambda s: s <> '')"


def packed(sents: str, weight: str, limit: int) -> str:
    """Piece number of every sentence; ``weight`` is an expression over ``s``."""
    weighed = f"list_transform({sents}, lambda s: {{'z': ({weight})::BIGINT, 'c': [0::BIGINT]}})"
    full = f"a.z + x.z > {limit}"
    return (
        f"list_reduce({weighed}, lambda a, x: {{"
        f"'z': CASE WHEN {full} THEN x.z ELSE a.z + x.z END, "
        f"'c': list_append(a.c, a.c[-1] + CASE WHEN {full} THEN 1 ELSE 0 END)}}).c"
    )


# Sentences of every document, and the chunks they are packed into.
CHUNKS = f"""
t AS (SELECT doc_id, lang, source, {light_clean('text')} AS txt FROM documents),
sl AS (SELECT doc_id, lang, source, {split_sentences('txt')} AS ss FROM t),
pk AS (SELECT *, {packed('ss', 'length(s)', V.CHUNK_CHARS)} AS cs FROM sl WHERE len(ss) > 0),
se AS (SELECT doc_id, lang, source, unnest(ss) AS s, unnest(cs) AS posicion,
              unnest(range(len(ss))) AS i FROM pk),
ck AS (SELECT doc_id::VARCHAR || '_chunk_' ||
              CASE WHEN posicion < 100000 THEN lpad(posicion::VARCHAR, 5, '0')
                   ELSE posicion::VARCHAR END AS chunk_id,
              doc_id::VARCHAR AS doc_id, lang, source, posicion,
              {strip("string_agg(s, ' ' ORDER BY i)")} AS texto
       FROM se GROUP BY doc_id, lang, source, posicion),
chunks AS (SELECT *, {n_words('texto')} AS num_tokens, length(texto) AS n_caracteres_chunk,
                  max(posicion) OVER (PARTITION BY doc_id) = posicion AS last FROM ck)
"""

# Fragments of every row of a relation ``src(key..., txt)``.
def fragments(src: str, keys: str) -> str:
    return f"""
fl AS (SELECT {keys}, txt, {split_sentences('txt')} AS ss FROM {src}),
fp AS (SELECT *, {packed('ss', n_words('s'), V.FRAGMENT_WORDS)} AS cs FROM fl WHERE len(ss) > 0),
fe AS (SELECT {keys}, unnest(ss) AS s, unnest(cs) AS frag_pos, unnest(range(len(ss))) AS i FROM fp),
fr AS (SELECT {keys}, frag_pos, string_agg(s, ' ' ORDER BY i) AS text FROM fe
       GROUP BY {keys}, frag_pos
       UNION ALL SELECT {keys}, 0, txt FROM fl WHERE len(ss) = 0)
"""
