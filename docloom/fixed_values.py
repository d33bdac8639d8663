"""Fixed values of the data model.

Every constant, pattern, word list and status below decides results and so must
stay exactly as it is; logic lives elsewhere.
"""

# --- white space ---------------------------------------------------------
# The characters that count as blank, as a Java character class body and as text.
BLANK_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = f"[{BLANK_CLASS}]"
NWS = f"[^{BLANK_CLASS}]"

# --- text cleaning -------------------------------------------------------
# Format marks (soft hyphen, zero width, bidi, BOM) and control characters: deleted.
DELETED = (
    r"[\x{ad}\x{200b}-\x{200f}\x{2028}\x{2029}\x{feff}\x{202a}-\x{202e}"
    r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
)
# Typographic spaces: become a plain space.
ODD_SPACES = r"[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
# Leader dots of a table of contents, four or more.
LEADER_DOTS = rf"(?:\.{WS}?+){{4,}}+"
HYPHEN_BREAK = r"([A-Za-zÁÉÍÓÚÑÜáéíóúñü])[-‐‑]\n([a-záéíóúñü])"

# --- page furniture ------------------------------------------------------
BARE_NUMBER_LINE = rf"\A{WS}*+[-–—|]*+{WS}*+\p{{Nd}}{{1,4}}+{WS}*+[-–—|]*+{WS}*+\z"
PAGE_LABEL_LINE = (
    rf"(?iu)\A{WS}*+(?:p[aá]g(?:ina)?\.?|page|pag\.){WS}*+\p{{Nd}}++{WS}*+"
    rf"(?:de|of|/)?+{WS}*+\p{{Nd}}*+{WS}*+\z"
)
MARGIN_LINES = 3
MIN_PAGES = 4
MIN_REPEATS = 3
REPEAT_RATIO = 0.5
MAX_SIGNATURE = 120

# --- scanned pages -------------------------------------------------------
MIN_CHARS_PER_PAGE = 100
OCR_MIN_CHARS = 50
OCR_CHARS_PER_PAGE = 10
OCR_MIN_WORDS = 10
PENDING_STATES = {"image": "pendiente_ocr"}
NO_DECODER_DETAIL = "sin lector registrado"
LATIN_DETAIL = "texto no UTF-8, leido como Latin-1"
OCR_DETAIL = "OCR aplicado por baja cantidad de texto extraible"
OCR_POOR_DETAIL = "OCR no produjo texto suficiente"

# --- web text dumps ------------------------------------------------------
SCRAPER_HEADER = (
    rf"(?iu)\A{WS}*SOURCE:{WS}*({NWS}+){WS}*\n{WS}*SCRAPED:{WS}*({NWS}+){WS}*\n=+{WS}*\n"
)
MENU_LINE_CHARS = 60
PROSE_WORDS = 12
PROSE_ENDINGS = r"[.!?:;]\z"
SHORT_LINE_WORDS = 8
PREAMBLE_TENTHS = 8

# --- documents -----------------------------------------------------------
FILE_NAME_TITLE = r"(?iuU)\A[\w\-. ]+\.(indd|pdf|docx?|qxd)\z"
DETAIL_CHARS = 300
PREVIEW_CHARS = 200
PHENOMENON = {"F1": 1, "F2": 2, "F3": 3}
UNNAMED_COLUMN = "Unnamed:"
NULL_WORDS = ("nan", "nat", "none")
TILE_NULL_WORDS = ("nan", "none")
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "avif", "webp", "gif", "tif", "tiff")
OUT_OF_MEMORY = ("MemoryError", "Unable to allocate")
LOST_DETAIL = "no se pudo procesar en ninguna pasada"

# --- language ------------------------------------------------------------
UNKNOWN = "desconocido"
LANGUAGE_SAMPLE = 5000
LANGUAGE_MIN_CHARS = 30
LANGUAGE_MIN_PROB = 0.60

# --- sentences -----------------------------------------------------------
SENTENCE_GAP = rf"(?<=[.!?…\n]){WS}+"
CJK_SENTENCE_GAP = rf"(?<=[。！？\n]){WS}*"
# Languages with a rule based segmenter, and those cut at punctuation.
RULE_LANGUAGES = (
    "en", "es", "fr", "de", "it", "ru", "ar", "zh", "ja", "hi", "nl", "pl", "el", "da",
    "fa", "ur", "hy", "am", "bg", "kk", "mr", "my",
)
PUNCTUATION_LANGUAGES = (
    "pt", "ko", "ms", "qu", "an", "id", "wa", "lt", "af", "oc", "is", "desconocido",
)
CLOSING = r"[.!?…\n。！？」』）】)\]'\"]"

# --- chunks, fragments, encoding -----------------------------------------
CHUNK_CHARS = 4000
FRAGMENT_WORDS = 250
ENCODE_WORDS = 400
SHORT_TOKENS = 1500
BATCH_SHORT = 48
BATCH_LONG = 32
UNIT_TOLERANCE = 1e-3
POOL = 30
TOP_DOCUMENTS = 3
TOP_FRAGMENTS = 10

# --- tables --------------------------------------------------------------
DOCUMENT_COLUMNS = (
    "doc_id", "fuente", "ruta_relativa", "formato", "tipo_adl", "fenomeno",
    "observatorio", "codigo_observatorio", "titulo", "url", "fecha", "autores",
    "etiquetas", "idioma", "texto", "n_caracteres", "n_palabras", "n_paginas",
    "filas_totales", "truncado", "estado", "detalle", "subtipo_json",
    "bytes_archivo", "hash_sha1", "segundos",
)
LONG_COLUMNS = (
    "n_caracteres", "n_palabras", "n_paginas", "filas_totales", "bytes_archivo", "fenomeno",
)
METADATA_REQUIRED = (
    "doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto",
)
METADATA_EXTRA = ("observatorio", "idioma", "titulo", "url", "fecha")
INHERITED = ("observatorio", "fenomeno", "fuente", "formato", "idioma", "titulo", "url", "fecha")
