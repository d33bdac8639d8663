"""Column expressions for cleaning and measuring text.

All take and return Columns, stay inside the JVM and never shuffle.  Blank means
the Unicode white space of ``fixed_values.BLANKS`` throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions.arrays import StrCol, col, let
from docloom.functions.nfc import to_nfc


def strip(c: StrCol) -> Column:
    return F.trim(col(c), F.lit(V.BLANKS))


def is_blank(c: StrCol) -> Column:
    return strip(c) == ""


def words(c: StrCol) -> Column:
    """Array of blank-separated words."""
    return F.filter(F.split(col(c), f"{V.WS}+"), lambda w: w != "")


def word_count(c: StrCol) -> Column:
    s = strip(c)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, f"{V.WS}+"))).cast("bigint")


def stripped_word_count(c: StrCol) -> Column:
    """Word count of text already known to be stripped and non-blank."""
    return F.size(F.split(col(c), f"{V.WS}+"))


def char_count(c: StrCol) -> Column:
    return F.length(col(c)).cast("bigint")


def sha1_hex(c: StrCol) -> Column:
    return F.when(col(c) != "", F.sha1(col(c).cast("binary")))


# -- cleaning ---------------------------------------------------------------


def _line_feeds(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def _single_spaces(c: Column) -> Column:
    # A lone space already is what it would become, so only longer runs and tabs match.
    return F.regexp_replace(c, r"[ \t]{2,}|\t", " ")


def _two_line_feeds(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def clean_document(c: StrCol, nfc: bool = True) -> Column:
    """Full cleaning of extracted text; NULL becomes ''.

    ``nfc=False`` leaves out the only step that needs a Python worker, for text
    that is known to be NFC.
    """
    t = F.coalesce(col(c), F.lit(""))
    if nfc:
        t = to_nfc(t)
    t = F.regexp_replace(t, V.DELETED, "")
    t = F.regexp_replace(t, V.ODD_SPACES, " ")
    t = _line_feeds(t)
    t = F.regexp_replace(t, V.LEADER_DOTS, " ")
    t = _single_spaces(t)
    t = F.replace(t, F.lit(" \n"), F.lit("\n"))
    return strip(_two_line_feeds(t))


def clean_text(c: StrCol) -> Column:
    """Light cleaning before segmentation; NULL becomes ''.

    Most texts hold nothing that a pattern changes; finding that out costs a fraction of matching.
    """

    def cleaned(t: Column) -> Column:
        odd = t.contains("\r") | t.contains("\t") | t.contains("  ") | t.contains("\n\n\n")
        return strip(F.when(odd, _two_line_feeds(_single_spaces(_line_feeds(t)))).otherwise(t))

    return let(F.coalesce(col(c), F.lit("")), cleaned)


def line_signature(c: StrCol) -> Column:
    """What two repeats of a header line share: case, digits and spacing removed."""
    s = F.regexp_replace(F.lower(strip(c)), r"\p{Nd}+", "#")
    return F.regexp_replace(s, f"{V.WS}+", " ")


def is_page_number(c: StrCol) -> Column:
    return col(c).rlike(V.BARE_NUMBER_LINE) | col(c).rlike(V.PAGE_LABEL_LINE)


def join_hyphen_breaks(c: StrCol) -> Column:
    return F.regexp_replace(col(c), V.HYPHEN_BREAK, "$1$2")


def rebuild_paragraphs(c: StrCol) -> Column:
    """Physical lines to paragraphs: blank lines separate, other breaks are spaces."""
    blocks = F.split(join_hyphen_breaks(c), rf"\n{V.WS}*\n")
    joined = F.transform(
        blocks,
        lambda b: F.array_join(
            F.filter(F.transform(F.split(b, "\n"), strip), lambda x: x != ""), " "
        ),
    )
    return F.array_join(F.filter(joined, lambda b: b != ""), "\n\n")


# -- web text dumps -----------------------------------------------------------


def scraper_url(c: StrCol) -> Column:
    return F.nullif(F.regexp_extract(col(c), V.SCRAPER_HEADER, 1), F.lit(""))


def scraper_date(c: StrCol) -> Column:
    return F.nullif(F.regexp_extract(col(c), V.SCRAPER_HEADER, 2), F.lit(""))


def drop_scraper_header(c: StrCol) -> Column:
    return F.regexp_replace(col(c), V.SCRAPER_HEADER, "")


def drop_repeated_menu_lines(lines: StrCol) -> Column:
    """Array of lines without short lines that repeat the line right before them.

    A dropped line equals its predecessor, so comparing with the raw predecessor
    is the same as comparing with the last kept one.
    """
    lines = col(lines)

    def keep(line: Column, i: Column) -> Column:
        s = strip(line)
        repeat = (i > 0) & (s == strip(F.get(lines, i - 1)))
        return ~((s != "") & (F.length(s) < V.MENU_LINE_CHARS) & F.coalesce(repeat, F.lit(False)))

    return F.filter(lines, keep)


def is_prose(line: StrCol) -> Column:
    s = strip(line)
    return s.rlike(V.PROSE_ENDINGS) & (word_count(line) >= V.PROSE_WORDS)


def first_prose(lines: StrCol) -> Column:
    """Index of the first prose line, -1 when there is none."""
    flags = F.transform(col(lines), is_prose)
    return F.array_position(flags, True).cast("int") - 1


def preamble_size(lines: StrCol) -> Column:
    """Number of leading lines to drop: 0, or the index of the first prose line."""
    lines = col(lines)
    first = first_prose(lines)
    head = F.filter(F.slice(lines, F.lit(1), F.greatest(first, F.lit(0))), lambda x: ~is_blank(x))
    short = F.size(F.filter(head, lambda x: word_count(x) < V.SHORT_LINE_WORDS))
    menu = (F.size(head) > 0) & (short * 10 >= F.size(head) * V.PREAMBLE_TENTHS)
    return F.when((first > 0) & menu, first).otherwise(F.lit(0))


# -- document fields ----------------------------------------------------------


def extension(path: StrCol) -> Column:
    """Lower-case last suffix without its dot; '' for none and for dot files."""
    name = F.regexp_extract(col(path), r"([^/]*)/*\z", 1)
    return F.lower(F.regexp_extract(name, r"(?s)\A.+\.([^.]+)\z", 1))


def phenomenon(code: StrCol) -> Column:
    out = F.lit(None).cast("bigint")
    for name, number in V.PHENOMENON.items():
        out = F.when(strip(code) == name, F.lit(number).cast("bigint")).otherwise(out)
    return out


def chunk_id(doc_id: StrCol, position: StrCol) -> Column:
    """Position zero-padded to five digits; longer numbers are kept whole."""
    p = col(position).cast("string")
    padded = F.when(F.length(p) < 5, F.lpad(p, 5, "0")).otherwise(p)
    return F.concat(col(doc_id).cast("string"), F.lit("_chunk_"), padded)


def first_words(c: StrCol, n: int = V.ENCODE_WORDS) -> Column:
    """The first ``n`` words joined by spaces, only where the text has more."""

    def cut(w: Column) -> Column:
        return F.when(F.size(w) > n, F.array_join(F.slice(w, 1, n), " ")).otherwise(col(c))

    # The split stops after n words, the rest is one last piece.
    return let(F.split(strip(c), f"{V.WS}+", n + 1), cut)


def document_title(c: StrCol) -> Column:
    """A usable embedded title: 4 to 299 characters and not a file name."""
    t = strip(c)
    return F.when((F.length(t) > 3) & (F.length(t) < 300) & ~t.rlike(V.FILE_NAME_TITLE), t)


def error_detail(c: StrCol) -> Column:
    return F.substring(col(c), 1, V.DETAIL_CHARS)


def preview(c: StrCol) -> Column:
    return F.translate(F.substring(col(c), 1, V.PREVIEW_CHARS), "\n", " ")


def detail(explicit: StrCol, method: StrCol) -> Column:
    """Explicit detail first, else the method when it is not the default one."""
    e, m = F.nullif(col(explicit), F.lit("")), F.nullif(col(method), F.lit(""))
    return F.coalesce(e, F.when(m != "pdfplumber", F.concat(F.lit("metodo="), m)))


def status(state: StrCol, cleaned: StrCol) -> Column:
    return F.when((col(state) == "ok") & (col(cleaned) == ""), F.lit("vacio")).otherwise(col(state))


def needs_ocr(chars: StrCol, pages: StrCol) -> Column:
    average = col(chars) / F.greatest(col(pages), F.lit(1))
    return (col(pages) > 0) & (average < V.MIN_CHARS_PER_PAGE)


def ocr_accepted(ocr_text: StrCol, pages: StrCol) -> Column:
    least = F.greatest(F.lit(V.OCR_MIN_CHARS), col(pages) * V.OCR_CHARS_PER_PAGE)
    return F.length(strip(ocr_text)) >= least


def ends_sentence(c: StrCol) -> Column:
    """Whether one of the last five characters closes a sentence or quotation."""
    return F.right(col(c), F.lit(5)).rlike(V.CLOSING)


def mentions_any(c: StrCol, keywords: StrCol) -> Column:
    text = F.lower(col(c))
    return F.exists(col(keywords), lambda k: F.contains(text, F.lower(k)))


# -- rows to text ---------------------------------------------------------------


def pair(name: StrCol, value: StrCol, null_words: tuple[str, ...] = V.NULL_WORDS) -> Column:
    """``name: value``, NULL for values that carry nothing."""
    v = strip(value)
    useful = (v != "") & ~F.lower(v).isin(*null_words)
    return F.when(useful, F.concat(col(name), F.lit(": "), v))


def row_text(columns: list[str]) -> Column:
    """One table row as ``column: value | column: value``; '' when nothing is left."""
    named = [c for c in columns if not c.startswith(V.UNNAMED_COLUMN)]
    return F.concat_ws(
        " | ", *[pair(F.lit(c), F.col(f"`{c}`").cast("string")) for c in named]
    )
