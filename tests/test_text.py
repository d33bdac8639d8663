"""Cleaning and measuring against exact cases and an independent Python statement."""

import hashlib
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import text as X

INVISIBLE = "­​‌‍‎‏  ﻿‪‫‬‭‮"
ODD = "    　" + "".join(map(chr, range(0x2000, 0x200B)))


def expected_clean(t):
    t = unicodedata.normalize("NFC", t or "")
    t = "".join(c for c in t if c not in INVISIBLE)
    t = "".join(" " if c in ODD else c for c in t)
    t = "".join(c for c in t if c in "\t\n\r" or not (ord(c) < 32 or ord(c) == 127))
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    t = re.sub(r"(\.\s?){4,}", " ", t)
    t = re.sub(r"[ \t]+", " ", t)
    t = t.replace(" \n", "\n")
    return re.sub(r"\n{3,}", "\n\n", t).strip()


ALPHABET = list(
    "ab.éé \t\r\n\x00\x07\x0b\x1c\x1f\x7f\x85" + INVISIBLE + ODD
    + "̈́क़각가Å\U0001f600̣̇"
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=40), min_size=300, max_size=400))
def test_clean_document_property(apply, texts):
    assert apply(X.clean_document, texts) == [expected_clean(t) for t in texts]


@pytest.mark.parametrize(
    "given_text, wanted",
    [
        ("Line1\r\nLine2\rLine3\nLine4", "Line1\nLine2\nLine3\nLine4"),
        ("Word1  \t  Word2   Word3", "Word1 Word2 Word3"),
        ("Para1\n\n\n\nPara2\n\n\n\n\nPara3", "Para1\n\nPara2\n\nPara3"),
        ("  \n  Content  \n  ", "Content"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_text_cases(apply, given_text, wanted):
    assert apply(X.clean_text, [given_text]) == [wanted]


def test_cleaning_order_matters(apply):
    # A control character between letter and accent keeps them apart on the first pass only.
    assert apply(X.clean_document, ["e\x07́"]) == ["é"]
    assert apply(X.clean_document, ["a . .\n. . 14", "a...b", None]) == ["a 14", "a...b", ""]


def test_long_leader_dots_do_not_overflow(spark):
    row = spark.range(1).select(X.clean_document(F.expr("repeat('. ', 200000)")).alias("t")).first()
    assert row.t == ""


def test_only_touchable_text_reaches_python(apply):
    from docloom.functions.nfc import touchable_class

    texts = ["plain", "café ’quoted’ 中文 да", "é", "Å", "가"]
    assert apply(lambda c: F.col(c).rlike(touchable_class()), texts) == [False, False, True, True, True]
    # Every character that is not stable alone is recognised.
    moved = [chr(c) for c in range(0x300, 0x30000) if unicodedata.normalize("NFC", chr(c)) != chr(c)]
    assert all(apply(lambda c: F.col(c).rlike(touchable_class()), moved))


def test_words_and_characters(apply):
    texts = ["", "  ", "a", " a b\x85c　d ", "\U0001f600a。b！c"]
    assert apply(X.word_count, texts) == [len(t.split()) for t in texts]
    assert apply(X.char_count, texts) == [len(t) for t in texts]
    assert apply(X.sha1_hex, texts) == [hashlib.sha1(t.encode()).hexdigest() if t else None for t in texts]


def test_page_number_lines(apply):
    yes = ["3", " - 12 - ", "|1234|", "Página 3 de 10", "page 4", "PAG. 5 / 6", "pág.7", "page 4 of"]
    no = ["12345", "", "chapter 3", "page", "3.1", "page x", "- -"]
    assert apply(X.is_page_number, yes + no) == [True] * len(yes) + [False] * len(no)


def test_signature_and_hyphens(apply):
    assert apply(X.line_signature, ["  Página  12\tde 300 "]) == ["página # de #"]
    pages = ["innova-\nción es\nuna\n \t\nFranco-\nAlemana\n\n\n", "x"]
    assert apply(X.rebuild_paragraphs, pages) == ["innovación es una\n\nFranco- Alemana", "x"]


def test_menu_lines(apply):
    long = "x" * 60
    lines = ["Home", "Home", " Home ", "", "", long, long, "y" * 59, "y" * 59]
    assert apply(X.drop_repeated_menu_lines, [lines], "array<string>") == [
        ["Home", "", "", long, long, "y" * 59]
    ]


def test_preamble(apply):
    prose = "one two three four five six seven eight nine ten eleven twelve."
    eight = "a b c d e f g h"
    cases = [
        [prose, "x"], ["a", "b", prose], ["a", prose.rstrip(".")], ["", prose],
        ["a", "b", "c", "d", eight, prose], ["a", "b", "c", eight, prose],
    ]
    assert apply(X.first_prose, cases, "array<string>") == [0, 2, -1, 1, 5, 4]
    assert apply(X.preamble_size, cases, "array<string>") == [0, 2, 0, 0, 5, 0]


def test_scraper_header(apply):
    raw = ["\n source: http://a/b \nScraped: 2024-01-01\n====\n\nBody", "Body SOURCE: x"]
    assert apply(X.scraper_url, raw) == ["http://a/b", None]
    assert apply(X.scraper_date, raw) == ["2024-01-01", None]
    assert apply(X.drop_scraper_header, raw) == ["Body", raw[1]]


def test_fields(apply):
    paths = ["a/b.PDF", "a.b/c", "x.tar.GZ", ".hidden", "a/"]
    assert apply(X.extension, paths) == ["pdf", "", "gz", "", ""]
    assert apply(X.phenomenon, [" F1", "F3", "F4", None]) == [1, 3, None, None]
    assert apply(X.document_title, ["abc", " Title ", "My file.PDF", "a.docx", "x" * 300]) == [
        None, "Title", None, None, None]
    many = " ".join(map(str, range(401)))
    few = "  keep \n as  is "
    assert apply(X.first_words, [many, few]) == [" ".join(map(str, range(400))), few]
    assert apply(X.preview, ["a\nb" + "c" * 300]) == ["a b" + "c" * 197]


def test_chunk_ids(apply):
    assert apply(lambda c: X.chunk_id(F.lit("d"), c), [0, 99999, 123456], "int") == [
        "d_chunk_00000", "d_chunk_99999", "d_chunk_123456"]


def test_row_text(spark):
    rows = spark.createDataFrame(
        [(1, " a ", "NaN", "x"), (2, None, " ", "None"), (3, "nat", "1.0", None)],
        "`Unnamed: 0` int, name string, `n.x` string, z string",
    )
    got = [r.t for r in rows.select(X.row_text(rows.columns).alias("t")).collect()]
    assert got == ["name: a | z: x", "", "n.x: 1.0"]


def test_ocr_rules(spark):
    rows = spark.createDataFrame([(99, 1), (100, 1), (0, 0), (199, 2)], "c int, p int")
    assert [r.o for r in rows.select(X.needs_ocr("c", "p").alias("o")).collect()] == [
        True, False, False, True]


def test_sentence_endings(apply):
    assert apply(X.ends_sentence, ["done.", "no end", '«said."', "終。"]) == [
        True, False, True, True]
