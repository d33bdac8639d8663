"""Segmentation, packing and chunk tables."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import pack, segment
from docloom.functions import text as X
from docloom.operators import chunks as C
from docloom.plans import build_index as B

TEXTS = {
    "en": ["The river is calm.", "Boats pass at noon.", "Nobody waits.", "Night comes."],
    "es": ["El río está en calma.", "Los barcos pasan.", "¿Quién espera?", "Llega la noche."],
    "pt": ["O rio está calmo.", "Os barcos passam.", "Ninguém espera.", "A noite chega."],
    "fr": ["La rivière est calme.", "Les bateaux passent.", "Personne n'attend.", "La nuit vient."],
    "ru": ["Река спокойна.", "Лодки проходят.", "Никто не ждёт.", "Приходит ночь."],
    "ar": ["النهر هادئ.", "تمر القوارب.", "لا أحد ينتظر.", "يأتي الليل."],
    "ko": ["강은 고요하다.", "배가 지나간다.", "아무도 없다.", "밤이 온다."],
    "ms": ["Sungai tenang.", "Bot lalu.", "Tiada siapa.", "Malam tiba."],
    "qu": ["Mayu thak kachkan.", "Wampukuna rin.", "Mana pipas.", "Tuta chayamun."],
    "zh": ["河水很平静。", "船在中午经过。", "没有人等待！", "夜晚来临。"],
}


@pytest.fixture(scope="module")
def split(spark):
    rows = []
    for lang, parts in TEXTS.items():
        sep = "" if lang == "zh" else " "
        rows += [(lang, n, sep.join(parts[:n])) for n in (1, 3, 4)]
    df = spark.createDataFrame(rows, "lang string, n int, t string")
    got = df.select("lang", "n", segment.by_language("t", "lang").alias("s")).collect()
    return {(r.lang, r.n): r.s for r in got}


@pytest.mark.parametrize("lang", TEXTS)
def test_sentence_counts(split, lang):
    assert [split[lang, n] for n in (1, 3, 4)] == [TEXTS[lang][:n] for n in (1, 3, 4)]


def test_routes(spark):
    text = "One. Two。Three."
    langs = ["en", "pt", "zh", "zh-cn", "ca", None, "desconocido"]
    df = spark.createDataFrame([(i, g, text) for i, g in enumerate(langs)], "i int, g string, t string")
    strict = [r.s for r in df.orderBy("i").select(segment.by_strict_routing("t", "g").alias("s")).collect()]
    cut, cjk, whole = ["One.", "Two。Three."], ["One. Two。", "Three."], [text]
    assert strict == [cut, cut, cjk, whole, whole, whole, cut]
    usual = [r.s for r in df.orderBy("i").select(segment.by_language("t", "g").alias("s")).collect()]
    assert usual == [cut, cut, cjk, cjk, cut, cut, cut]


def test_blank_texts_have_no_sentence(apply):
    for fn in (segment.punctuation_sentences, segment.cjk_sentences, segment.whole_text):
        assert apply(fn, ["", "   \n  \t  "]) == [[], []]


def greedy(weights, limit):
    out, size = [], 0
    for w in weights:
        if out and size + w <= limit:
            out[-1].append(w)
            size += w
        else:
            out.append([w])
            size = w
    return out


def packed(spark, lists, limit):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lists)], "i int, s array<string>")
    rows = df.select("i", pack.pack("s", F.length, limit).alias("p")).orderBy("i").collect()
    return [[[len(s) for s in p.split(" ")] for p in r.p] for r in rows]


def test_pack_limits(spark):
    cases = [[2000, 2000], [2000, 2001], [5000, 10], [10, 5000, 10], [10, 5000], [1] * 4001, []]
    got = packed(spark, [["x" * n for n in c] for c in cases], 4000)
    assert got == [greedy(c, 4000) for c in cases]
    assert [len(g) for g in got] == [1, 2, 2, 3, 2, 2, 0]


def test_pack_over_block_borders(spark):
    rnd = random.Random(1)
    cases = [[rnd.randint(1, 60) for _ in range(n)] for n in (511, 512, 513, 1024, 1500, 3000)]
    assert packed(spark, [["x" * n for n in c] for c in cases], 100) == [greedy(c, 100) for c in cases]


def test_fragments(spark):
    df = spark.createDataFrame(
        [("a", "One two. " * 200), ("b", "  "), ("c", "w " * 300)], "id string, texto string"
    )
    rows = C.fragment_chunks(df).orderBy("id", "frag_pos").collect()
    assert [(r.id, r.frag_pos, len(r.text.split())) for r in rows] == [
        ("a", 0, 250), ("a", 1, 150), ("b", 0, 0), ("c", 0, 300)]
    assert rows[2].text == "  "


def test_chunk_table(spark):
    long = " ".join(f"Sentence number {i} ends here." for i in range(400))
    docs = spark.createDataFrame(
        [("d1", "Short text. Two.", "en", 1, "ok"), ("d2", long, "es", None, "ok"), ("d3", " \n ", "en", 2, "ok"),
         ("d4", None, "en", 2, "ok"), ("d5", "Bad.", "en", 2, "error"), ("d6", "Null state.", "en", 2, None)],
        "doc_id string, texto string, idioma string, fenomeno bigint, estado string",
    )
    rows = C.chunk_documents(C.valid_documents(docs)).orderBy("chunk_id").collect()
    assert [r.doc_id for r in rows] == ["d1"] + ["d2"] * 3
    assert [r.posicion for r in rows[1:]] == [0, 1, 2]
    assert [r["last"] for r in rows] == [True, False, False, True]
    assert " ".join(r.texto for r in rows[1:]) == long
    assert rows[0].texto == "Short text. Two." and rows[0].num_tokens == 3
    assert rows[1].fenomeno is None and rows[1].chunk_id == "d2_chunk_00000"


def test_long_text_in_one_chunk(spark):
    text = "A sentence of some words. " * 150
    docs = spark.createDataFrame([("d", text)], "doc_id string, texto string")
    assert C.chunk_documents(docs).count() == 1


def test_tokens(apply):
    assert apply(X.word_count, ["", "a", "a b"]) == [0, 1, 2]


def test_metadata_records(spark):
    ddl = ("doc_id string, chunk_id string, fuente string, formato string, fenomeno string, posicion string, "
           "num_tokens string, texto string, idioma string, n_caracteres_chunk int")
    df = spark.createDataFrame([("d", "c", "f", "pdf", "1", "0", "120", "t", "es", 5)], ddl)
    row = C.metadata_records(df).first().asDict()
    assert row == dict(doc_id="d", chunk_id="c", fuente="f", formato="pdf", fenomeno=1, posicion=0,
                       num_tokens=120, texto="t", idioma="es")
    with pytest.raises(Exception, match="texto"):
        C.metadata_records(df.drop("texto"))


def test_blank_source_fails(spark):
    df = spark.createDataFrame([("c1", "f"), ("c2", " ")], "chunk_id string, fuente string")
    with pytest.raises(ValueError, match="1 chunks with an empty fuente, c2"):
        C.assert_sources(df)
    C.assert_sources(df.filter("chunk_id = 'c1'"))


def test_failing_documents_give_error_rows(spark, tmp_path):
    """One failing document: an error row, the others are chunked, and the next run tries it again."""

    def cut(text, language):
        if "bad" in text:
            raise ValueError(f"no cut for {language}")
        return [s for s in text.split(". ") if s]

    docs = spark.createDataFrame(
        [("a", "One. Two", "en"), ("b", "a bad one", "fr"), ("c", "  ", "en"), ("d", "Three", None), ("e", "bad", None)],
        "doc_id string, texto string, idioma string",
    ).withColumns({"estado": F.lit("ok"), "fuente": F.lit("f")})
    picky = segment.Guarded(cut)
    rows = C.chunk_documents(docs, picky, errors=True).select("doc_id", "texto", "error").collect()
    assert sorted((r.doc_id, r.texto or "", r.error or "") for r in rows) == [
        ("a", "One Two", ""), ("b", "", "no cut for fr"), ("d", "Three", ""), ("e", "", "no cut for None")]
    assert {r.doc_id for r in C.chunk_documents(docs, picky).collect()} == {"a", "d"}
    plain = C.chunk_documents(docs, errors=True)
    assert plain.where("error is not null").count() == 0 and plain.count() == 4
    source, out = f"{tmp_path}/docs", f"{tmp_path}/out"
    docs.write.parquet(source)
    B.build_chunks(spark, source, out, segmenter=picky, batches=2)
    B.build_chunks(spark, source, out, segmenter=picky)
    assert {r.doc_id: r.error for r in B.read_chunk_errors(spark, out).collect()} == {"b": "no cut for fr", "e": "no cut for None"}
    assert sorted(r.doc_id for r in B.read_chunks(spark, out).collect()) == ["a", "d"]
    assert [r.doc_id for r in spark.read.parquet(f"{out}/empty").collect()] == ["c"]
    # A segmenter that succeeds takes them out of the list.
    B.build_chunks(spark, source, out)
    assert B.read_chunk_errors(spark, out).count() == 0 and B.read_chunks(spark, out).count() == 4


def test_a_segmenter_that_breaks_its_batch(spark, tmp_path):
    """An expression cannot be guarded: the batch is halved until the document is alone."""
    docs = spark.createDataFrame([(f"d{i}", "bad" if i == 3 else f"Text {i}.", "en") for i in range(8)],
                                 "doc_id string, texto string, idioma string").withColumns({"estado": F.lit("ok"), "fuente": F.lit("f")})
    source, out = f"{tmp_path}/docs", f"{tmp_path}/out"
    docs.write.parquet(source)

    def refuses(text, language):
        return F.when(text == "bad", F.raise_error(F.lit("cannot cut"))).otherwise(F.array(text))

    B.build_chunks(spark, source, out, segmenter=refuses)
    assert B.read_chunks(spark, out).count() == 7
    errors = B.read_chunk_errors(spark, out).collect()
    assert [r.doc_id for r in errors] == ["d3"] and "cannot cut" in errors[0].error
    assert spark.read.parquet(f"{out}/empty").count() == 0


def test_a_guarded_segmenter_gets_few_texts_at_a_time(spark):
    rows = spark.range(3).select(F.lit("One.").alias("texto"), F.lit("en").alias("idioma"))
    plan = rows.select(segment.Guarded(lambda text, language: (text,)).checked("texto", "idioma")["oraciones"].alias("o"))
    # An Arrow batch has ten thousand rows; the other way sends a hundred.
    assert "BatchEvalPython" in plan._jdf.queryExecution().executedPlan().toString()
    assert [r.o for r in plan.collect()] == [["One."]] * 3
