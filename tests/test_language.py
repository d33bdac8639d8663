"""Language identification: guards, and trigram profiles learned from labelled texts."""

from docloom import fixed_values as V
from docloom.functions import language as L

WORDS = {"en": "the house and the river with these other things ", "es": "la casa y el río con estas otras cosas "}


def test_sample_guard(apply):
    texts = ["x" * 29, " " + "x" * 30 + " ", "x" * 6000, None]
    assert apply(L.sample, texts) == [None, "x" * 30, "x" * 5000, None]


def test_without_a_detector_everything_is_unknown(apply):
    assert apply(lambda c: L.unknown_language(c), ["a text of more than thirty characters"]) == [V.UNKNOWN]


def test_profiles(spark, apply):
    rows = [(lang, text * 20) for lang, text in WORDS.items()]
    labelled = spark.createDataFrame(rows, "idioma string, texto string")
    profiles = L.trigram_profiles(labelled)
    count = {(r.idioma, r.gram): r.n for r in profiles.collect()}
    assert count["en", "the"] == WORDS["en"].count("the") * 20
    detect = L.trigram_detector(profiles)
    texts = ["the river and these things of the house", "el río y las otras cosas de la casa", "short", None]
    assert apply(lambda c: detect(__import__("pyspark").sql.functions.col(c)), texts) == [
        "en", "es", V.UNKNOWN, V.UNKNOWN]


def test_short_texts_have_one_gram(spark):
    df = spark.createDataFrame([("en", "ab"), ("en", "abcd")], "idioma string, texto string")
    assert {r.gram: r.n for r in L.trigram_profiles(df).collect()} == {"ab": 1, "abc": 1, "bcd": 1}


def test_scores_are_those_of_single_lookups(spark, apply):
    import math
    from collections import Counter

    rows = [(lang, text * k) for lang, text in WORDS.items() for k in (3, 5)] + [(None, "nothing to learn from here")]
    detect = L.trigram_detector(L.trigram_profiles(spark.createDataFrame(rows, "idioma string, texto string")))
    counts = {}
    for lang, text in rows[:-1]:
        counts.setdefault(lang, Counter()).update(text[i : i + 3] for i in range(len(text) - 2))
    texts = ["zzzz qqqq the casa y el the things " * 2, "la la la la la la la house with ríos", WORDS["es"] + WORDS["en"]]
    want = []
    for text in texts:
        text = text.strip()
        score = {
            lang: sum(math.log((c[text[i : i + 3]] + 1) / (c.total() + L.SMOOTHING)) for i in range(len(text) - 2))
            for lang, c in counts.items()
        }
        best = max(sorted(score), key=score.get)
        want.append(best if 1 / sum(math.exp(s - score[best]) for s in score.values()) >= V.LANGUAGE_MIN_PROB else V.UNKNOWN)
    assert apply(lambda c: detect(__import__("pyspark").sql.functions.col(c)), texts) == want


def test_rows_bound_a_profile(spark):
    rows = [("en", f"text number {i}") for i in range(50)]
    assert L.trigram_profiles(spark.createDataFrame(rows[:10], "idioma string, texto string"), rows=2).first().total == 2 * (len(rows[0][1]) - 2)


def test_the_rows_of_a_profile_are_the_first_by_hash_and_text(spark):
    from pyspark.sql import functions as F

    # Many copies of a few texts, so that the cut falls among equal ones; texts that are null count as rows.
    texts = [f"text {i % 7} and {i % 3}" for i in range(60)] + [None] * 5
    rows = [(lang, t) for lang in ("en", "es") for t in texts[: 65 if lang == "en" else 40]] + [(None, "unlabelled")]
    labelled = spark.createDataFrame(rows, "idioma string, texto string").withColumn("h", F.xxhash64("texto"))
    found = sorted((r.idioma, r.h, r.texto or "", r.texto is not None) for r in labelled.where("idioma is not null").collect())
    for n in (1, 13, 38, 1000):
        want = {}
        for lang in ("en", "es"):
            for _, _, t, there in [r for r in found if r[0] == lang][:n]:
                for i in range(len(t) - 2 if there else 0):
                    want[lang, t[i : i + 3]] = want.get((lang, t[i : i + 3]), 0) + 1
        assert {(r.idioma, r.gram): r.n for r in L.trigram_profiles(labelled, rows=n).collect()} == want


def test_no_task_meets_all_texts_of_a_language(spark):
    labelled = spark.range(10).selectExpr("'en' AS idioma", "string(id) AS texto")
    plan = L.trigram_profiles(labelled)._jdf.queryExecution().executedPlan().toString()
    # Windows by language see counts of hashes alone; texts are dealt out by their hash.
    windows = [x for x in plan.splitlines() if " Window [" in x]
    assert windows and all("_text" not in x or "_hash" in x.split("], [")[1] for x in windows)
    assert not any("row_number" in x for x in windows)


def test_profiles_count_all_labelled_rows(spark):
    # More rows than a profile once was learned from.
    labelled = spark.range(20_300).selectExpr("if(id < 20200, 'en', 'es') AS idioma", "string(id + 10000) AS texto")
    totals = {r.idioma: r.total for r in L.trigram_profiles(labelled).select("idioma", "total").distinct().collect()}
    assert totals == {"en": 3 * 20_200, "es": 3 * 100}


def test_the_query_learns_from_every_document(spark, tmp_path):
    import hashlib

    import duckdb

    from docloom.plans import catalogue

    ids = sorted(range(400), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    # By this order of ids one language stands in the second half alone.
    rows = [(i, WORDS["en"] * 2 if k < 300 else WORDS["es"] * 2, "en" if k < 300 else "es", "s") for k, i in enumerate(ids)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, catalogue.QUERIES["language_id"](spark, str(tmp_path)).collect()))
    assert got == sorted((i, lang) for i, _, lang, _ in rows)
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert got == sorted(con.sql(catalogue.SQL["language_id"]).fetchall())


def test_counts_of_texts_in_pieces_and_of_many_grams(monkeypatch):
    from collections import Counter

    import pyarrow as pa

    rows = [
        ("en", 1, "a long text, in many pieces, in many pieces"), ("es", 2, "otro texto \U0001f600\U0001f601\U0001f602 con ñ"),
        ("en", 1, "ab"), ("en", 1, "ab\0"), ("en", 1, ""), ("es", 1, None), ("en", 3, "in many pieces"),
    ]
    want = Counter()
    for lang, times, text in rows:
        for i in range(max(len(text) - 2, 1) if text is not None else 0):
            want[lang, text[i : i + 3]] += times
    batches = [pa.RecordBatch.from_pylist([dict(zip("abc", r, strict=True)) for r in rows[i : i + 3]]) for i in (0, 3, 6)]
    for chars, held in ((1 << 21, 1 << 20), (5, 1 << 20), (5, 7), (1, 1)):
        monkeypatch.setattr(L, "_CHARS_AT_ONCE", chars)
        monkeypatch.setattr(L, "_GRAMS_HELD", held)
        got = Counter()
        for b in L._count(iter(batches)):
            for r in b.to_pylist():
                got[r["idioma"], r["gram"]] += r["n"]
        assert got == want


def test_numbers_of_grams_are_alike_in_tables_and_texts(spark):
    grams = ["abc", "ñü€", "\U0001f600a\U0001f601", "ab", "", "ab\0", "\0\0\0", "語彙集"]
    df = spark.createDataFrame(list(enumerate(grams)), "i int, gram string").select("i", L._code("gram").alias("code"))
    codes = [r.code for r in df.sort("i").collect()]
    assert codes == [int(L._codes(g)[0]) for g in grams] and len(set(codes)) == len(grams)
    assert L._grams(__import__("numpy").array(codes, "uint64")) == grams


def test_without_a_labelled_text_everything_is_unknown(spark, apply):
    from pyspark.sql import functions as F

    labelled = spark.createDataFrame([(None, "a text without a label"), ("en", None)], "idioma string, texto string")
    detect = L.trigram_detector(L.trigram_profiles(labelled))
    assert apply(lambda c: detect(F.col(c)), ["a text of more than thirty characters", None]) == [V.UNKNOWN, V.UNKNOWN]
