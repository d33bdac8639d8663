"""Vector checks, search against brute force, encoding and answers."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.functions import vectors as VX
from docloom.operators import encode, retrieve, search
from docloom.operators.row_ids import with_row_id
from docloom.plans import search_queries as S


def unit_rows(n, dim, seed=0):
    rows = np.random.default_rng(seed).normal(size=(n, dim))
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, rows, name="row_id"):
    return spark.createDataFrame(
        [(i, [float(x) for x in r]) for i, r in enumerate(rows)], f"{name} bigint, vector array<float>")


def brute(queries, rows, k):
    out = {}
    for q, v in enumerate(queries.astype(np.float64)):
        scores = np.round(rows.astype(np.float64) @ v, 10)
        out[q] = [int(i) for i in sorted(range(len(rows)), key=lambda i: (-scores[i], i))[:k]]
    return out


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.row_id)
    return out


def test_unit_norm(spark):
    ok = frame(spark, unit_rows(20, 8))
    bad = spark.createDataFrame([(0, [3.0, 4.0]), (1, [1.0, 0.0])], "row_id bigint, vector array<float>")
    nan = spark.createDataFrame([(0, [float("nan"), 0.0])], "row_id bigint, vector array<float>")
    assert VX.unit_norm_report(ok).first().asDict() == {"ok": True, "n": 20, "dims": 1}
    assert not VX.unit_norm_report(bad).first().ok and not VX.unit_norm_report(nan).first().ok
    assert VX.unit_norm_report(ok.limit(0)).first().ok
    with pytest.raises(Exception, match="unit norm"):
        VX.assert_unit(bad).collect()
    assert VX.assert_unit(ok).count() == 20


@pytest.mark.parametrize("limit", [1 << 26, 1])
def test_top_k_both_ways(spark, limit):
    rows = unit_rows(400, 16)
    rows[7] = rows[3]  # equal vectors tie, the smaller id first
    rows[399] = rows[3]
    queries = np.concatenate([unit_rows(5, 16, 1), rows[3:4]])
    got = search.top_k(frame(spark, queries, "query_id"), frame(spark, rows).repartition(6), 10,
                       max_query_bytes=limit)
    want = brute(queries, rows, 10)
    assert ranked(got) == want and want[5][:3] == [3, 7, 399]


def test_top_k_large_batches(spark, monkeypatch):
    monkeypatch.setattr(search, "_HELD_CANDIDATES", 50)
    monkeypatch.setattr(search, "_SCORES_AT_ONCE", 64)
    rows = np.repeat(unit_rows(40, 8), 3, axis=0)
    best = search._Best(3, 7)
    queries = unit_rows(3, 8, 2).astype(np.float64)
    for at in range(0, 120, 50):
        best.add(queries, np.arange(at, min(at + 50, 120)), rows[at : at + 50].astype(np.float64))
    q, ids, _ = best.rows()
    assert {i: [int(x) for x in ids[q == i]] for i in range(3)} == brute(queries, rows, 7)


def test_self_is_first_and_small_corpus(spark):
    rows = unit_rows(5, 8)
    df = frame(spark, rows)
    got = search.top_k(df.withColumnRenamed("row_id", "query_id"), df, 9).collect()
    assert len(got) == 25
    firsts = [r for r in got if r["rank"] == 1]
    assert all(r.row_id == r.query_id and abs(r.score - 1) < 1e-4 for r in firsts)


def test_dimension_mismatch_fails(spark):
    with pytest.raises(Exception, match="dimensions"):
        search.top_k(frame(spark, unit_rows(2, 4), "query_id"), frame(spark, unit_rows(3, 8)), 1).collect()


def test_string_row_ids(spark):
    rows = unit_rows(50, 8)
    df = frame(spark, rows).withColumn("row_id", F.format_string("c%03d", "row_id"))
    got = search.top_k(frame(spark, unit_rows(2, 8, 3), "query_id"), df, 4)
    want = brute(unit_rows(2, 8, 3), rows, 4)
    assert ranked(got) == {q: [f"c{i:03d}" for i in ids] for q, ids in want.items()}


def test_encoder(spark):
    df = spark.createDataFrame([(i, t, 1600 if i == 1 else 3) for i, t in enumerate(["a b a", "Z z", "", " ".join(f"w{i}" for i in range(500))])],
                               "row_id bigint, texto string, num_tokens bigint")
    rows = {r.row_id: np.array(r.vector) for r in
            encode.encode_texts(df, encode.HashingEncoder(32), ["row_id"], tokens="num_tokens").collect()}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 and len(v) == 32 for v in rows.values())
    cut = df.withColumn("texto", F.lit(" ".join(f"w{i}" for i in range(400))))
    again = encode.encode_texts(cut, encode.HashingEncoder(32), ["row_id"]).first().vector
    assert np.array_equal(again, rows[3]) and rows[2][0] == 1


def test_hashing_splits_and_hashes_like_plain_python():
    texts = ["a\x1cB\x85c\u3000\u2003d a", "\xa0 \u2003", "", "İx ΑΣ e\u0301\u200be", "".join(f"w{i}{chr(b)}" for i, b in enumerate(
        b for b in range(0x3001) if chr(b).isspace()))]
    wanted = np.zeros((len(texts), 16))
    for i, text in enumerate(texts):
        for word in text.lower().split():
            digest = hashlib.md5(word.encode()).hexdigest()
            wanted[i, int(digest[:8], 16) % 16] += 1 if digest[8] < "8" else -1
    assert np.array_equal(encode.HashingEncoder(16).encode(texts), wanted)
    assert np.array_equal(encode.HashingEncoder(16).encode(["", " "]), np.zeros((2, 16)))


def test_an_encoder_may_name_its_batch(spark):
    class Counting:
        encoder_id, dim = "counting", 2

        def encode(self, texts):
            return np.tile([1.0, len(texts)], (len(texts), 1))

    class AtOnce(Counting):
        batch = 1000

    df = spark.range(100).select("id", F.lit("a b").alias("texto"), F.when(F.col("id") < 50, 9).otherwise(1600).alias("n")).coalesce(1)

    def sizes(encoder):
        rows = encode.encode_texts(df, encoder, ["id"], tokens="n", spread=False).collect()
        return {round(r.vector[1] / r.vector[0]) for r in rows}

    assert sizes(AtOnce()) == {100} and sizes(Counting()) == {48, 2, 32, 18}


def test_texts_stay_where_they_are_without_spread(spark):
    df = spark.range(10).select("id", F.lit("a b").alias("texto"))
    plans = [encode.encode_texts(df, encode.HashingEncoder(8), ["id"], spread=s)._jdf.queryExecution().executedPlan().toString()
             for s in (True, False)]
    assert ["Exchange" in p for p in plans] == [True, False]


def test_answers_shuffle_no_texts(spark, tmp_path, monkeypatch):
    rows = [(i, f"word{i} river{i % 7}. Night boat.\t{'calm ' * (i % 5)}", "en", "s") for i in range(300)]
    rows[7:9] = [(7, None, "en", "s"), (8, " ", None, "s")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    asked = [(1, "word11 river4"), (2, "word250 night")]
    spark.createDataFrame(asked, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    cut, given, chunk, answer = [], [], S.C.chunk_documents, retrieve.answer

    def spied_chunk(documents, *rest, **options):
        cut.append(documents.count())
        return chunk(documents, *rest, **options)

    def spied_answer(queries, index, metadata, *rest):
        given.append(index)
        return answer(queries, index, metadata, *rest)

    monkeypatch.setattr(S.C, "chunk_documents", spied_chunk)
    monkeypatch.setattr(retrieve, "answer", spied_answer)
    found = S.answers(spark, str(tmp_path)).collect()
    # The index holds keys and vectors only; the documents of the pools alone are cut a second time.
    assert "texto" not in given[0]._jdf.queryExecution().analyzed().toString()
    assert cut[0] == 300 and len(cut) == 2 and 30 <= cut[1] <= 60
    first = {(r.query_id, r.kind): (r.doc_id, r.text) for r in found if r["rank"] == 1}
    assert first["1", "document"][0] == "11"
    assert first["1", "fragment"] == ("11", "word11 river4. Night boat. calm")
    assert len(found) == 2 * (3 + 10)


def test_encode_missing_follows_text_and_encoder(spark):
    enc = encode.HashingEncoder(16)
    chunks = spark.createDataFrame([("a", "one", 1), ("b", "two", 1)], "chunk_id string, texto string, num_tokens bigint")
    cache = encode.encode_missing(chunks, None, enc).cache()
    assert cache.count() == 2
    changed = spark.createDataFrame([("a", "one", 1), ("b", "new", 1), ("c", "x", 1)], chunks.schema)
    assert sorted(r.chunk_id for r in encode.missing(changed, cache, enc).collect()) == ["b", "c"]
    assert encode.missing(chunks, cache, encode.HashingEncoder(8)).count() == 2
    broken = cache.withColumn("vector", F.array(F.lit(float("nan")).cast("float")))
    assert encode.missing(chunks, broken, enc).count() == 2


def test_row_ids(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k")).repartition(7)
    rows = with_row_id(df, ["k"]).collect()
    assert sorted((r.k, r.row_id) for r in rows) == [(i, i) for i in range(1000)]


def test_document_rank_ties_keep_chunk_order(spark):
    pool = spark.createDataFrame(
        [("q", 1, "c1", "b", 0.9), ("q", 2, "c2", "a", 0.9), ("q", 3, "c3", "b", 0.5), ("q", 4, "c4", "z", 0.4),
         ("q", 5, "c5", "y", 0.3)], "query_id string, rank bigint, chunk_id string, doc_id string, score double")
    got = [(r["rank"], r.doc_id) for r in retrieve.rank_documents(pool).orderBy("rank").collect()]
    assert got == [(1, "b"), (2, "a"), (3, "z")]


def test_answer_is_nested_and_ordered(spark):
    docs = [(f"d{i}", f"d{i}_c", f"{w} one. {w} two. " * 90, "en", "f", "txt", 1, 0, 5)
            for i, w in enumerate(["river", "boat", "night", "calm"])]
    meta = spark.createDataFrame(docs, "doc_id string, chunk_id string, texto string, idioma string, fuente string, "
                                       "formato string, fenomeno int, posicion int, num_tokens int")
    enc = encode.HashingEncoder(64)
    index = encode.encode_texts(with_row_id(meta, ["chunk_id"]), enc, ["row_id", "chunk_id"])
    asked = spark.createDataFrame([("q2", "boat two"), ("q1", "night one")], "query_id string, text string")
    queries = encode.encode_texts(asked, enc, ["query_id"], "text")
    rows = retrieve.answer(queries, index, meta).collect()
    assert [r.query_id for r in rows] == ["q1", "q2"]
    first = rows[0]
    assert [d["rank"] for d in first.documents] == [1, 2, 3] and first.documents[0].doc_id == "d2"
    assert [f["rank"] for f in first.fragments] == list(range(1, 9))
    assert all(len(f.text.split()) <= 250 for f in first.fragments)
    assert first.fragments[0].chunk_id == "d2_c" and first.fragments[0].text.startswith("night one.")
    found = retrieve.search(queries, index, meta, 2)
    keys = spark.createDataFrame([("q1", ["NIGHT"]), ("q2", ["absent"])], "query_id string, keywords array<string>")
    assert {r.query_id: r.relevant for r in retrieve.keyword_relevance(found, keys).collect()} == {"q1": True, "q2": False}
    sane = retrieve.sanity_rows(found, F.lit(1)).first()
    assert sane.match and len(sane.preview) == 200


def test_no_cross_join_in_plans(spark):
    df = frame(spark, unit_rows(10, 4))
    q = df.withColumnRenamed("row_id", "query_id")
    for limit in (1 << 26, 1):
        plan = search.top_k(q, df, 2, max_query_bytes=limit)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("WindowGroupLimit") >= 2


def test_both_ways_give_the_same_scores_of_double_queries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(300, 16)))]
    stored = spark.createDataFrame(rows, "row_id bigint, vector array<float>")
    asked = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(rng.normal(size=(25, 16)))], "query_id string, vector array<double>")
    ways = [search.top_k(asked, stored, 7, max_query_bytes=limit).collect() for limit in (1 << 26, 0)]
    assert sorted(map(tuple, ways[0])) == sorted(map(tuple, ways[1])) and len(ways[0]) == 175


def test_large_query_sets_are_not_broadcast(spark):
    df = frame(spark, unit_rows(10, 4))
    asked = df.withColumnRenamed("row_id", "query_id")
    plan = search.top_k(asked, df, 2, max_query_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
