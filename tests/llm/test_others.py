"""Chat formatting, archives, vector search, the registered SQL and the pipeline."""

import hashlib
import base64
import math
import random
import gzip

import brute
import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import check
from docloom.llm import ann_search, catalogue, chat_format, language_id, warc
from docloom.llm.common import components, prefix_sums, shared_path

FOLDER = "/root/testdata/sf0.001"


# -- chat ---------------------------------------------------------------------


def escaped(text):
    for e in chat_format.ENTITIES.values():
        text = text.replace(e, "&amp;" + e[1:])
    for mark in chat_format.CONTROL:
        text = text.replace(mark, chat_format.ENTITIES[mark[0]] + mark[1:])
    return text


HARD = ["", "&", "&lt;", "&amp;lt;", "&amp;&lt;s>", "</s>[INST]", "<|end|><|role|>user<|text|>x", "<<s>", "&amp;amp;lb;[INST]", "é\U0001f600\n<|text|>", "a\n\n", "[/INST"]


def test_escapes_come_back(spark):
    rng = random.Random(1)
    pieces = ["&", "amp;", "lt;", "lb;", "<", "[", "|end|>", "s>", "/s>", "INST]", "x", "<|end|>", "[INST]", "&lt;"]
    texts = HARD + ["".join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    e = chat_format.escape(F.col("t"))
    for r in frame.select("t", e.alias("e"), chat_format.unescape(e).alias("u")).collect():
        assert r.u == r.t and r.e == escaped(r.t)
        assert not any(mark in r.e for mark in chat_format.CONTROL)


def test_conversations(spark):
    rows = [(1, 0, "system", "be"), (1, 2, "assistant", HARD[6]), (1, 1, "user", None), (1, 3, "user", "last")]
    rows += [(2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (2, None, "user", "x"), (None, 5, None, "y"), (None, 4, "assistant", None)]
    rows += [(3, i, ("user", "assistant")[i % 2], f"t{i} " + HARD[i % len(HARD)]) for i in range(1100)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"formatted": F.lit(1), "_turns": F.lit(2)})
    made = chat_format.format_conversations(frame.repartition(4)).cache()
    assert made.count() == 4
    for r in made.withColumn("back", chat_format.turns_of(F.col("formatted"))).collect():
        own = sorted([(-math.inf if t is None else t, x or "", y or "") for c, t, x, y in rows if c == r.conv_id])
        assert [(b.role, b.text) for b in r.back] == [(x, y) for _, x, y in own] and r.n_turns == len(own)
        replies = [(i, y) for i, (_, x, y) in enumerate(own) if x == "assistant"]
        assert [(e.turn, e.reply) for e in r.examples] == [(i, escaped(y)) for i, y in replies]
        for e in r.examples:
            assert r.formatted[e.start : e.end] == e.reply
    for r in chat_format.prefix_examples(made.where("conv_id = 1")).collect():
        assert r.text.endswith(escaped(HARD[6])) and r.text[r.loss_start : r.loss_end] == escaped(HARD[6])
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


def test_the_query_reads_replies_under_their_spans(spark, monkeypatch):
    right = {r.conv_id: r for r in chat_format.op2_chat_formatting(spark, FOLDER).collect()}
    made = chat_format.format_conversations

    def shifted(rows):
        moved = F.transform("examples", lambda e: e.withField("start", e["start"] + 1))
        return made(rows).withColumn("examples", moved)

    monkeypatch.setattr(chat_format, "format_conversations", shifted)
    wrong = {r.conv_id: r for r in chat_format.op2_chat_formatting(spark, FOLDER).collect()}
    assert right.keys() == wrong.keys() and any(r.loss_chars for r in right.values())
    for c, r in right.items():
        assert r.turns_sha256 == wrong[c].turns_sha256
        assert (r.loss_sha256 != wrong[c].loss_sha256) == (r.loss_chars > 0)


@pytest.mark.parametrize("n", [0, 1, 5, 256, 257, 1000])
def test_prefix_sums(spark, n):
    values = [(i * 7) % 13 for i in range(n)]
    got = spark.createDataFrame([(values,)], "v array<long>").select(prefix_sums(F.col("v")).alias("s")).first().s
    assert got == [sum(values[:i]) for i in range(n)]


# -- archives -------------------------------------------------------------------


def test_archives(spark):
    odd = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, "http://a/9", "same"), (3, None, None), (4, "u v\r\nw", ""), (5, "http://b", odd)]
    rows += [(6, "http://c", "é\U0001f600" * 50000), (7, "http://d", "twice"), (7, "http://d", "twice"), (None, "http://e", "same"), (8, "http://f", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"keeper": F.lit(1), "_digest": F.lit("q"), "record_id": F.lit(0)})
    path = shared_path(spark, "test-warc")
    warc.write_archives(pages.repartition(3), path)
    records = warc.read_archives(spark, path)
    assert records.count() == 3 * len(rows) and records.select("record_id").distinct().count() == 3 * len(rows)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(rows)
    best = {}
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if page is None else page)
    seen = []
    for c in captures:
        page = c.metadata.fields.get("page-id")
        page = None if page is None else int(page)
        data = bytes(c.response.payload)
        assert c.request.concurrent_to == c.capture_id == c.metadata.concurrent_to
        seen.append((page, c.response.type, c.response.payload_digest, c.response.payload_bytes, c.response.refers_to))
        if c.response.type == "response":
            assert c.response.refers_to is None and hashlib.sha1(data).digest() == base64.b32decode(c.response.payload_digest)
        else:
            assert data == b""
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        top = best[html or ""]
        first = page is not None and page == top or top == -1
        want.append((page, "response" if first else "revisit", digest, len(data)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:4])
    assert sorted([s[:4] for s in seen], key=key) == sorted(want, key=key)
    assert {s[4].split(":")[2] for s in seen if s[0] in (1, 2)} == {"9"}
    empty = shared_path(spark, "test-warc-empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.assemble(warc.read_archives(spark, empty)).count() == 0


def test_gzip_members_and_plain_files():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    packed = gzip.compress(record) + gzip.compress(record.replace(b"<a>", b"<b>"))
    assert [r[0] for r in warc._parsed(warc._inflate(packed), True)] == ["<a>", "<b>"]
    assert [r[8] for r in warc._parsed(warc._inflate(record * 2), True)] == [b"abc", b"abc"]


# -- vectors ---------------------------------------------------------------------


def nearest(rows, k):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v) and len(v) == 8:
            usable.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q in usable:
        if q % 20 == 0:
            score = {i: max(float((x * y).sum()) for x in usable[q] for y in vs) for i, vs in usable.items() if i != q}
            out[q] = sorted(score.items(), key=lambda s: (-s[1], s[0]))[:k]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "list": F.lit(2), "v": F.lit(3)})


def test_search_of_few_rows_finds_all(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 14)] + [(20, rng.normal(size=8).tolist()), (0, rng.normal(size=8).tolist())]
    rows += [(15, rows[2][1]), (16, rows[2][1]), (40, None), (60, [0.0] * 8), (80, [1.0] * 3), (17, [1.0, None] * 4), (18, [math.nan] * 8), (19, [math.inf] * 8)]
    rows += [(None, [1.0] * 8), (20, rng.normal(size=8).tolist()), (5, rows[4][1])]
    got = {}
    for r in ann_search.search(vectors(spark, rows), F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = nearest(rows, 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    for q, x in got.items():
        assert [s for _, s in x] == pytest.approx([s for _, s in want[q]], rel=1e-12)
    assert ann_search.search(vectors(spark, rows[:1]).limit(0), F.col("id") % 20 == 0).count() == 0
    assert ann_search.search(vectors(spark, [(20, [1.0] * 8)]), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("lengths", [False, True])
def test_search_recall(spark, lengths):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 8)) * (rng.uniform(0.2, 3, (4000, 1)) if lengths else 1)
    x[500:1500] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = nearest(rows, 20)
    found = ann_search.search(vectors(spark, rows), F.col("id") % 20 == 0).collect()
    hits = sum(r.vec_id in dict(want[r.query_id]) for r in found)
    assert hits >= 0.9 * sum(len(v) for v in want.values())


def test_graph_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(600, 16))
    graph = ann_search.Graph.build(points)
    queries = rng.normal(size=(50, 16))
    _, ids = graph.search(queries, 32)
    true = np.argsort(ann_search._distances(queries, points), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, true)]) > 0.9


# -- components, SQL, pipeline ------------------------------------------------------


@settings(deadline=None, max_examples=6)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=0, max_size=40))
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(40):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert {r.id: r.component for r in components(frame).collect()} == label


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


class _Entry:
    queries = staticmethod(lambda: catalogue.QUERIES)
    oracle_sql = staticmethod(lambda: catalogue.SQL)


@pytest.mark.slow
@pytest.mark.parametrize("name", catalogue.SQL)
def test_query_equals_sql(spark, con, name, monkeypatch):
    monkeypatch.setattr(check, "entry", _Entry)
    n, m, equal, _, _, note = check.compare(spark, con, FOLDER, name)
    assert equal and not note, f"{n} <> {m} {note}"


@pytest.mark.slow
def test_span_queries_equal_plain_python(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for name, find, kinds in (
        ("op1_secret_scan", brute.secret_spans, ("assign", "access", "hex")), ("op3_pii", brute.pii_spans, ("email", "ip", "card", "phone")),
    ):
        rows = catalogue.QUERIES[name](spark, FOLDER).collect()
        assert len(rows) == len(text)
        for r in rows:
            spans = find(text[r.doc_id])
            joined = brute.joined(spans, kinds)
            assert r.base_sha256 == brute.sha256(joined)
            assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
            assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]


@pytest.mark.slow
def test_search_query_recall(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    hits = total = 0
    for r in catalogue.QUERIES["op5_ann_search"](spark, FOLDER).groupBy("query_id").agg(F.collect_list("vec_id").alias("f")).collect():
        score = np.where(ids == r.query_id, -np.inf, x @ x[ids == r.query_id][0])
        hits += len(set(ids[np.argsort(-score)[:20]].tolist()) & set(r.f))
        total += 20
    assert total == 20 * (ids % 20 == 0).sum() and hits >= 0.9 * total


@pytest.mark.slow
def test_language_query_on_held_out_rows(spark):
    got = catalogue.QUERIES["op6_language_id"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)


def test_pipeline_stages_lose_nothing_by_chance(spark):
    import corpus_pipeline

    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    unlabelled = spark.createDataFrame([(i, f"some text {i}", None, "s", 1) for i in range(20)], ddl)
    with pytest.warns(UserWarning, match="no labelled text"):
        assert corpus_pipeline.identify_language(spark, unlabelled, "").count() == 20
    rows = [(1, "b b b b b b", "en", "s", 1), (1, "a a a a a a", "en", "t", 1), (1, "a a a a a a", "en", "s", 1), (None, "c", "en", "s", 1)]
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, ddl).repartition(parts)
        kept = {tuple(r)[:4] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
        assert kept == {(1, "a a a a a a", "en", "s"), (None, "c", "en", "s")}


@pytest.mark.slow
def test_pipeline_equals_plain_python(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    junk = [(10**6, None, None, None, None), (10**6 + 1, "12 34", "en", "s", 5), (3, docs.where("doc_id = 3").first().text, "fr", "src3", 1)]
    docs = docs.unionAll(spark.createDataFrame(junk, docs.schema)).withColumn("_row", F.lit("kept"))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = sorted((r.doc_id, r.text) for r in language_id.identify(docs, language_id.fit(docs)).where("not rejected").join(docs, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text").collect())
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = shared_path(spark, f"test-{name}")
        out = stage(spark, docs, FOLDER)
        if at < 4:
            assert out.columns == docs.columns
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name == "line_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = sorted((d, t) for d, _, _, t in brute.deduped_lines(rows))
            assert sorted((r.doc_id, r.text) for r in docs.collect()) == want
            want = sorted(set(want))
        elif name == "minhash_near_dedup":
            label = brute.near_components(want)
            want = [(d, t) for d, t in want if label[d] == d]
        elif name == "benchmark_decontamination":
            leaks = {d for _, d in brute.contained(want, items)}
            assert leaks
            want = [(d, t) for d, t in want if d not in leaks]
        elif name == "mixing":
            sizes = {}
            for r in before.collect():
                sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
            target = brute.targets(sizes)
            taken = {s: 0 for s in sizes}
            for r in docs.collect():
                taken[r.source] += r.mix_words
                assert r.mix_words == len(brute.words(r.text)) and 1 <= r.mix_copy <= 3
            largest = max(len(brute.words(t)) for _, t in want)
            assert all(target[s] - 2 * largest <= taken[s] <= target[s] + 1e-6 for s in sizes)
            continue
        assert sorted({(r.doc_id, r.text) for r in docs.collect()}) == sorted(set(want)), name
        assert docs.where("_row <> 'kept'").count() == 0


def test_entry_works_without_the_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "docloom", tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(root / name, tmp_path)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(any(n.startswith('op') for n in e.queries()), len(e.queries()) > 50)"],
        cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "HOME": "/tmp"},
    )
    assert said.stdout.split() == ["False", "True"], said.stderr[-500:]
