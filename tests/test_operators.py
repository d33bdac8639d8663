"""Pages, compaction, tiles, statistics and JSON on hand-made tables."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docloom.operators import compact, pages, stats, tiles
from docloom.operators.json_documents import json_documents
from docloom.plans import log_table


def page_table(spark, docs):
    rows = [(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "doc_id string, page bigint, texto string")


def test_boilerplate_rules(spark):
    head = [f"Report {i}\nbody {'x' * i}" for i in range(4)]
    docs = {
        "four": head, "three": head[:3], "blank": head[:3] + [""], "few": head[:2] + ["a", "b", "c"],
        "long": ["z" * 121] * 4, "edge": ["z" * 120] * 4,
        "twice": ["Page 1\nPage 2", "Page 3\nother", "a", "b"],
        "eight": [f"Head\n{'y' * i}" for i in range(1, 4)] + ["q", "r", "s", "t", "u"],
    }
    got = {(r.doc_id, r.firma): r.n for r in pages.boilerplate(page_table(spark, docs)).collect()}
    assert got == {
        ("four", "report #"): 4, ("blank", "report #"): 3, ("edge", "z" * 120): 4, ("twice", "page #"): 3,
    }


def test_strip_page_lines(spark):
    docs = {"d": [f"Head {i}\nText {c}-\nmore {c}\n\nLast {c}.\n{i}" for i, c in enumerate("abcd")], "e": ["Head 1\n7"]}
    got = {(r.doc_id, r.page): r.texto for r in pages.strip_page_lines(page_table(spark, docs)).collect()}
    assert got["d", 0] == "Text amore a\n\nLast a." and got["d", 3] == "Text dmore d\n\nLast d."
    assert got["e", 0] == "Head 1"


def test_page_arrays_equal_page_rows(spark):
    rng = random.Random(5)
    lines = ["Head 1", "HEAD 2", "- 3 -", "Página 4 de 9", "", "  ", "body a-", "body b", "z" * 121, "Foot\t9"]
    docs = {
        f"d{n}": ["\n".join(rng.choice(lines) for _ in range(rng.randrange(9))) for _ in range(n % 13)] for n in range(60)
    }
    made = spark.createDataFrame(list(docs.items()), "doc_id string, pages array<string>")
    for ratio in (0.5, 0.2):
        rows = pages.strip_page_lines(page_table(spark, docs), ratio)
        want = {(r.doc_id, r.page): r.texto for r in rows.collect()}
        counted = {(r.doc_id, r.firma): r.n for r in pages.boilerplate(page_table(spark, docs), ratio).collect()}
        inside = made.select("doc_id", pages.strip_page_array("pages", ratio).alias("p"), pages.furniture("pages", ratio).alias("f"))
        assert "Exchange" not in inside._jdf.queryExecution().executedPlan().toString()
        got = inside.collect()
        assert {(r.doc_id, i): t for r in got for i, t in enumerate(r.p)} == want
        assert {(r.doc_id, f.firma): f.n for r in got for f in r.f} == counted and counted
    odd = spark.createDataFrame([("n", None), ("e", []), ("m", ["x", None, " "])], "doc_id string, pages array<string>")
    stripped = odd.select("doc_id", pages.strip_page_array("pages").alias("p"))
    got = {r.doc_id: (r.p, r.t) for r in stripped.select("*", pages.joined_pages("p").alias("t")).collect()}
    assert got == {"n": (None, None), "e": ([], None), "m": (["x", "", ""], "x")}


def test_ordered_text_over_runs(spark):
    rows = spark.createDataFrame([(i % 2, i, f"t{i}") for i in range(40)], "k int, p bigint, t string")
    got = {r.k: r.texto for r in pages.ordered_text(rows, "k", "p", "t", ",", run=3).collect()}
    assert got == {k: ",".join(f"t{i}" for i in range(40) if i % 2 == k) for k in (0, 1)}


def test_latest_and_memory(spark):
    log = spark.createDataFrame(
        [(1, "a", "error", "MemoryError: x"), (2, "a", "ok", None), (3, "b", "error", "Unable to allocate"),
         (4, "c", "error", "bad"), (5, "b", "error", "MemoryError"), (6, "d", "ok", "MemoryError")],
        "seq bigint, doc_id string, estado string, detalle string",
    )
    latest = {r.doc_id: r.seq for r in compact.latest_wins(log).collect()}
    assert latest == {"a": 2, "b": 5, "c": 4, "d": 6}
    assert [r.doc_id for r in compact.out_of_memory(log).collect()] == ["b"]


def test_first_per_group_salted_equals_plain(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), "id")
    for k in (5, 1500):
        got = compact.first_per_group(rows, ["g"], [F.col("id").desc()], k, "r").collect()
        want = {(g, i) for g in range(3) for i in sorted((i for i in range(5000) if i % 3 == g))[-k:]}
        assert {(r.g, r.id) for r in got} == want
        assert all(r.r <= k for r in got)


def test_hot_key_sends_few_rows(spark):
    hot = spark.range(100).select((F.col("id") % 1).alias("doc_id"), F.col("id").alias("seq"))
    plan = compact.latest_wins(hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_stratified_head(spark):
    kinds = ["PDF"] * 10 + ["CSV"] * 1 + ["JSON"] * 5
    rows = spark.createDataFrame(list(enumerate(kinds)), "pos bigint, Tipo string")
    got = [r.pos for r in compact.stratified_head(rows, "Tipo", "pos", 6).collect()]
    assert got == [0, 1, 10, 11, 12]
    assert [r.pos for r in compact.stratified_head(rows, "Tipo", "pos", 2).collect()] == [0, 10]


def feature(path, pos, props, layer="roads", layer_pos=0):
    return (path, layer, layer_pos, pos, [{"k": k, "v": v} for k, v in props])


def test_tiles(spark):
    rows = [
        feature("b", 0, [("fid", "1"), ("name", "late")]),
        feature("a", 0, [("fid", "1"), ("name", "first")]),
        feature("a", 1, [("fid", " "), ("name", "anon")]),
        feature("a", 2, [("fid", " "), ("name", "anon")]),
        feature("a", 3, [("b_ID_concatenated", "9"), ("fid", "1")]),
        feature("a", 4, [("fid", "0"), ("name", "none")]),
        feature("b", 1, [("fid", "0"), ("name", "zero")]),
        feature("b", 2, [("fid", "1"), ("name", "other layer")], "rivers", 1),
        feature("c", 0, [("fid", "1")]),
    ]
    df = spark.createDataFrame(
        rows, "path string, layer string, layer_pos bigint, feature_pos bigint, props array<struct<k:string,v:string>>")
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "path string")
    got = {r.path: r for r in tiles.tile_documents(df, names).collect()}
    assert got["a"].texto.split("\n") == [
        "fid: 1 | name: first", "name: anon", "name: anon", "b_ID_concatenated: 9 | fid: 1", "fid: 0"]
    # Feature 0 was consumed by tile a, so tile b keeps only the other layer.
    assert got["b"].texto == "fid: 1 | name: other layer"
    assert (got["c"].estado, got["c"].texto, got["c"].detalle) == ("duplicado_pbf", "", "features=1 nuevas=0")
    assert (got["d"].estado, got["d"].filas_totales) == ("vacio", 0)


@pytest.mark.parametrize("seed", range(3))
def test_tiles_arriving_in_any_order(spark, tmp_path, seed):
    """Each arrival writes its tiles and those that lose a key; the end is that of all tiles at once."""
    rng = random.Random(seed)
    rows = [
        feature(f"t{t}", pos, [("fid", rng.choice(["1", "2", "3", str(10 + t), " "])), ("n", f"{t}-{pos}")],
                rng.choice(["roads", "rivers"]), 0)
        for t in range(8) for pos in range(4)
    ]
    df = spark.createDataFrame(
        rows, "path string, layer string, layer_pos bigint, feature_pos bigint, props array<struct<k:string,v:string>>")
    df = df.withColumn("id", tiles.feature_id(F.col("props")))
    want = {r.path: (r.texto, r.estado, r.detalle) for r in tiles.tile_documents(df, df.select("path").distinct()).collect()}
    order = [f"t{t}" for t in range(8)]
    rng.shuffle(order)
    store, got, written = f"{tmp_path}/owners", {}, 0
    for part in (order[:3], order[3:7], order[7:]):
        new = df.where(F.col("path").isin(part))
        tiles.feature_owners(new).write.mode("append").parquet(store)
        owners = spark.read.parquet(store)
        again = [r.path for r in tiles.losing_tiles(new, owners).collect()]
        assert not set(again) & set(part) and set(again) <= set(got)
        changed = df.where(F.col("path").isin(part + again))
        made = tiles.tile_documents(changed, changed.select("path").distinct(), owners).collect()
        got.update({r.path: (r.texto, r.estado, r.detalle) for r in made})
        written += len(made)
    assert got == want and written >= 8


def test_tiles_with_owners_are_read_once_a_use(spark, tmp_path):
    rows = [feature("a", 0, [("fid", "1")]), feature("b", 0, [("fid", "1")]), feature("b", 1, [("fid", " "), ("n", "x")])]
    spark.createDataFrame(
        rows, "path string, layer string, layer_pos bigint, feature_pos bigint, props array<struct<k:string,v:string>>"
    ).write.parquet(f"{tmp_path}/features")
    df = spark.read.parquet(f"{tmp_path}/features")
    tiles.feature_owners(df).write.parquet(f"{tmp_path}/owners")
    df.select("path").distinct().write.parquet(f"{tmp_path}/tiles")
    made = tiles.tile_documents(
        df, spark.read.parquet(f"{tmp_path}/tiles"), spark.read.parquet(f"{tmp_path}/owners"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    # Features for their number, for those kept and for the text; tiles once, owners twice.
    assert sum("Relation [" in line for line in plan.splitlines()) == 6
    assert {r.path: r.detalle for r in made.collect()} == {"a": "features=1 nuevas=1", "b": "features=2 nuevas=1"}


def document_rows(spark):
    rows = [("a", "ok", "pdf", 1, "es", 10, 5, False), ("b", "ok", "csv", None, "en", 20, 6, None),
            ("c", "error", "pdf", 2, "es", 0, 0, True), ("d", None, None, 2, None, 1, 1, False)]
    return spark.createDataFrame(
        rows, "doc_id string, estado string, formato string, fenomeno bigint, idioma string, n_palabras bigint, "
        "n_caracteres bigint, truncado boolean").withColumn("texto", F.lit("t"))


def test_summary(spark):
    got = {(r.metric, r.key): r.value for r in stats.corpus_summary(document_rows(spark)).collect()}
    assert got == {
        ("documentos_totales", None): 4, ("documentos_ok", None): 2, ("documentos_no_ok", None): 2,
        ("palabras_totales", None): 31, ("caracteres_totales", None): 12, ("truncados", None): 1,
        ("por_estado", "ok"): 2, ("por_estado", "error"): 1, ("por_formato", "pdf"): 2, ("por_formato", "csv"): 1,
        ("ok_por_formato", "pdf"): 1, ("ok_por_formato", "csv"): 1, ("por_fenomeno", "1"): 1,
        ("por_fenomeno", "2"): 2, ("por_idioma", "es"): 1, ("por_idioma", "en"): 1,
    }
    text = stats.summary_record(document_rows(spark)).first().resumen
    assert json.loads(text)["por_estado"] == {"error": 1, "ok": 2}
    assert json.loads(text)["documentos_totales"] == 4
    assert [r.doc_id for r in stats.error_rows(document_rows(spark)).collect()] == ["c", "d"]
    assert "texto" not in stats.metadata_table(document_rows(spark)).columns


def test_chunk_statistics(spark):
    rows = [("a", 0, "x.", 1, "es"), ("a", 1, "open", 2, "es"), ("b", 0, "y", 3, "en"), ("c", 0, "z", 9, "en"),
            ("c", 1, "end.", 5, "en")]
    df = spark.createDataFrame(rows, "doc_id string, posicion bigint, texto string, num_tokens bigint, idioma string")
    df = df.withColumn("n_caracteres_chunk", F.length("texto")).withColumn("n_palabras_chunk", F.lit(1))
    r = stats.chunk_statistics(df).first()
    assert (r.documents, r.chunks, r.mean_tokens) == (3, 5, 4.0) and abs(r.chunks_per_document - 5 / 3) < 1e-9
    assert stats.length_percentiles(df).first().asDict() == {"p50": 3.0, "p90": 7.4, "max": 9}
    share = {r.idioma: (r.n, r.ok) for r in stats.boundary_share(df).collect()}
    assert share == {"es": (2, 2), "en": (3, 2)}


JSON_CASES = [
    ('{"title":"","titulo":" H ","body_paragraphs":[" p1 ",2,1.5,true,null,{"a":1},""],"body_text":"no",'
     '"authors":["A"," ","B"],"tags":["x","y"],"keywords":["z"],"url":"","source_url":5,"date":2020}',
     dict(subtipo_json="articulo", titulo="H", texto="H\n\np1\n\n2\n\n1.5\n\nTrue", autores="A; B",
          etiquetas="x; y; z", url="5", fecha="2020", estado="ok")),
    ('{"title":7,"body_paragraphs":[],"body_text":" b "}', dict(subtipo_json="articulo", titulo=None, texto="b")),
    ('{"sections":[{"heading":"H1","paragraphs":["a","b"]},7,{"heading":null,"paragraphs":["c"]},'
     '{"heading":"only"},{}],"lists":["l1","l2"],"abstract":"no"}',
     dict(subtipo_json="pagina_secciones", texto="H1\n\na\n\nb\n\nc\n\nonly\n\nl1\n\nl2")),
    ('{"abstract":" ab ","excerpt":"no"}', dict(subtipo_json="resumen_academico", texto="ab")),
    ('{"title":"T","content":{"sections":{"z":"zz ","a":"aa","n":3}},"metadata":{"title":"M","description":"D"}}',
     dict(subtipo_json="reporte_secciones", titulo="T", texto="T\n\nD\n\nz\n\nzz\n\na\n\naa")),
    ('{"content":{"sections":{"z":"zz"}},"metadata":{"title":"M","description":"D"}}',
     dict(subtipo_json="reporte_secciones", titulo="M", texto="z\n\nzz\n\nD")),
    ('{"content":{},"excerpt":"no"}', dict(subtipo_json="reporte_secciones", texto="", estado="vacio")),
    ('{"title":3,"excerpt":" e "}', dict(subtipo_json="solo_extracto", texto="e")),
    ('{"title":"solo"}', dict(subtipo_json="sin_cuerpo", texto="solo", estado="ok")),
    ('{"title":"T","body_text":"bt","alerta_meta":{"tipo":"t1","municipios":["m1","m2"],"fecha_emision":"2020"}}',
     dict(subtipo_json="alerta_temprana", fecha="2020",
          texto="T\n\nTipo de alerta: t1. Municipios: ['m1', 'm2'].\n\nbt")),
    ('{"alerta_meta":{"tipo":"t1"},"date":"1999"}',
     dict(subtipo_json="alerta_temprana", texto="Tipo de alerta: t1.", fecha="1999")),
    ('{"title":"T","alerta_meta":{}}', dict(subtipo_json="sin_cuerpo", texto="T")),
    ('[{"a":1,"b":"x"},{"b":null,"c":2.5,"a":3},{"a":null,"d":true},{"Unnamed: 0":1}]',
     dict(subtipo_json="catalogo_lista", texto="a: 1.0 | b: x\na: 3.0 | c: 2.5\nd: True", filas_totales=4)),
    ('[{"a":1,"b":"nan"},{"a":2,"b":" "}]', dict(subtipo_json="catalogo_lista", texto="a: 1\na: 2")),
    ("[]", dict(subtipo_json="catalogo_vacio", texto="", estado="vacio", filas_totales=None)),
    ("[1,2]", dict(subtipo_json="catalogo_lista", texto="", filas_totales=None)),
    ("3", dict(subtipo_json="desconocido", estado="vacio")),
    ("{bad", dict(subtipo_json=None, estado="error")),
    ('{"tags":["a"],"topics":[" "],"categories":"no"}', dict(etiquetas="a", autores=None)),
]


def test_json_branches(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(JSON_CASES)], "i int, raw string")
    rows = {r.i: r.asDict() for r in json_documents(df).collect()}
    for i, (raw, wanted) in enumerate(JSON_CASES):
        assert {k: rows[i][k] for k in wanted} == wanted, raw


def test_passes(spark):
    one = spark.createDataFrame([("a", "error"), ("b", "ok")], "doc_id string, estado string")
    two = spark.createDataFrame([("a", "ok")], "doc_id string, estado string")
    final = compact.latest_wins(compact.append_passes(one, two), "doc_id", "pass")
    assert Counter((r.doc_id, r.estado) for r in final.collect()) == Counter([("a", "ok"), ("b", "ok")])
    assert [r.doc_id for r in compact.pending(one, two).collect()] == ["b"]
    assert [r.doc_id for r in compact.among(one, two).collect()] == ["a"]
    assert sorted(r.doc_id for r in compact.done_keys(one, two).collect()) == ["a", "b"]


def test_compaction_rewrites_touched_buckets(spark, tmp_path):
    """A run with one document rewrites one bucket; any history gives what a full compaction gives."""
    out, columns = f"{tmp_path}/out", ["doc_id", "estado"]

    def log(rows):
        return spark.createDataFrame(rows, "doc_id string, estado string, seq long")

    def files():
        return {p.parent.name: p.name for p in (tmp_path / "out").glob("cubo=*/*.parquet")}

    rows = [(f"d{i}", "error" if i % 3 else "ok", 1) for i in range(60)] + [(None, "ok", 1)]
    assert log_table.compact(spark, log(rows), out, columns, 0, buckets=8) is None
    before = files()
    assert len(before) == 8
    rows.append(("d7", "ok", 2))
    # The number of buckets a table was made with stays.
    assert log_table.compact(spark, log(rows), out, columns, 1, buckets=9) == 1
    assert sum(before[b] != name for b, name in files().items()) == 1 and len(files()) == 8
    rows += [("new", "ok", 3), ("d7", "vacio", 4)]
    assert log_table.compact(spark, log(rows), out, columns, 2) <= 2
    last = {}
    for key, state, _ in sorted(rows, key=lambda r: r[2]):
        last[key] = state
    assert len(log_table.read(spark, out).collect()) == len(last)
    assert dict((r.doc_id, r.estado) for r in log_table.read(spark, out).collect()) == last
    assert log_table.compact(spark, log(rows), out, columns, 4) == 0
    # A run that died before it compacted: its rows come in by a full compaction.
    rows += [("lost", "ok", 5), ("after", "ok", 6)]
    assert log_table.compact(spark, log(rows), out, columns, 5) is None
    assert {"lost", "after"} <= {r.doc_id for r in log_table.read(spark, out).collect()}
