"""Files to documents, sinks, index folder and incremental runs, end to end."""

import json
import struct
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import encode, retrieve
from docloom.plans import build_index as B
from docloom.plans import extract as E
from docloom.plans import stream_queries
from docloom.plans.isolate import isolated
from docloom.sources import csv_files, decoders, inventory, jsonl, sinks
from docloom.sources.index import alignment, export_metadata, load_index
from docloom.streaming import incremental

INVENTORY_DDL = ("pos bigint, DOC_ID string, Carpeta string, `Nombre estandarizado` string, Tipo string, "
                 "`Fenómeno` string, Observatorio string, `Código Observatorio` string")


def varint(n):
    out = b""
    while True:
        out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return out


def part(number, data):
    return varint(number << 3 | 2) + varint(len(data)) + data


def tile(layers):
    """A vector tile of {layer: [properties]}, written by hand."""
    out = b""
    for name, features in layers.items():
        keys, values, body = [], [], b""
        for props in features:
            tags = b""
            for k, v in props.items():
                keys.append(k)
                if isinstance(v, bool):
                    values.append(varint(7 << 3) + varint(int(v)))
                elif isinstance(v, int):
                    values.append(varint(6 << 3) + varint(v << 1 if v >= 0 else (-v << 1) - 1))
                elif isinstance(v, float):
                    values.append(varint(3 << 3 | 1) + struct.pack("<d", v))
                else:
                    values.append(part(1, v.encode()))
                tags += varint(len(keys) - 1) + varint(len(values) - 1)
            body += part(2, part(2, tags))
        layer = part(1, name.encode()) + body
        layer += b"".join(part(3, k.encode()) for k in keys) + b"".join(part(4, v) for v in values)
        out += part(3, layer)
    return out


def workbook(path, sheets):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f"<workbook {main} {rel}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>shared</t></si></sst>")
        for i, rows in enumerate(sheets.values()):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = ""
                for c, v in enumerate(row):
                    ref = f'r="{chr(65 + c)}{r}"'
                    if v == "shared":
                        cells += f'<c {ref} t="s"><v>0</v></c>'
                    elif isinstance(v, str):
                        cells += f'<c {ref} t="inlineStr"><is><t>{v}</t></is></c>'
                    elif v is not None:
                        cells += f"<c {ref}><v>{v}</v></c>"
                body += f"<row>{cells}</row>"
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    (root / "f").mkdir()
    files = [
        ("a.json", "JSON", json.dumps({"title": "T", "abstract": "Cuerpo. Fin."}).encode()),
        ("bad.json", "JSON", b"{broken"),
        ("latin.csv", "CSV", "nombre;edad\nJosé;3\n;\nx;nan\nbad;1;2;3\n".encode("latin-1")),
        ("t.txt", "Texto", b"SOURCE: http://u\nSCRAPED: now\n==\nMenu\nMenu\nText here.\n"),
        ("empty.txt", "Texto", b" \n "),
        ("z1.pbf", "Otro", tile({"l": [{"fid": 1, "n": "first", "w": 1.5, "b": True}, {"n": "anon"}]})),
        ("z2.pbf", "Otro", tile({"l": [{"fid": 1, "n": "again"}]})),
        ("x.dat", "Otro", b"?"),
        ("p.pdf", "PDF", b"%PDF"),
        ("i.png", "Imagen", b"\x89PNG"),
    ]
    for name, _, data in files:
        (root / "f" / name).write_bytes(data)
    workbook(root / "f" / "w.xlsx", {"One": [["shared", "n"], ["v", 2], [None, None]], "None": [], "Two": [["k"], ["z"]]})
    rows = [(i, f"D{i}", "f/", n, t, "F1", "obs", "1") for i, (n, t, _) in enumerate(files)]
    rows += [(50, "D50", "f", "w.xlsx", "Excel", "F9", "obs", "1"), (51, "D51", "f", "gone.txt", "Texto", "F2", "obs", "1")]
    inv = inventory.inventory(spark.createDataFrame(rows, INVENTORY_DDL), str(root))
    assert inv.schema.simpleString() == schemas.INVENTORY.simpleString()
    return root, inv


def test_extract_all_formats(spark, corpus):
    _, inv = corpus
    docs = E.extract(inv)
    assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schemas.DOCUMENTS]
    rows = {r.fuente: r for r in docs.collect()}
    assert len(rows) == 12
    state = {n: r.estado for n, r in rows.items()}
    assert state == {
        "a.json": "ok", "bad.json": "error", "latin.csv": "ok", "t.txt": "ok", "empty.txt": "vacio", "z1.pbf": "ok",
        "z2.pbf": "duplicado_pbf", "x.dat": "formato_no_soportado", "p.pdf": "error", "i.png": "pendiente_ocr",
        "w.xlsx": "ok", "gone.txt": "error",
    }
    assert rows["a.json"].texto == "T\n\nCuerpo. Fin." and rows["a.json"].titulo == "T"
    assert rows["a.json"].subtipo_json == "resumen_academico" and rows["a.json"].n_palabras == 3
    assert rows["latin.csv"].texto == "nombre: José | edad: 3\nnombre: x" and rows["latin.csv"].filas_totales == 3
    assert (rows["t.txt"].texto, rows["t.txt"].url) == ("Menu\nText here.", "http://u")
    assert rows["z1.pbf"].texto == "fid: 1 | n: first | w: 1.5 | b: True\nn: anon"
    assert rows["z1.pbf"].detalle == "features=2 nuevas=2" and rows["z2.pbf"].filas_totales == 1
    assert rows["w.xlsx"].texto == "Hoja: One\nshared: v | n: 2\n\nHoja: Two\nk: z"
    assert rows["w.xlsx"].fenomeno is None and rows["t.txt"].fenomeno == 1
    assert rows["gone.txt"].detalle.startswith("FileNotFoundError") and rows["gone.txt"].idioma == "desconocido"
    assert rows["a.json"].bytes_archivo > 10 and len(rows["a.json"].hash_sha1) == 40
    assert rows["p.pdf"].detalle == "sin lector registrado: pdf" and rows["x.dat"].detalle == "dat"
    assert rows["latin.csv"].detalle == "texto no UTF-8, leido como Latin-1"


def test_decoders_are_plugged_in(spark, corpus):
    def pages_of(data, path):
        return {"pages": ["Head 1\nFirst page.\n7", "Head 2\nSec-\nond page.\n8"], "raw": "A title"}

    _, inv = corpus
    some = inv.filter(F.col("fuente").isin("p.pdf", "i.png"))
    docs = E.extract(some, decoders={"pdf": pages_of, "image": lambda data, path: {"raw": "word " * 30}})
    rows = {r.fuente: r for r in docs.collect()}
    assert rows["p.pdf"].estado == "ok" and rows["p.pdf"].n_paginas == 2 and "First page." in rows["p.pdf"].texto
    assert rows["p.pdf"].titulo == "A title" and rows["i.png"].estado == "ok" and rows["i.png"].n_palabras == 30


@pytest.mark.parametrize("data, rows", [
    (b"a,b\n1,\"x, y\"\n", [["1", "x, y"]]), (b"a|b\n1|2\n3\n", [["1", "2"], ["3", None]]), (b"a\tb\n\"1\n2\"\t3\n", [["1\n2", "3"]]),
    ("\ufeffa;b\né;ñ\n".encode(), [["é", "ñ"]]), (b"", []), (b"only\nx\n", [["x"]]),
])
def test_csv_dialects(data, rows):
    assert decoders.decode_csv(data, "")["sheets"][0]["rows"] == rows


def test_splittable_rows_are_those_of_the_decoder(spark, tmp_path):
    data = b"a,b,c\n1,2,3\n4,5\n6,7,8,9\n7,8,9\n\"x,\"\"y\",,\n\"p,q,r,s\",t\n,,,\n"
    (tmp_path / "t.csv").write_bytes(data)
    want = decoders.decode_csv(data, "")["sheets"][0]["rows"]
    for schema in (None, "a string, b string, c string"):
        rows = csv_files.csv_rows(spark, str(tmp_path / "t.csv"), schema=schema).orderBy("_pos")
        assert [[r.a, r.b, r.c] for r in rows.collect()] == want
        assert [r.b for r in rows.select("b").collect()] == [w[1] for w in want]


def test_latin_text_is_not_lost():
    assert decoders.decode_text("año".encode("latin-1"), "") == {"raw": "año", "detalle": "texto no UTF-8, leido como Latin-1"}
    assert decoders.decode_text("año".encode(), "") == {"raw": "año", "detalle": None}


def test_a_file_that_kills_its_worker_is_isolated(spark, tmp_path):
    def killer(data, path):
        import os


        if b"D2" in data and not os.path.exists(os.path.join(os.path.dirname(path), "healed")):
            os._exit(9)
        return {"raw": data.decode()}

    (tmp_path / "f").mkdir()
    rows = []
    for i in range(8):
        (tmp_path / "f" / f"t{i}.txt").write_text(f"Text D{i} here.")
        rows.append((i, f"D{i}", "f/", f"t{i}.txt", "Texto", "F1", "obs", "1"))
    inv = inventory.inventory(spark.createDataFrame(rows, INVENTORY_DDL), str(tmp_path)).coalesce(1)

    def run():
        E.run(spark, inv, f"{tmp_path}/log", f"{tmp_path}/out", decoders={"txt": killer}, batches=2)
        return {r.doc_id: r.estado for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    with pytest.warns(UserWarning, match="failed alone"):
        state = run()
    assert state == {f"D{i}": "error" if i == 2 else "ok" for i in range(8)}
    log = spark.read.parquet(f"{tmp_path}/log")
    tries = {r.doc_id: r.intentos for r in log.collect()}
    assert tries["D2"] >= 2 and log.count() == 8
    assert {r.doc_id for r in E.settled(log).collect()} == set(state) - {"D2"}
    # The next run tries it again, and nothing else.
    (tmp_path / "f" / "healed").write_text("")
    assert set(run().values()) == {"ok"} and spark.read.parquet(f"{tmp_path}/log").count() == 9


def test_a_tile_that_kills_its_worker_is_left_out(spark, corpus, tmp_path):
    _, inv = corpus
    tiles = inv.where("ruta_relativa like '%.pbf'")

    def killer(data, path):
        import os


        if path.endswith("z2.pbf"):
            os._exit(9)
        return decoders.decode_tile(data, path)

    with pytest.warns(UserWarning, match="tile failed alone"):
        E.run(spark, tiles, f"{tmp_path}/log", f"{tmp_path}/out", decoders={"pbf": killer})
    rows = {r.fuente: (r.estado, r.detalle) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert rows["z1.pbf"][0] == "ok" and rows["z2.pbf"][0] == "error"


def test_marked_encodings():
    for encoding in ("utf-16", "utf-32", "utf-8-sig"):
        assert decoders.decode_text("año 河".encode(encoding), "") == {"raw": "año 河", "detalle": None}
    read = decoders.decode_csv("nombre;edad\nJosé;3\n".encode("utf-16"), "")
    assert read["sheets"][0]["rows"] == [["José", "3"]]
    # A mark without the text it promises is read as bytes.
    assert decoders.decode_text(b"\xff\xfea", "")["raw"] == "ÿþa"


def test_a_tile_that_arrives_late(spark, corpus, tmp_path):
    """The earlier tile comes second: the later one loses the feature they share, and no other tile is read."""
    _, inv = corpus
    tiles = inv.where("ruta_relativa like '%.pbf'")
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"

    def state():
        return {r.fuente: (r.estado, r.detalle) for r in spark.read.parquet(out).collect()}

    E.run(spark, tiles.where("fuente = 'z2.pbf'"), log, out, batches=1)
    assert state() == {"z2.pbf": ("ok", "features=1 nuevas=1")}
    E.run(spark, tiles, log, out, batches=1)
    assert state() == {"z1.pbf": ("ok", "features=2 nuevas=2"), "z2.pbf": ("duplicado_pbf", "features=1 nuevas=0")}
    assert spark.read.parquet(log).count() == 3


def test_a_broken_store_is_no_fault_of_a_file(spark):
    files = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    asked = []

    def broken(*_):
        asked.append(1)
        raise AnalysisException("no store")

    with pytest.raises(AnalysisException):
        isolated(files, broken, lambda *_: pytest.fail("blamed a file"), broken)
    assert len(asked) == 2


def test_extract_resumes(spark, corpus):
    _, inv = corpus
    done = inv.filter(~F.col("fuente").isin("z2.pbf", "t.txt"))
    names = sorted(r.fuente for r in E.extract(inv, done).collect())
    # One pending tile brings back all tiles.
    assert names == ["t.txt", "z1.pbf", "z2.pbf"]
    assert E.extract(inv, inv).count() == 0


def test_run_log_and_sinks(spark, corpus, tmp_path):
    _, inv = corpus
    some = inv.filter(F.col("fuente").isin("a.json", "bad.json", "t.txt"))
    log, out = f"{tmp_path}/log", f"{tmp_path}/documents"
    E.run(spark, some.filter("fuente <> 't.txt'"), log, out)
    E.run(spark, some, log, out)
    docs = spark.read.parquet(out)
    assert {r.fuente: r.estado for r in docs.collect()} == {"a.json": "ok", "bad.json": "error", "t.txt": "ok"}
    assert spark.read.parquet(log).count() == 3
    sinks.write_metadata_csv(docs, f"{tmp_path}/meta")
    sinks.write_errors_csv(docs, f"{tmp_path}/errors")
    sinks.write_summary(docs, f"{tmp_path}/summary")
    assert spark.read.csv(f"{tmp_path}/meta", header=True).count() == 3
    assert [r.fuente for r in spark.read.csv(f"{tmp_path}/errors", header=True).collect()] == ["bad.json"]
    assert json.loads(spark.read.text(f"{tmp_path}/summary").first().value)["documentos_ok"] == 2


def test_lost_rows(spark, corpus):
    _, inv = corpus
    rows = E.lost_rows(inv, inv.filter("fuente <> 'x.dat'")).collect()
    assert [(r.fuente, r.estado, r.formato) for r in rows] == [("x.dat", "error", "dat")]


def test_scanned_rules_on_sheets(spark):
    df = spark.createDataFrame([([("S", ["Unnamed: 0", "a"], [["1", " x "], ["2", None]])],)],
                               "sheets array<struct<name:string,columns:array<string>,rows:array<array<string>>>>")
    assert df.select(E.sheets_text("sheets").alias("t")).first().t == "a: x"


def test_jsonl(spark, tmp_path):
    lines = ['{"doc_id":"a","estado":"ok"}', "", '{"doc_id":"b","est', '{"estado":"ok"}', "7", '{"doc_id":"c"}']
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    rows = jsonl.read_jsonl(spark, str(tmp_path / "x.jsonl"), schemas.DOCUMENTS).orderBy("seq").collect()
    assert [(r.doc_id, r.estado) for r in rows] == [("a", "ok"), ("c", None)]


def test_later_log_files_win(spark, tmp_path):
    """A larger file is scanned first; its rows are still the later ones."""
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.jsonl").write_text('{"doc_id":"x","estado":"old"}\n{"doc_id":"y","estado":"old"}\n')
    (tmp_path / "log" / "b.jsonl").write_text("\n".join('{"doc_id":"z","estado":"%d"}' % i for i in range(3000)) + '\n{"doc_id":"x","estado":"new"}\n')
    rows = jsonl.read_jsonl(spark, str(tmp_path / "log"), schemas.DOCUMENTS)
    from docloom.operators.compact import latest_wins

    last = {r.doc_id: r.estado for r in latest_wins(rows).collect()}
    assert last == {"x": "new", "y": "old", "z": "2999"}
    assert sorted(r.seq for r in rows.select("seq").collect()) == list(range(3003))


def test_inventory_from_workbook(spark, tmp_path):
    workbook(tmp_path / "inv.xlsx", {"Inventario": [list(inventory.COLUMNS), ["D1", "a//", "b.PDF", "PDF", "F2", "o", "3"]]})
    rows = inventory.inventory(inventory.read_inventory(spark, str(tmp_path / "inv.xlsx"))).collect()
    assert (rows[0].doc_id, rows[0].ruta_relativa, rows[0].fenomeno) == ("D1", "a/b.PDF", 2)
    workbook(tmp_path / "two.xlsx", {"Notas": [["x"]], "Inventario": [list(inventory.COLUMNS), ["D9", "a", "b.pdf", "PDF", "F2", "o", "3"]]})
    named = inventory.read_inventory(spark, str(tmp_path / "two.xlsx"), "Inventario")
    assert named.first().DOC_ID == "D9"
    with pytest.raises(ValueError, match="no sheet"):
        inventory.read_inventory(spark, str(tmp_path / "two.xlsx"), "Otra")


def test_tile_numbers():
    data = tile({"l": [{"n": -3, "f": 0.25, "t": False, "s": "ñ"}]})
    props = decoders.decode_tile(data, "")["features"][0]["props"]
    assert [p["v"] for p in props] == ["-3", "0.25", "False", "ñ"]


def documents(spark, ids):
    rows = [(f"d{i}", f"src{i}", "txt", "en", f"Topic {i} first. Word{i} again.", "ok", 1) for i in ids]
    return spark.createDataFrame(rows, "doc_id string, fuente string, formato string, idioma string, texto string, "
                                       "estado string, fenomeno bigint")


def test_chunks_index_answers(spark, tmp_path):
    docs, chunks, index = f"{tmp_path}/docs", f"{tmp_path}/chunked", f"{tmp_path}/index"
    documents(spark, range(3)).unionByName(
        documents(spark, [9]).withColumn("texto", F.lit(" "))).write.parquet(docs)
    B.build_chunks(spark, docs, chunks)
    documents(spark, range(3, 6)).write.mode("append").parquet(docs)
    B.build_chunks(spark, docs, chunks)
    table = B.read_chunks(spark, chunks)
    assert table.count() == 6 and spark.read.parquet(f"{chunks}/empty").count() == 1
    assert set(f.name for f in schemas.CHUNKS) == set(table.columns)
    enc = encode.HashingEncoder(64)
    B.build_index(spark, table, f"{tmp_path}/cache", index, enc)
    B.build_index(spark, table, f"{tmp_path}/cache", index, enc)
    assert spark.read.parquet(f"{tmp_path}/cache").count() == 6
    vectors, metadata = load_index(spark, index, enc.encoder_id)
    assert sorted(r.row_id for r in vectors.collect()) == list(range(6))
    asked = spark.createDataFrame([("q1", "Word4 again"), ("q2", "topic 2")], "query_id string, texto string")
    answers = B.answer_queries(spark, asked, index, enc)
    sinks.write_answers(answers, f"{tmp_path}/answers")
    back = {r.query_id: r for r in spark.read.schema(schemas.ANSWER).json(f"{tmp_path}/answers").collect()}
    assert back["q1"].documents[0].doc_id == "d4" and len(back["q2"].documents) == 3
    assert back["q2"].fragments[0].text == "Topic 2 first. Word2 again."
    found = B.search_queries(spark, asked, index, enc, k=2)
    assert found.count() == 4 and "score" in found.columns
    export_metadata(metadata, f"{tmp_path}/meta")
    assert spark.read.json(f"{tmp_path}/meta").first().chunk_id == "d0_chunk_00000"
    with pytest.raises(ValueError, match="made by hashing-64"):
        load_index(spark, index, "other")
    # The pooled rows name the folders that metadata is read from.
    pool = spark.createDataFrame([("q", 1, 1, 0.5)], "query_id string, rank long, row_id long, score double")
    plan = retrieve.with_metadata(pool, metadata, "row_id", 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(row_range" in plan and "(row_range" in plan.split("PartitionFilters")[1][:120]
    # A manifest is added, never overwritten; the highest number counts.
    numbers = sorted(r.number for r in spark.read.json(f"{index}/manifest").collect())
    assert numbers == [1, 2]
    blank = table.withColumn("fuente", F.when(F.col("doc_id") == "d1", " ").otherwise(F.col("fuente")))
    with pytest.raises(ValueError, match="1 chunks with an empty fuente"):
        B.build_index(spark, blank, f"{tmp_path}/cache2", index, enc)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(f"{tmp_path}/cache2")
    other = encode.HashingEncoder(32)
    B.encode_chunks(spark, table, f"{tmp_path}/cache", other, batches=3)
    B.encode_chunks(spark, table, f"{tmp_path}/cache", enc, force=True)
    made = spark.read.parquet(f"{tmp_path}/cache").groupBy("encoder_id").count().collect()
    assert {(r.encoder_id, r["count"]) for r in made} == {("hashing-64", 6), ("hashing-32", 6)}
    B.build_chunks(spark, docs, chunks, restart=True, batches=2)
    assert B.read_chunks(spark, chunks).count() == 6
    backup = next(p for p in (tmp_path / "chunked").iterdir() if p.name.startswith("backup-"))
    assert spark.read.parquet(f"{backup}/chunks").count() == 6
    metadata.filter("row_id > 0").write.mode("overwrite").parquet(f"{tmp_path}/broken/metadata")
    vectors.write.parquet(f"{tmp_path}/broken/vectors")
    with pytest.raises(ValueError, match="6 vectors, 5 records"):
        load_index(spark, f"{tmp_path}/broken")
    assert alignment(vectors, metadata).first().unmatched == 0


def test_stream_takes_new_files_once(spark, tmp_path):
    src, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def advance():
        stream = incremental.document_stream(spark, src, documents(spark, [0]).schema)
        incremental.append_available(incremental.chunk_stream(stream), out, state).awaitTermination()
        return sorted(r.doc_id for r in spark.read.parquet(out).collect())

    documents(spark, [0, 1]).write.parquet(src)
    assert advance() == ["d0", "d1"]
    assert advance() == ["d0", "d1"]
    documents(spark, [2]).write.mode("append").parquet(src)
    assert advance() == ["d0", "d1", "d2"]


def test_the_stream_query_takes_a_table_of_many_files(spark, tmp_path):
    rows = [(i, f"Text number {i}. And more.", "en") for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    # Another table beside it, also a folder, is not read.
    table.write.parquet(f"{tmp_path}/many/pages.parquet")
    table.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    (tmp_path / "one").mkdir()
    table.toPandas().to_parquet(tmp_path / "one" / "documents.parquet")
    for name in ("many", "one"):
        got = stream_queries.stream_chunks(spark, f"{tmp_path}/{name}").collect()
        assert sorted((r.doc_id, r.posicion, r.texto) for r in got) == [(str(i), 0, text) for i, text, _ in rows]
    assert stream_queries.stream_chunks(spark, f"{tmp_path}/none").collect() == []


def test_line_stream_drops_torn_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = json.dumps({"doc_id": "a", "estado": "ok", "texto": "One. Two.", "idioma": "en"})
    (tmp_path / "in" / "x.jsonl").write_text(good + "\n" + good[:25] + "\n")
    rows = incremental.chunk_stream(incremental.line_stream(spark, f"{tmp_path}/in"))
    incremental.append_available(rows, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert [r.texto for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["One. Two."]
