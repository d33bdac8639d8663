"""The command line from an inventory to answers."""

import json

from docloom import cli


def test_all_commands(spark, tmp_path):
    (tmp_path / "c" / "f").mkdir(parents=True)
    lines = ["DOC_ID,Carpeta,Nombre estandarizado,Tipo,Fenómeno,Observatorio,Código Observatorio"]
    for i, word in enumerate(["river", "boat", "night"]):
        (tmp_path / "c" / "f" / f"{word}.txt").write_text(f"The {word} is calm. Nobody sees the {word}.")
        lines.append(f"D{i},f,{word}.txt,Texto,F{i + 1},obs,1")
    (tmp_path / "inv.csv").write_text("\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    base = ["extract", "--inventario", str(tmp_path / "inv.csv"), "--corpus", str(tmp_path / "c"), "--salida", out]
    cli.main([*base, "--limite", "2"])
    assert spark.read.parquet(f"{out}/documentos").count() == 2
    cli.main(base)
    (tmp_path / "c" / "f" / "boat.txt").write_text("The boat is red. Nobody sees the boat.")
    cli.main([*base, "--reiniciar", "--lotes", "2"])
    assert spark.read.parquet(f"{out}/documentos").count() == 3
    # A plain run goes on with the restarted log.
    cli.main(base)
    texts = {r.doc_id: r.texto for r in spark.read.parquet(f"{out}/documentos").collect()}
    assert texts["D1"].startswith("The boat is red") and (tmp_path / "out" / "log").exists()
    cli.main(["chunk", "--input", f"{out}/documentos", "--output", f"{out}/chunks"])
    index = ["--index-dir", f"{out}/index"]
    cli.main(["index", "--input", f"{out}/chunks", "--output-dir", f"{out}/index", "--embeddings-cache", f"{out}/cache"])
    (tmp_path / "q.jsonl").write_text(json.dumps({"query_id": "q1", "texto": "boat"}) + "\n")
    cli.main(["search", *index, "--queries", str(tmp_path / "q.jsonl"), "--output", f"{out}/found"])
    assert spark.read.json(f"{out}/found").first().doc_id == "D1"
    cli.main(["answer", *index, "--queries", str(tmp_path / "q.jsonl"), "--output", f"{out}/answers"])
    answer = spark.read.json(f"{out}/answers").first()
    assert [d.doc_id for d in answer.documents][0] == "D1" and len(answer.fragments) == 3
    (tmp_path / "s.jsonl").write_text(json.dumps({"query_id": "q1", "texto": "boat", "fenomeno": 2}) + "\n")
    cli.main(["sanity", *index, "--queries", str(tmp_path / "s.jsonl"), "--output", f"{out}/sanity"])
    rows = spark.read.json(f"{out}/sanity").orderBy("rank").collect()
    assert rows[0].doc_id == "D1" and rows[0].match and rows[0].preview.startswith("The boat")
