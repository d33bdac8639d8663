"""Inventory to the document table."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as V
from docloom import schemas
from docloom.functions import text as X
from docloom.functions.arrays import explode_items
from docloom.functions.language import unknown_language
from docloom.operators.compact import latest_wins, out_of_memory, pending
from docloom.operators.json_documents import json_documents
from docloom.operators.pages import joined_pages, strip_page_array
from docloom.operators.tiles import feature_owners, losing_tiles, tile_documents
from docloom.plans import log_table
from docloom.plans.isolate import FAILURES, isolated
from docloom.session import cut_lineage
from docloom.sources.decoders import Decoders, decode_files, spread_files
from docloom.sources.inventory import is_tile, reader
from docloom.sources.text_files import text_documents


def sheets_text(sheets: Column | str) -> Column:
    """Rows as ``column: value | ...`` lines; sheets of a larger book under their names."""

    def row_line(columns: Column, row: Column) -> Column:
        cells = F.zip_with(
            columns, row, lambda n, v: F.when(~n.startswith(V.UNNAMED_COLUMN), X.pair(n, v))
        )
        return F.array_join(F.filter(cells, lambda c: c.isNotNull()), " | ")

    def sheet_text(sheet: Column) -> Column:
        lines = F.transform(sheet["rows"], lambda r: row_line(sheet["columns"], r))
        body = F.array_join(F.filter(lines, lambda t: t != ""), "\n")
        headed = F.concat(F.lit("Hoja: "), sheet["name"], F.lit("\n"), body)
        return F.when(body == "", "").when(F.size(sheets_col) > 1, headed).otherwise(body)

    sheets_col = X.col(sheets)
    return F.array_join(F.filter(F.transform(sheets_col, sheet_text), lambda t: t != ""), "\n\n")


def _tables(files: DataFrame, kind: str, decoders: Decoders | None) -> DataFrame:
    read = decode_files(files, kind, decoders)
    rows = F.aggregate("sheets", F.lit(0), lambda n, s: n + F.size(s["rows"]))
    return read.withColumn("texto", sheets_text("sheets")).withColumn(
        "filas_totales", rows.cast("bigint")
    ).drop("sheets")


def _json(files: DataFrame, decoders: Decoders | None) -> DataFrame:
    read = decode_files(files, "json", decoders).withColumnsRenamed({"estado": "_failed", "detalle": "_why"})
    made = json_documents(read)
    return (
        made.withColumn("estado", F.coalesce("_failed", "estado"))
        .withColumn("detalle", F.coalesce("_why", "detalle"))
        .drop("_failed", "_why")
    )


def _texts(files: DataFrame, decoders: Decoders | None) -> DataFrame:
    read = decode_files(files, "txt", decoders).withColumnRenamed("estado", "_failed")
    made = text_documents(read)
    return made.withColumn("estado", F.coalesce("_failed", "estado")).drop("_failed")


def _images(files: DataFrame, decoders: Decoders | None) -> DataFrame:
    useful = X.word_count("raw") >= V.OCR_MIN_WORDS
    state = F.coalesce(F.col("estado"), F.when(useful, "ok").otherwise("sin_texto_relevante"))
    read = decode_files(files, "image", decoders)
    return read.withColumn("texto", F.when(useful, F.col("raw"))).withColumn("estado", state).drop("raw")


def _pdfs(files: DataFrame, decoders: Decoders | None) -> DataFrame:
    """Text layer first; only documents with a poor one are read by OCR."""
    # A document is used twice, as it is and to find those that OCR reads.
    read = cut_lineage(
        decode_files(files, "pdf", decoders)
        .withColumn("titulo", X.document_title("raw"))
        .withColumn("n_paginas", F.size("pages").cast("bigint"))
        .withColumn("_pages", strip_page_array("pages"))
        .drop("pages", "raw")
    )
    native = read.withColumn("texto", joined_pages("_pages")).drop("_pages")
    poor = X.needs_ocr(F.length(F.coalesce("texto", F.lit(""))), "n_paginas")
    wanted = files.join(native.filter(poor).select("doc_id"), "doc_id", "left_semi")
    scanned = cut_lineage(decode_files(wanted, "scanned", decoders))
    ocr = scanned.withColumn("_pages", F.transform("pages", X.rebuild_paragraphs)).select(
        "doc_id", F.col("detalle").alias("_ocr_error"), joined_pages("_pages").alias("_ocr")
    )
    both = native.join(ocr, "doc_id", "left")
    tried = poor & F.col("estado").isNull()
    good = X.ocr_accepted(F.coalesce("_ocr", F.lit("")), "n_paginas")
    note = (
        F.when(F.startswith("_ocr_error", F.lit(V.NO_DECODER_DETAIL)), F.col("_ocr_error"))
        .when(F.col("_ocr_error").isNotNull(), X.error_detail("_ocr_error"))
        .when(good, V.OCR_DETAIL).otherwise(V.OCR_POOR_DETAIL)
    )
    return (
        both.withColumn("detalle", F.when(tried, note).otherwise(F.col("detalle")))
        .withColumn("_text", F.when(tried & good, F.col("_ocr")).otherwise(F.col("texto")))
        .withColumn(
            "estado",
            F.coalesce("estado", F.when(X.is_blank(F.coalesce("_text", F.lit(""))), "sin_texto_extraible").otherwise("ok")),
        )
        .drop("texto", "_ocr", "_ocr_error")
        .withColumnRenamed("_text", "texto")
    )


def _tiles(files: DataFrame, decoders: Decoders | None) -> DataFrame:
    """All tiles together: what a tile keeps depends on the tiles before it."""
    return _tile_rows(cut_lineage(decode_files(files, "pbf", decoders)))


def _tile_features(read: DataFrame) -> DataFrame:
    return explode_items(
        read.withColumnRenamed("ruta_relativa", "path"), ["path"], "features", "pos", "f"
    ).select("path", "f.*")


def _tile_rows(read: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    good = read.filter(F.col("estado").isNull()).withColumnRenamed("ruta_relativa", "path")
    made = tile_documents(_tile_features(read), good, owners).withColumnRenamed("path", "ruta_relativa")
    rest = read.drop("features")
    return rest.filter(F.col("estado").isNull()).drop("estado", "detalle").join(
        made, "ruta_relativa"
    ).unionByName(rest.filter(F.col("estado").isNotNull()), allowMissingColumns=True)


def finish(documents: DataFrame, language=unknown_language) -> DataFrame:
    """Clean the text, derive its measures, and put the row in the document schema."""
    full = documents.select(
        *[(F.col(f.name) if f.name in documents.columns else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in schemas.DOCUMENTS]
    )
    cleaned = full.withColumn("texto", X.clean_document("texto"))
    return cleaned.select(
        *[
            {
                "n_caracteres": X.char_count("texto"),
                "n_palabras": X.word_count("texto"),
                "idioma": language(F.col("texto")),
                "hash_sha1": X.sha1_hex("texto"),
                "truncado": F.coalesce("truncado", F.lit(False)),
                "estado": X.status(
                    F.coalesce("estado", F.when(X.is_blank("texto"), "vacio").otherwise("ok")), "texto"
                ),
            }.get(c, F.col(c)).alias(c)
            for c in V.DOCUMENT_COLUMNS
        ]
    )


def extract(
    inventory: DataFrame, done: DataFrame | None = None, language=unknown_language,
    tasks: int | None = None, decoders: Decoders | None = None, kinds: set[str] | None = None,
) -> DataFrame:
    """Document rows of the inventory's pending files, one branch per reader.

    ``kinds`` names the readers that the files need, if the caller knows; the others get no branch.  Tiles are all read again as soon as one is pending, because what each of them
    keeps depends on the others.
    """
    routed = inventory.withColumn("formato", X.extension("ruta_relativa")).withColumn(
        "_reader", reader("tipo_adl", "ruta_relativa")
    )
    todo = pending(routed, done) if done is not None else routed
    tiles = routed.join(
        # One row or none.
        F.broadcast(todo.filter(F.col("_reader") == "pbf").select("_reader").distinct()),
        "_reader", "left_semi",
    )
    tasks = tasks or int(inventory.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def files(kind: str) -> DataFrame:
        source = tiles if kind == "pbf" else todo
        return spread_files(source.filter(F.col("_reader") == kind).drop("_reader", "pos"), tasks)

    def unsupported() -> DataFrame:
        rows = todo.filter(F.col("_reader") == "unsupported").drop("_reader", "pos")
        return rows.withColumn("estado", F.lit("formato_no_soportado")).withColumn("detalle", F.col("formato"))

    branches = {
        "pdf": lambda: _pdfs(files("pdf"), decoders), "json": lambda: _json(files("json"), decoders),
        "csv": lambda: _tables(files("csv"), "csv", decoders), "xlsx": lambda: _tables(files("xlsx"), "xlsx", decoders),
        "txt": lambda: _texts(files("txt"), decoders), "image": lambda: _images(files("image"), decoders),
        "pbf": lambda: _tiles(files("pbf"), decoders), "unsupported": unsupported,
    }
    wanted = [branch() for kind, branch in branches.items() if not kinds or kind in kinds]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wanted)
    return finish(rows, language)


def readers(inventory: DataFrame) -> set[str]:
    """The readers that the files need, a handful at most."""
    return {r[0] for r in inventory.select(reader("tipo_adl", "ruta_relativa")).distinct().collect()}


def lost_rows(inventory: DataFrame, written: DataFrame) -> DataFrame:
    """Error rows for inventory files that no pass has written."""
    return failed_rows(pending(inventory, written), V.LOST_DETAIL)


def failed_rows(inventory: DataFrame, detail: str) -> DataFrame:
    return finish(
        inventory.withColumn("formato", X.extension("ruta_relativa"))
        .withColumn("estado", F.lit("error")).withColumn("detalle", F.lit(detail))
    )


LOG = T.StructType([*schemas.DOCUMENTS.fields, *(T.StructField(n, T.LongType()) for n in ("seq", "intentos"))])
#: Files of a batch when the number of batches is not given, and runs that try a file again which failed alone.
FILES_PER_BATCH, RUNS = 500, 3


def _written(spark: SparkSession, log: str) -> DataFrame:
    try:
        return spark.read.schema(LOG).parquet(log)
    except AnalysisException:  # no pass has been written yet
        return spark.createDataFrame([], LOG)


def _stored(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def settled(log: DataFrame, runs: int = RUNS) -> DataFrame:
    """Keys that need no further run: those whose latest row is not that of a file which failed alone, or has been so ``runs`` times."""
    lost = F.startswith(F.coalesce("detalle", F.lit("")), F.lit(V.LOST_DETAIL))
    times = log.where(lost).groupBy("doc_id").agg(F.count("*").alias("_times"))
    again = latest_wins(log).where(lost).join(times, "doc_id").where(F.col("_times") < runs)
    return log.select("doc_id").distinct().join(again.select("doc_id"), "doc_id", "left_anti")


def run(
    spark: SparkSession, inventory: DataFrame, log: str, out: str, language=unknown_language,
    decoders: Decoders | None = None, batches: int | None = None,
) -> None:
    """Append passes to the log folder and compact them to ``out``, latest row wins, in buckets of which only the touched ones are rewritten.

    A first pass takes the pending files in ``batches`` by a hash of the id, each a committed
    write, so an interrupted run repeats at most one of them; by default a batch has about
    FILES_PER_BATCH files.  A batch that fails (a file killed its worker) is halved until the file is alone, which
    gets an ``error`` row; ``intentos`` of the log says how often a row's file was tried in the run.  A second
    pass takes in the same way what ran out of memory, a last one writes an error row for anything
    lost.  Files that failed alone are tried again, apart from the others, by the next RUNS - 1 runs.
    A failure that is no file's fault, such as a full disk, ends the run; what was committed stays.
    """
    before = _written(spark, log)
    number = before.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]

    def append(rows: DataFrame, step: int, tries: int = 1) -> None:
        marks = {"seq": F.lit(number + step).cast("bigint"), "intentos": F.lit(tries).cast("bigint")}
        rows.withColumns(marks).write.mode("append").parquet(log)

    def healthy() -> None:
        append(spark.createDataFrame([], schemas.DOCUMENTS), 0)

    def parts(files: DataFrame) -> int:
        return batches or max(1, -(-files.count() // FILES_PER_BATCH))

    def passed(files: DataFrame, step: int, cut: int) -> None:
        kinds = readers(files)
        if not kinds:
            return

        def alone(rows: DataFrame, tries: int, error: Exception) -> None:
            warnings.warn(f"a file failed alone at try {tries}: {str(error)[:300]}", stacklevel=2)
            append(failed_rows(rows, V.LOST_DETAIL), step, tries)

        def work(rows: DataFrame, tries: int) -> None:
            append(extract(rows, None, language, decoders=decoders, kinds=kinds), step, tries)

        isolated(files, work, alone, healthy, cut)

    tile = is_tile("ruta_relativa")
    todo = cut_lineage(pending(inventory, settled(before)))
    suspects = todo.join(before.select("doc_id").distinct(), "doc_id", "left_semi")
    fresh = todo.join(before.select("doc_id").distinct(), "doc_id", "left_anti")
    passed(fresh.where(~tile), 1, parts(fresh))
    if todo.where(tile).limit(1).count():
        tiles, owners = inventory.where(tile), f"{log}-duenos"
        # Without a table of owners (a log from before it) all tiles are fresh.
        fresh_tiles = todo.where(tile) if _stored(spark, owners) else tiles
        _tile_pass(spark, fresh_tiles, tiles, owners, append, healthy, language, decoders)
    passed(suspects.where(~tile), 1, max(1, suspects.count()))
    failed = out_of_memory(_written(spark, log))
    passed(cut_lineage(inventory.where(~tile).join(failed, "doc_id", "left_semi")), 2, 1)
    append(lost_rows(inventory, _written(spark, log)), 3)
    log_table.compact(spark, _written(spark, log), out, V.DOCUMENT_COLUMNS, number)


def _tile_pass(
    spark: SparkSession, fresh: DataFrame, tiles: DataFrame, owners: str, append, healthy, language, decoders: Decoders | None,
) -> None:
    """The fresh tiles as one batch, and the tiles that lose a feature to one of them.

    ``owners`` is a folder of feature owners, to which each run adds rows before it writes documents: a
    run that died between finds the same losing tiles again.  If the batch fails, the tiles
    that no decoding survives are left out; only decoding runs foreign bytes, so halving the decoding finds them.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def decoded(rows: DataFrame) -> DataFrame:
        named = rows.drop("pos").withColumn("formato", X.extension("ruta_relativa"))
        return cut_lineage(decode_files(spread_files(named, tasks), "pbf", decoders))

    def write(rows: DataFrame, tries: int = 1) -> None:
        read = decoded(rows)
        new = _tile_features(read)
        feature_owners(new).write.mode("append").parquet(owners)
        stored = spark.read.parquet(owners)
        losing = losing_tiles(new, stored).withColumnRenamed("path", "ruta_relativa")
        again = decoded(tiles.join(losing, "ruta_relativa", "left_semi"))
        append(finish(_tile_rows(read.unionByName(again), stored), language), 1, tries)

    try:
        write(fresh)
        return
    except FAILURES:
        healthy()
    bad: list[str] = []

    def decode(rows: DataFrame, tries: int) -> None:
        decode_files(spread_files(rows.drop("pos"), 1), "pbf", decoders).write.format("noop").mode("overwrite").save()

    def alone(rows: DataFrame, tries: int, error: Exception) -> None:
        warnings.warn(f"a tile failed alone at try {tries}: {str(error)[:300]}", stacklevel=2)
        append(failed_rows(rows, V.LOST_DETAIL), 1, tries)
        bad.extend(r.doc_id for r in rows.select("doc_id").collect())

    isolated(fresh, decode, alone, healthy)
    write(fresh.where(~F.col("doc_id").isin(bad)), 2)
