"""Command line: spark-submit docloom/cli.py <extract|chunk|index|search|answer|sanity> ...

Settings of the cluster (executors, memory, shuffle partitions) belong to spark-submit.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.errors import AnalysisException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from docloom.functions.tokens import rank_counter  # noqa: E402
from docloom.operators import encode, retrieve  # noqa: E402
from docloom.functions.segment import by_language  # noqa: E402
from docloom.functions.language import trigram_detector, trigram_profiles, unknown_language  # noqa: E402
from docloom.plans import build_index, extract, log_table  # noqa: E402
from docloom.session import SETTINGS  # noqa: E402
from docloom.sources import sinks  # noqa: E402
from docloom.sources.inventory import inventory, read_inventory  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docloom")
    commands = parser.add_subparsers(dest="command", required=True)

    one = commands.add_parser("extract", help="inventory to documents")
    one.add_argument("--inventario", required=True, help="CSV, Parquet or XLSX inventory")
    one.add_argument("--corpus", default="", help="folder the inventory's paths start from")
    one.add_argument("--limite", type=int, help="stratified sample of about this many files")
    one.add_argument("--formatos", nargs="*", help="inventory types to take")
    one.add_argument("--salida", required=True)
    one.add_argument("--reiniciar", action="store_true", help="start a new log, keep the old one")
    one.add_argument("--hoja", help="sheet of an XLSX inventory, else the first")
    one.add_argument("--idiomas", help="Parquet of labelled texts (texto, idioma) to learn languages from")
    one.add_argument("--decoders", help="module:name of a table of decoders for PDF, scanned pages and images")

    two = commands.add_parser("chunk", help="documents to chunks")
    two.add_argument("--input", required=True)
    two.add_argument("--output", required=True)
    two.add_argument("--reiniciar", action="store_true", help="chunk anew, keep a backup")
    two.add_argument("--tokens", help="rank file of a byte-pair vocabulary that counts tokens, else words are counted")

    two.add_argument("--segmenter", help="module:name of a segmenter, else sentences are cut by language")

    three = commands.add_parser("index", help="chunks to a searchable index")
    three.add_argument("--input", required=True, help="output folder of chunk")
    three.add_argument("--output-dir", required=True)
    three.add_argument("--embeddings-cache", required=True)
    three.add_argument("--force-encode", action="store_true")

    for name, k in (("search", 5), ("answer", 30)):
        ask = commands.add_parser(name, help="queries to " + ("chunks" if k == 5 else "answers"))
        ask.add_argument("--index-dir", required=True)
        ask.add_argument("--queries", required=True, help="JSON lines with query_id and texto")
        ask.add_argument("--output", required=True)
        ask.add_argument("--k", type=int, default=k)
    for name in ("index", "search", "answer"):
        commands.choices[name].add_argument(
            "--encoder", default="hashing", help="hashing, or module:name of an encoder"
        )
    for name in ("extract", "chunk", "index"):
        commands.choices[name].add_argument(
            "--lotes", type=int, default=None if name == "extract" else 8,
            help="commit the work in so many batches; by default extract chooses by the number of files",
        )

    check = commands.add_parser("sanity", help="what the first hits of a query look like")
    check.add_argument("--index-dir", required=True)
    check.add_argument("--queries", required=True, help="JSON lines with query_id, texto and fenomeno")
    check.add_argument("--output", required=True)
    check.add_argument("--k", type=int, default=3)
    check.add_argument("--encoder", default="hashing")
    return parser


def _named(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _encoder(name: str) -> encode.Encoder:
    return encode.HashingEncoder() if name == "hashing" else _named(name)


def _log(spark: SparkSession, folder: str, restart: bool) -> str:
    """The log later runs go on with; a restart begins a new one and keeps the old."""
    pointer = f"{folder}/log_actual"
    try:
        name = spark.read.text(pointer).first().value
    except AnalysisException:
        name = "log"
    if restart:
        name = f"log-{int(spark.sql('SELECT unix_millis(now())').first()[0])}"
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(pointer)
    return f"{folder}/{name}"


def _extract(spark: SparkSession, args: argparse.Namespace) -> None:
    wanted = inventory(
        read_inventory(spark, args.inventario, args.hoja), args.corpus, args.formatos, args.limite
    )
    language = unknown_language
    if args.idiomas:
        language = trigram_detector(trigram_profiles(spark.read.parquet(args.idiomas)))
    log = _log(spark, args.salida, args.reiniciar)
    extract.run(
        spark, wanted, log, f"{args.salida}/documentos", language,
        _named(args.decoders) if args.decoders else None, args.lotes,
    )
    documents = log_table.read(spark, f"{args.salida}/documentos")
    sinks.write_metadata_csv(documents, f"{args.salida}/documentos_metadata")
    sinks.write_errors_csv(documents, f"{args.salida}/errores")
    sinks.write_summary(documents, f"{args.salida}/resumen")


def _queries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("query_id STRING, texto STRING").json(path)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName("docloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.command == "extract":
        _extract(spark, args)
    elif args.command == "chunk":
        count = rank_counter(spark, args.tokens) if args.tokens else None
        build_index.build_chunks(
            spark, args.input, args.output, args.reiniciar, batches=args.lotes, count_tokens=count,
            segmenter=_named(args.segmenter) if args.segmenter else by_language,
        )
        sinks.write_chunking_errors_csv(build_index.read_chunk_errors(spark, args.output), f"{args.output}/errores_chunking")
    elif args.command == "index":
        build_index.build_index(
            spark, build_index.read_chunks(spark, args.input), args.embeddings_cache,
            args.output_dir, _encoder(args.encoder), args.force_encode, args.lotes,
        )
    elif args.command == "sanity":
        asked = spark.read.schema("query_id STRING, texto STRING, fenomeno INT").json(args.queries)
        found = build_index.search_queries(spark, asked, args.index_dir, _encoder(args.encoder), args.k)
        wanted = asked.select("query_id", F.col("fenomeno").alias("_expected"))
        rows = retrieve.sanity_rows(found.join(wanted, "query_id", "left"), F.col("_expected"))
        rows.orderBy("query_id", "rank").write.mode("overwrite").json(args.output)
    elif args.command == "search":
        found = build_index.search_queries(
            spark, _queries(spark, args.queries), args.index_dir, _encoder(args.encoder), args.k
        )
        found.orderBy("query_id", F.col("rank")).write.mode("overwrite").json(args.output)
    else:
        sinks.write_answers(
            build_index.answer_queries(
                spark, _queries(spark, args.queries), args.index_dir, _encoder(args.encoder), args.k
            ),
            args.output,
        )


if __name__ == "__main__":
    main()
