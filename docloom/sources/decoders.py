"""Files to decoded content, inside tasks.

The inventory's paths are spread over tasks and every worker opens one file at a
time, so file contents are neither shuffled nor joined and memory holds one file.
Decoding stops at structure (pages, cells, tile features, raw text); everything
after that is an expression.  A file that fails becomes an ``error`` row.

Formats that need a library of their own (PDF, scanned pages, images) have no decoder here:
callers pass theirs in a ``Decoders`` table.  Without one a file gets the state that says so.
"""

from __future__ import annotations

import codecs
import csv
import io
import time
import zipfile
from collections.abc import Callable, Iterator, Mapping
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docloom import fixed_values as V

_SAMPLE = 200_000
STRINGS = T.ArrayType(T.StringType())
SHEETS = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("columns", STRINGS),
            T.StructField("rows", T.ArrayType(STRINGS)),
        ]
    )
)
FEATURES = T.ArrayType(
    T.StructType(
        [
            T.StructField("layer", T.StringType()),
            T.StructField("layer_pos", T.LongType()),
            T.StructField("feature_pos", T.LongType()),
            T.StructField(
                "props",
                T.ArrayType(
                    T.StructType([T.StructField(n, T.StringType()) for n in ("k", "v")])
                ),
            ),
        ]
    )
)


def read_bytes(path: str) -> bytes:
    if "://" in path:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        with system.open_input_stream(inner) as stream:
            return stream.read()
    with open(path, "rb") as file:
        return file.read()


def _text(data: bytes) -> tuple[str, str]:
    """(text, encoding): UTF-16 or -32 where a byte order mark says so, strict UTF-8, else Latin-1, in which every byte is a letter."""
    # The mark of UTF-32 begins with that of UTF-16.
    for encoding, marks in (("utf-32", (codecs.BOM_UTF32_LE, codecs.BOM_UTF32_BE)), ("utf-16", (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE))):
        if data.startswith(marks):
            try:
                return data.decode(encoding), encoding
            except UnicodeDecodeError:
                break
    try:
        return data.decode("utf-8-sig"), "utf-8"
    except UnicodeDecodeError:
        return data.decode("latin-1"), "latin-1"


def decode_text(data: bytes, path: str) -> dict:
    text, encoding = _text(data)
    return {"raw": text, "detalle": V.LATIN_DETAIL if encoding == "latin-1" else None}


def decode_json(data: bytes, path: str) -> dict:
    return {"raw": data.decode("utf-8")}


_DELIMITERS = ",;\t|"


def _delimiter(text: str) -> str:
    """The delimiter that cuts the first lines into most cells, the same number in each."""
    head = [line for line in text[:_SAMPLE].splitlines()[:20] if line.strip()]

    def strength(mark: str) -> tuple[int, int]:
        widths = [len(row) for row in csv.reader(head, delimiter=mark)]
        return (widths.count(widths[0]), widths[0]) if widths and widths[0] > 1 else (0, 0)

    return max(_DELIMITERS, key=strength)


def decode_csv(data: bytes, path: str) -> dict:
    """A table whose encoding and delimiter are found by looking at it.

    Rows longer than the header are left out, shorter ones are filled up; blank cells are NULL.
    """
    csv.field_size_limit(1 << 30)
    text, encoding = _text(data)
    rows = csv.reader(io.StringIO(text, newline=""), delimiter=_delimiter(text))
    names = next((r for r in rows if any(c.strip() for c in r)), [])
    columns = [n.strip() or f"{V.UNNAMED_COLUMN} {i}" for i, n in enumerate(names)]
    cells = [
        [c or None for c in row] + [None] * (len(columns) - len(row))
        for row in rows
        if row and len(row) <= len(columns)
    ]
    return {
        "sheets": [{"name": "", "columns": columns, "rows": cells}],
        "detalle": V.LATIN_DETAIL if encoding == "latin-1" else None,
    }


def decode_xlsx(data: bytes, path: str) -> dict:
    return {"sheets": _plain_sheets(data)}


def _plain_sheets(data: bytes) -> list[dict]:
    """Sheets of a workbook without its library: values as stored, dates as numbers."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    sheets = []
    with zipfile.ZipFile(io.BytesIO(data)) as book:

        def tree(name: str):
            return ElementTree.fromstring(book.read(name))

        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [
                "".join(t.text or "" for t in item.iter(f"{main}t"))
                for item in tree("xl/sharedStrings.xml").iter(f"{main}si")
            ]
        targets = {r.get("Id"): r.get("Target") for r in tree("xl/_rels/workbook.xml.rels")}
        for sheet in tree("xl/workbook.xml").iter(f"{main}sheet"):
            target = targets[sheet.get(link)].lstrip("/")
            grid = [
                {_column(c.get("r")): _cell_text(c, main, shared) for c in row.iter(f"{main}c")}
                for row in tree(target if target.startswith("xl/") else f"xl/{target}").iter(f"{main}row")
            ]
            width = max((max(r, default=-1) for r in grid), default=-1) + 1
            head = grid[0] if grid else {}
            sheets.append(
                {
                    "name": sheet.get("name"),
                    "columns": [head.get(i) or f"{V.UNNAMED_COLUMN} {i}" for i in range(width)],
                    "rows": [[r.get(i) for i in range(width)] for r in grid[1:]],
                }
            )
    return sheets


def _column(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def _cell_text(cell, main: str, shared: list[str]) -> str | None:
    kind, value = cell.get("t"), cell.find(f"{main}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{main}t"))
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    return {"1": "True", "0": "False"}[value.text] if kind == "b" else value.text


def xlsx_inventory(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet of an inventory workbook, one file by definition: the named one, else the first."""
    sheets = decode_xlsx(read_bytes(path), path)["sheets"]
    chosen = next((s for s in sheets if sheet is None or s["name"] == sheet), None)
    if chosen is None:
        raise ValueError(f"{path} has no sheet {sheet}: {', '.join(s['name'] for s in sheets)}")
    names = [*chosen["columns"], "pos"]
    rows = [[*r, i] for i, r in enumerate(chosen["rows"])]
    schema = ", ".join(f"`{n}` STRING" for n in names[:-1]) + ", pos BIGINT"
    return spark.createDataFrame(rows, schema)


def _varint(data: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: memoryview) -> Iterator[tuple[int, int, int | memoryview]]:
    """(number, wire type, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, kind, value


def _tile_value(data: memoryview) -> str | None:
    """Printed value of a tile property, by the field its message uses."""
    import struct

    for number, _, value in _fields(data):
        if number == 1:
            return bytes(value).decode("utf-8")
        if number in (2, 3):
            return str(struct.unpack("<f" if number == 2 else "<d", value)[0])
        if number in (4, 5):
            return str(value - (1 << 64) if number == 4 and value >> 63 else value)
        if number == 6:
            return str((value >> 1) ^ -(value & 1))
        if number == 7:
            return str(bool(value))
    return None


def decode_tile(data: bytes, path: str) -> dict:
    """Features of a vector tile with their properties in stored order."""
    features = []
    layers = [v for n, _, v in _fields(memoryview(data)) if n == 3]
    for layer_pos, layer in enumerate(layers):
        parts = list(_fields(layer))
        name = next((bytes(v).decode("utf-8") for n, _, v in parts if n == 1), "")
        keys = [bytes(v).decode("utf-8") for n, _, v in parts if n == 3]
        values = [_tile_value(v) for n, _, v in parts if n == 4]
        for feature_pos, feature in enumerate(v for n, _, v in parts if n == 2):
            tags: list[int] = []
            for number, kind, value in _fields(feature):
                if number != 2:
                    continue
                at = 0
                while kind == 2 and at < len(value):
                    tag, at = _varint(value, at)
                    tags.append(tag)
                if kind == 0:
                    tags.append(value)
            props = [{"k": keys[k], "v": values[v]} for k, v in zip(tags[::2], tags[1::2])]
            features.append(
                {"layer": name, "layer_pos": layer_pos, "feature_pos": feature_pos, "props": props}
            )
    return {"features": features}


Decoder = Callable[[bytes, str], dict]
Decoders = Mapping[str, Decoder]

# The decoders that need nothing but Python.
BUILT_IN: Decoders = {
    "json": decode_json, "csv": decode_csv, "xlsx": decode_xlsx, "txt": decode_text, "pbf": decode_tile,
}

# What each reader adds to a file's row.
MADE: dict[str, dict[str, T.DataType]] = {
    "pdf": {"pages": STRINGS, "raw": T.StringType()},
    "scanned": {"pages": STRINGS},
    "json": {"raw": T.StringType()},
    "csv": {"sheets": SHEETS},
    "xlsx": {"sheets": SHEETS},
    "txt": {"raw": T.StringType()},
    "image": {"raw": T.StringType()},
    "pbf": {"features": FEATURES},
}


def _absent(kind: str) -> Decoder:
    """What a file becomes whose decoder was not given."""

    def decode(data: bytes, path: str) -> dict:
        return {"estado": V.PENDING_STATES.get(kind, "error"), "detalle": f"{V.NO_DECODER_DETAIL}: {kind}"}

    return decode


def decode_files(
    files: DataFrame, kind: str, decoders: Decoders | None = None, path: str = "ruta_absoluta"
) -> DataFrame:
    """``files`` with bytes_archivo, segundos, estado, detalle and the decoded content.

    ``estado`` is NULL for a file that was decoded.  ``decoders`` adds to the built-in ones or
    takes their place.
    """
    decoder, made = {**BUILT_IN, **(decoders or {})}.get(kind) or _absent(kind), MADE[kind]
    common = {
        "bytes_archivo": T.LongType(), "segundos": T.DoubleType(), "estado": T.StringType(),
        "detalle": T.StringType(),
    }
    added = T.StructType([T.StructField(n, t) for n, t in {**common, **made}.items()])
    schema = T.StructType([*files.schema.fields, *added.fields])
    arrow = to_arrow_schema(schema)
    names = files.columns
    at = names.index(path)

    def one(location: str) -> dict:
        began = time.time()
        row: dict = {}
        try:
            data = read_bytes(location.removeprefix("file:"))
            row["bytes_archivo"] = len(data)
            row.update(decoder(data, location))
        except Exception as error:  # noqa: BLE001
            row.update(estado="error", detalle=f"{type(error).__name__}: {error}")
        if row.get("detalle"):
            row["detalle"] = row["detalle"][: V.DETAIL_CHARS]
        row["segundos"] = round(time.time() - began, 2)
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = one(b.column(at)[i].as_py())
                kept = {n: b.column(j)[i].as_py() for j, n in enumerate(names)}
                yield pa.RecordBatch.from_pylist([{**kept, **row}], schema=arrow)

    return files.mapInArrow(run, schema)


def spread_files(files: DataFrame, tasks: int) -> DataFrame:
    """Files dealt out to many small tasks, so that a heavy one delays few others."""
    return files.repartition(tasks, F.xxhash64("doc_id"))
