"""JSON files to document text, dispatched on the fields present.

A file is parsed once into a VARIANT; its fields are then ordinary expressions, so
a corpus of JSON files is one scan.  Where the order of keys matters the text is
read again as a map, because a VARIANT object sorts its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as X
from docloom.functions.arrays import let

# Top-level fields, each taken out of the parsed file once.
_FIELDS = (
    "title", "titulo", "url", "source_url", "date", "authors", "tags", "topics", "categories",
    "keywords", "body_paragraphs", "body_text", "sections", "lists", "abstract", "content",
    "excerpt", "metadata", "alerta_meta",
)
_INNER = {"metadata": ("title", "description"), "alerta_meta": ("tipo", "municipios", "fecha_emision")}

# JSON texts of values that count as absent.
_FALSY = ("null", '""', "0", "-0", "0.0", "-0.0", "false", "[]", "{}")


def _at(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _as_list(v: Column, path: str = "$") -> Column:
    """Array of values, NULL for anything but a non-empty list."""
    items = F.try_variant_get(v, path, "array<variant>")
    return F.when(F.size(items) > 0, items)


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _is_scalar(kind: Column) -> Column:
    return kind.isin("STRING", "BIGINT", "BOOLEAN", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _is_fraction(kind: Column) -> Column:
    # An integer beyond 64 bits is a decimal of scale 0.
    return kind.isin("DOUBLE", "FLOAT") | (kind.startswith("DECIMAL") & ~kind.endswith(",0)"))


def _printed(v: Column, kind: Column) -> Column:
    """Text of a value: True and False in title case, fractions always with a point.

    A list prints its items, strings quoted; an object prints as JSON.
    """

    def item(x: Column) -> Column:
        def quoted(k: Column) -> Column:
            text = F.concat(F.lit("'"), F.try_variant_get(x, "$", "string"), F.lit("'"))
            return F.when(k == "STRING", text).otherwise(_printed_scalar(x, k))

        return let(_kind(x), quoted)

    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), item)
    listed = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    return F.when(kind.startswith("ARRAY"), listed).otherwise(_printed_scalar(v, kind))


def _printed_scalar(v: Column, kind: Column) -> Column:
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind == "BOOLEAN", F.initcap(text))
        .when(_is_fraction(kind), F.try_variant_get(v, "$", "double").cast("string"))
        .when(kind == "VOID", F.lit("None"))
        .otherwise(text)
    )


def _scalar(v: Column) -> Column:
    """Stripped text of a string, number or boolean; NULL when blank or anything else."""

    def printed(kind: Column) -> Column:
        return F.when(_is_scalar(kind), F.nullif(X.strip(_printed_scalar(v, kind)), F.lit("")))

    return let(_kind(v), printed)


def _string(v: Column) -> Column:
    """Stripped text of a string; NULL when blank or anything else."""
    text = F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return F.nullif(X.strip(text), F.lit(""))


def _truthy(v: Column) -> Column:
    return F.when(~F.coalesce(F.to_json(v), F.lit("null")).isin(*_FALSY), v)


def _any_text(v: Column) -> Column:
    """Unstripped text of any value that is set."""
    printed = let(_kind(v), lambda kind: _printed(v, kind))
    return F.when(~F.coalesce(F.to_json(v), F.lit("null")).isin(*_FALSY), printed)


def _paragraphs(v: Column) -> Column:
    """Scalars of a list joined by blank lines, '' for anything but a list."""
    items = F.coalesce(_as_list(v), F.array().cast("array<variant>"))
    texts = F.filter(F.transform(items, _scalar), lambda t: t.isNotNull())
    return F.array_join(texts, "\n\n")


def _joined_list(v: Column) -> Column:
    """Items of a non-empty list joined by '; ', NULL without such a list."""
    def text(x: Column) -> Column:
        return X.strip(let(_kind(x), lambda kind: _printed(x, kind)))

    texts = F.transform(_as_list(v), text)
    return F.array_join(F.filter(texts, lambda t: t != ""), "; ")


def _appended(lists: list[Column]) -> Column:
    """Several joined lists appended in order; NULL when no list is present."""
    present = F.filter(F.array(*lists), lambda t: t.isNotNull())

    def append(before: Column, new: Column) -> Column:
        both = F.trim(F.concat(before, F.lit("; "), new), F.lit("; "))
        return F.when(before != "", both).otherwise(new)

    return F.when(F.size(present) > 0, F.aggregate(present, F.lit(""), append))


def _insert_second(rows: DataFrame, text: Column) -> DataFrame:
    """Put a text after the first part, or at the end when there is none."""
    at = F.least(F.size("_parts") + 1, F.lit(2))
    both = rows.withColumn("_new", text)
    added = F.array_insert(F.col("_parts"), at, F.col("_new"))
    return both.withColumn("_parts", F.when(F.col("_new").isNull(), F.col("_parts")).otherwise(added))


def _section_list(sections: Column, lists: Column) -> Column:
    """Heading and paragraphs of every section object, then the free lists."""

    def block(section: Column) -> Column:
        head = let(_at(section, "heading"), lambda h: X.strip(_any_text(h)))
        body = let(_at(section, "paragraphs"), _paragraphs)
        parts = F.filter(F.array(head, body), lambda t: t.isNotNull() & (t != ""))
        return F.when(_is_object(section), X.strip(F.array_join(parts, "\n\n")))

    blocks = F.transform(_as_list(sections), block)
    rest = F.array(_paragraphs(lists))
    return F.filter(F.concat(blocks, rest), lambda t: t.isNotNull() & (t != ""))


def _section_map(raw: Column) -> Column:
    """``title``, blank line, text of every string section, in file order."""
    entries = F.map_entries(
        F.from_json(F.get_json_object(raw, "$.content.sections"), "map<string,variant>")
    )
    texts = F.transform(
        entries, lambda e: F.concat(e["key"], F.lit("\n\n"), _string(e["value"]))
    )
    filled = F.filter(texts, lambda t: t.isNotNull())
    return F.coalesce(filled, F.array().cast("array<string>"))


def _record_lines(raw: Column) -> Column:
    """A list of records as table rows ``column: value | ...``, blank rows left out.

    Columns come in order of first appearance.  A column of whole numbers with a
    gap or a fraction prints as fractions, as a table column of numbers would.
    """
    records = F.from_json(raw, "array<map<string,variant>>")

    def lines(rows: Column) -> Column:
        names = F.array_distinct(F.flatten(F.transform(rows, F.map_keys)))
        named = F.filter(names, lambda n: ~n.startswith(V.UNNAMED_COLUMN))

        def described(name: Column) -> Column:
            kinds = F.transform(rows, lambda r: _kind(F.try_element_at(r, name)))
            numeric = F.forall(kinds, lambda k: k.isin("BIGINT", "VOID") | _is_fraction(k))
            gap = F.exists(kinds, lambda k: (k == "VOID") | _is_fraction(k))
            return F.struct(name.alias("name"), (numeric & gap).alias("fraction"))

        def row_line(columns: Column, r: Column) -> Column:
            def cell(c: Column) -> Column:
                value = F.try_element_at(r, c["name"])
                kind = _kind(value)
                number = F.try_variant_get(value, "$", "double").cast("string")
                text = F.when(c["fraction"], number).otherwise(_printed(value, kind))
                return X.pair(c["name"], F.when(kind != "VOID", text))

            return F.array_join(
                F.filter(F.transform(columns, cell), lambda p: p.isNotNull()), " | "
            )

        def with_columns(columns: Column) -> Column:
            return F.transform(rows, lambda r: row_line(columns, r))

        return F.flatten(F.transform(F.array(F.transform(named, described)), with_columns))

    found = F.flatten(F.transform(F.array(records), lines))
    return F.array_join(F.filter(found, lambda t: t != ""), "\n")


def json_documents(files: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds the fields read from each file's JSON text, which is dropped.

    Added: titulo, url, fecha, autores, etiquetas, subtipo_json, texto, estado,
    detalle, filas_totales.  Text that is not JSON gives an ``error`` row.
    """
    src = F.col(raw)
    parsed = files.withColumn("_v", F.try_parse_json(raw))
    parsed = parsed.withColumns(
        {
            "_list": F.try_variant_get("_v", "$", "array<variant>"),
            "_object": F.coalesce(_is_object(F.col("_v")), F.lit(False)),
            **{f"_{n}": _at(F.col("_v"), n) for n in _FIELDS},
        }
    )
    field = {n: F.col(f"_{n}") for n in _FIELDS}
    parsed = parsed.withColumns(
        {
            "_records": F.coalesce(_is_object(F.get("_list", F.lit(0))), F.lit(False)),
            "_alert": _is_set_object(field["alerta_meta"]),
            # A title that is set but not a text still hides the other one.
            "_title": F.coalesce(_truthy(field["title"]), field["titulo"]),
            "_body": _body_kind(field),
            **{f"_{o}_{n}": _at(field[o], n) for o, names in _INNER.items() for n in names},
        }
    )
    body, alert = F.col("_body"), F.col("_alert")
    report = body == "reporte_secciones"
    inner = {n: F.col(f"_metadata_{n}") for n in _INNER["metadata"]}
    warned = {n: F.col(f"_alerta_meta_{n}") for n in _INNER["alerta_meta"]}
    nothing = F.array().cast("array<string>")

    parsed = parsed.withColumns(
        {
            "_head": F.when(F.col("_object"), _string(F.col("_title"))),
            "_parts": F.when(body == "articulo", F.array(_paragraphs(field["body_paragraphs"])))
            .when(body == "articulo_texto", F.array(_string(field["body_text"])))
            .when(body == "pagina_secciones", _section_list(field["sections"], field["lists"]))
            .when(body == "resumen_academico", F.array(_string(field["abstract"])))
            .when(report, _section_map(src))
            .when(body == "solo_extracto", F.array(_string(field["excerpt"])))
            .when((body == "catalogo_lista") & F.col("_records"), F.array(_record_lines(src)))
            .otherwise(nothing),
        }
    )
    parsed = parsed.withColumn(
        "_parts",
        F.concat(F.when(F.col("_head").isNotNull(), F.array("_head")).otherwise(nothing), "_parts"),
    )
    parsed = _insert_second(parsed, F.when(report, X.strip(_any_text(inner["description"]))))
    parsed = _insert_second(parsed, F.when(alert, _alert_text(warned)))

    made = {
        "titulo": F.coalesce(F.col("_head"), F.when(report, X.strip(_any_text(inner["title"])))),
        "url": F.coalesce(_scalar(field["url"]), _scalar(field["source_url"])),
        "fecha": F.coalesce(
            _scalar(field["date"]), F.when(alert, X.strip(_any_text(warned["fecha_emision"])))
        ),
        "autores": _joined_list(field["authors"]),
        "etiquetas": _appended(
            [_joined_list(field[n]) for n in ("tags", "topics", "categories", "keywords")]
        ),
    }
    failed = body == "error"
    out = parsed.select(
        *[c for c in files.columns if c != raw and c not in made],
        *[F.when(F.col("_object"), e).alias(n) for n, e in made.items()],
        F.when(alert, F.lit("alerta_temprana"))
        .when(body == "articulo_texto", F.lit("articulo"))
        .when(~failed, body)
        .alias("subtipo_json"),
        F.array_join(F.filter("_parts", lambda p: ~X.is_blank(p)), "\n\n").alias("texto"),
        F.when(F.col("_records"), F.size("_list").cast("bigint")).alias("filas_totales"),
        F.when(failed, F.lit("JSONDecodeError")).alias("detalle"),
    )
    return out.withColumn(
        "estado",
        F.when(F.col("detalle").isNotNull(), F.lit("error"))
        .when(~X.is_blank("texto"), F.lit("ok"))
        .otherwise(F.lit("vacio")),
    )


def _body_kind(field: dict[str, Column]) -> Column:
    """Which body a file has, by precedence."""
    return (
        F.when(F.col("_v").isNull(), F.lit("error"))
        .when(F.size("_list") == 0, F.lit("catalogo_vacio"))
        .when(F.col("_list").isNotNull(), F.lit("catalogo_lista"))
        .when(~F.col("_object"), F.lit("desconocido"))
        .when(_as_list(field["body_paragraphs"]).isNotNull(), F.lit("articulo"))
        .when(_string(field["body_text"]).isNotNull(), F.lit("articulo_texto"))
        .when(_as_list(field["sections"]).isNotNull(), F.lit("pagina_secciones"))
        .when(_string(field["abstract"]).isNotNull(), F.lit("resumen_academico"))
        .when(_is_object(field["content"]), F.lit("reporte_secciones"))
        .when(_string(field["excerpt"]).isNotNull(), F.lit("solo_extracto"))
        .otherwise(F.lit("sin_cuerpo"))
    )


def _is_set_object(v: Column) -> Column:
    filled = F.size(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))) > 0
    return F.coalesce(filled, F.lit(False))


def _alert_text(warned: dict[str, Column]) -> Column:
    """Kind of alert and municipalities, NULL when neither is set."""
    said = F.concat_ws(
        ". ",
        F.concat(F.lit("Tipo de alerta: "), _any_text(warned["tipo"])),
        F.concat(F.lit("Municipios: "), _any_text(warned["municipios"])),
    )
    return let(said, lambda t: F.when(t != "", F.concat(t, F.lit("."))))
