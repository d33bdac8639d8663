"""Declared schemas: nothing is inferred, so all-NULL batches keep their types."""

from pyspark.sql import types as T

from docloom import fixed_values as V

STRING, LONG = T.StringType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _document_type(name: str) -> T.DataType:
    if name in V.LONG_COLUMNS:
        return LONG
    return {"truncado": T.BooleanType(), "segundos": T.DoubleType()}.get(name, STRING)


DOCUMENTS = _struct(**{c: _document_type(c) for c in V.DOCUMENT_COLUMNS})

INVENTORY = _struct(
    pos=LONG, doc_id=STRING, fuente=STRING, ruta_relativa=STRING, ruta_absoluta=STRING,
    tipo_adl=STRING, fenomeno=LONG, observatorio=STRING, codigo_observatorio=STRING,
)

CHUNKS = _struct(
    chunk_id=STRING, doc_id=STRING, posicion=LONG, texto=STRING, num_tokens=LONG,
    observatorio=STRING, fenomeno=LONG, fuente=STRING, formato=STRING, idioma=STRING,
    titulo=STRING, url=STRING, fecha=STRING, n_caracteres_chunk=LONG, n_palabras_chunk=LONG,
)

PAGES = _struct(doc_id=STRING, page=LONG, texto=STRING)

INDEX = _struct(
    row_id=LONG, chunk_id=STRING, encoder_id=STRING, vector=T.ArrayType(T.FloatType())
)

ANSWER = _struct(
    query_id=STRING,
    documents=T.ArrayType(_struct(rank=LONG, doc_id=STRING)),
    fragments=T.ArrayType(_struct(rank=LONG, chunk_id=STRING, doc_id=STRING, text=STRING)),
)
