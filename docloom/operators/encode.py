"""Texts to unit vectors, resumable.

An encoder is a picklable object with ``encoder_id``, ``dim`` and
``encode(list[str]) -> float array``; Spark batches and spreads the texts.  One that pads
nothing may say by ``batch`` how many texts of any length it takes at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as V
from docloom.operators.chunks import token_bucket


class Encoder(Protocol):
    encoder_id: str
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number, sign) of every word, by its MD5."""
    digests = b"".join([hashlib.md5(w.encode("utf-8")).digest()[:5] for w in words])
    parts = np.frombuffer(digests, np.dtype([("number", ">u4"), ("sign", "u1")]))
    return parts["number"].astype(np.int64), np.where(parts["sign"] < 128, 1.0, -1.0)


class HashingEncoder:
    """Signed feature hashing of lower-case words, deterministic and model-free.

    Stands in where no trained encoder is available.  It pads nothing, so a batch has texts of
    any length, and is large: a word that many of them hold is hashed once.
    """

    batch = 4096

    def __init__(self, dim: int = 256):
        self.dim = dim
        self.encoder_id = f"hashing-{dim}"

    def encode(self, texts: list[str]) -> np.ndarray:
        # Arrow splits at the blanks that Python's split knows; a blank text is NULL and has no words.
        bare = pa.array([text.lower().strip() or None for text in texts], pa.string())
        words = pc.utf8_split_whitespace(bare)
        flat = words.flatten().dictionary_encode()
        if not len(flat):
            return np.zeros((len(texts), self.dim))
        # Each different word is hashed once; its occurrences are counted by place.
        number, sign = _hashed(flat.dictionary.to_pylist())
        place = flat.indices.to_numpy()
        row = np.repeat(np.arange(len(texts)), words.value_lengths().fill_null(0).to_numpy())
        slot = row * self.dim + (number % self.dim)[place]
        counts = np.bincount(slot, weights=sign[place], minlength=len(texts) * self.dim)
        return counts.reshape(len(texts), self.dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    wide = np.where(norms > 0, vectors / np.where(norms > 0, norms, 1), 0.0)
    # A text without any feature still needs a unit vector to be indexed.
    wide[norms[:, 0] == 0, 0] = 1.0
    return wide.astype(np.float32)


def _cut(text: str, max_words: int) -> str:
    parts = text.split(None, max_words)
    return " ".join(parts[:max_words]) if len(parts) > max_words else text


def _encode_batches(
    df: DataFrame, encoder: Encoder, keys: list[str], max_words: int
) -> DataFrame:
    """Encode ``_text``; rows of one ``_batch`` size are encoded together."""
    schema = T.StructType(
        [df.schema[k] for k in keys] + [T.StructField("vector", T.ArrayType(T.FloatType()))]
    )

    def encoded(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [_cut(t, max_words) for t in part.column("_text").to_pylist()]
        wide = _unit(np.asarray(encoder.encode(texts)))
        offsets = pa.array(np.arange(len(wide) + 1, dtype=np.int32) * wide.shape[1])
        vectors = pa.ListArray.from_arrays(offsets, pa.array(wide.ravel()))
        return pa.RecordBatch.from_arrays(
            [*(part.column(k) for k in keys), vectors], names=[*keys, "vector"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column("_batch").to_numpy()
            for size in np.unique(sizes):
                rows = b.take(pa.array(np.flatnonzero(sizes == size)))
                for at in range(0, rows.num_rows, int(size)):
                    yield encoded(rows.slice(at, int(size)))

    return df.select(*keys, "_text", "_batch").mapInArrow(run, schema)


def encode_texts(
    df: DataFrame, encoder: Encoder, keys: list[str], text: str = "texto",
    max_words: int = V.ENCODE_WORDS, tokens: str | None = None, spread: bool = True,
) -> DataFrame:
    """``keys`` and the unit ``vector`` of the first ``max_words`` words of ``text``.

    With a ``tokens`` column, short and long texts are batched apart, so that no
    short text is padded to a long one; an encoder with a ``batch`` of its own needs no such
    care.  Encoding costs far more than moving the
    texts, so they are dealt out evenly first: after a join few tasks may hold them.
    Without ``spread`` they stay where they are, for texts that are made in the same tasks.
    The worker that encodes a text also cuts it, which is cheaper than doing it before.
    """
    long = token_bucket(tokens) == "long" if tokens else F.lit(False)
    own = getattr(encoder, "batch", None)
    batch = F.lit(own) if own else F.when(long, V.BATCH_LONG).otherwise(V.BATCH_SHORT)
    texts = df.select(*keys, F.col(text).alias("_text"), batch.alias("_batch"))
    if spread:
        texts = texts.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return _encode_batches(texts, encoder, keys, max_words)


def with_cache_key(chunks: DataFrame, encoder: Encoder) -> DataFrame:
    """A vector is reusable for the same chunk, encoder and text, nothing less."""
    return chunks.withColumn("encoder_id", F.lit(encoder.encoder_id)).withColumn(
        "text_hash", F.sha1(F.col("texto").cast("binary"))
    )


CACHE_KEY = ["chunk_id", "encoder_id", "text_hash"]


def missing(chunks: DataFrame, cache: DataFrame, encoder: Encoder) -> DataFrame:
    """Chunks without a usable vector in the cache."""
    usable = cache.filter(
        (F.size("vector") == encoder.dim) & ~F.isnan(F.get("vector", F.lit(0)))
    )
    usable = usable.filter(F.col("encoder_id") == encoder.encoder_id)
    keyed = with_cache_key(chunks, encoder)
    # Keys alone meet the cache; a chunk's text is moved once, with those that are left.
    left = keyed.select(*CACHE_KEY).join(usable.select(*CACHE_KEY).distinct(), CACHE_KEY, "left_anti")
    return keyed.join(left, CACHE_KEY, "left_semi")


def encode_missing(chunks: DataFrame, cache: DataFrame | None, encoder: Encoder) -> DataFrame:
    """New cache rows for the chunks that have none."""
    todo = missing(chunks, cache, encoder) if cache is not None else with_cache_key(chunks, encoder)
    return encode_texts(todo, encoder, CACHE_KEY, tokens="num_tokens")
