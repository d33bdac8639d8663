"""Tokens of a text by a byte-pair vocabulary.

The merges run in the tokenizer library, over Arrow batches; Spark has no expression for
them.  The vocabulary is a file of ranks (a line for each token: its bytes in Base64 and its
rank), read once and broadcast: a bounded table, checked when it is read.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from docloom.functions.text import StrCol, col

#: How texts are cut before pairs merge: fixed value, part of the vocabularies' definition.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ranks that are broadcast at most, about 20 bytes each.
MOST_RANKS = 1_000_000


def read_ranks(spark: SparkSession, path: str) -> str:
    """The lines of a rank file on the driver's disk, else of one that Spark reads."""
    if os.path.exists(path):
        with open(path, encoding="ascii") as file:
            lines = file.read().split("\n")
    else:
        lines = [r.value for r in spark.read.text(path).limit(MOST_RANKS + 1).collect()]
    lines = [line for line in lines if line.strip()]
    if len(lines) > MOST_RANKS:
        raise ValueError(f"{path} holds more than {MOST_RANKS} ranks")
    for line in lines:
        if len(line.split()) != 2:
            raise ValueError(f"{path} is no rank file: {line[:80]!r}")
    return "\n".join(lines)


@cache
def _encoding(ranks: str, pieces: str):
    """The vocabulary of a Python worker, built once for all its batches."""
    import base64

    import tiktoken

    pairs = (line.split() for line in ranks.split("\n"))
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pieces, mergeable_ranks=merges, special_tokens={})


def rank_counter(spark: SparkSession, path: str, pieces: str = PIECES) -> Callable[[StrCol], Column]:
    """A Column function: how many tokens the rank file at ``path`` makes of a text.

    Strings that look like special tokens are ordinary text.  NULL has no count, an
    empty text has 0 tokens.
    """
    shared = spark.sparkContext.broadcast(read_ranks(spark, path))

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(shared.value, pieces)
        made = [None if t is None else len(encoding.encode_ordinary(t)) for t in texts]
        return pd.Series(made, dtype="Int64")

    return lambda text: count(col(text))
