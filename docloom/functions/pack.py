"""Greedy packing of sentences into pieces of bounded weight.

A piece closes when the next sentence would take it over the limit and it holds
one already, so a sentence is never cut and an oversize one stands alone.  The
fold keeps only the indices at which pieces start; texts are joined once, from
slices, so the work is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions.arrays import let
from docloom.functions.text import StrCol, col, stripped_word_count, strip

# A fold copies its state at every step, so the growing list of starts is carried
# from block to block of this many sentences and not from sentence to sentence.
_BLOCK = 512


def piece_starts(weights: Column, limit: int) -> Column:
    """0-based index of the first sentence of every piece, for an array of weights."""
    n_blocks = F.ceil(F.size(weights) / F.lit(_BLOCK)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(1), n_blocks),
        lambda b: F.slice(weights, (b - 1) * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def state(size: Column, i: Column, starts: Column) -> Column:
        return F.struct(
            size.cast("bigint").alias("size"), i.alias("i"), starts.alias("starts")
        )

    def add_sentence(acc: Column, w: Column) -> Column:
        # The first sentence opens a piece; later ones do when they do not fit.
        opens = (acc["i"] == 0) | (acc["size"] + w > limit)
        return state(
            F.when(opens, w).otherwise(acc["size"] + w),
            acc["i"] + 1,
            F.when(opens, F.array_append(acc["starts"], acc["i"])).otherwise(acc["starts"]),
        )

    nothing = F.array().cast("array<int>")

    def add_block(acc: Column, block: Column) -> Column:
        return F.aggregate(
            block,
            state(acc["size"], acc["i"], nothing),
            add_sentence,
            lambda r: state(r["size"], r["i"], F.concat(acc["starts"], r["starts"])),
        )

    return F.aggregate(
        blocks, state(F.lit(0), F.lit(0), nothing), add_block, lambda acc: acc["starts"]
    )


def pack(sentences: StrCol, weight: Callable[[Column], Column], limit: int) -> Column:
    """Array of pieces, each its sentences joined by a space."""
    sents = col(sentences)

    def cut(starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(sents)))
        return F.zip_with(
            starts, ends, lambda a, b: F.array_join(F.slice(sents, a + 1, b - a), " ")
        )

    starts = let(F.transform(sents, weight), lambda w: piece_starts(w, limit))
    pieces = let(starts, cut)
    return F.when(F.size(sents) > 0, pieces).otherwise(F.array().cast("array<string>"))


def pack_chunks(sentences: StrCol, limit: int = V.CHUNK_CHARS) -> Column:
    """Chunks by characters; the joining spaces are not counted."""
    packed = pack(sentences, F.length, limit)
    return F.filter(F.transform(packed, strip), lambda p: p != "")


def pack_fragments(
    text: StrCol, sentences: StrCol, limit: int = V.FRAGMENT_WORDS
) -> Column:
    """Fragments by words; text without a sentence is its own only fragment."""
    packed = pack(sentences, stripped_word_count, limit)
    return F.when(F.size(packed) > 0, packed).otherwise(F.array(col(text)))
