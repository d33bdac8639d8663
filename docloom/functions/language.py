"""Language of a text from its first characters.

Profiles of character trigrams are learned from all labelled texts: a naive Bayes model over
character n-grams.  A text is scored against all languages at once: its trigrams are looked up
in one sorted array, each with the languages that have shown it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docloom import fixed_values as V
from docloom.functions import text as X

GRAM = 3
#: Added to a language's number of trigrams, for those it has not shown.
SMOOTHING = 2000
#: Ranges of hashes that a language's rows are counted by: so many bits.
_RANGE_BITS = 12
#: A trigram as a number has so many bits a character; what a shorter text lacks is no code point.
_BITS, _NONE = np.uint64(21), np.uint64((1 << 21) - 1)
#: Characters that a task counts at once, and trigrams that it holds before it passes them on.
_CHARS_AT_ONCE, _GRAMS_HELD = 1 << 21, 1 << 20
#: Texts that are scored at once: at most so many, and so many scores of a trigram and a language.
_TEXTS_AT_ONCE, _SCORES_AT_ONCE = 200, 1 << 20


def sample(text: Column | str) -> Column:
    """What identification looks at; NULL when it is too short to tell."""
    head = X.strip(F.substring(X.col(text), 1, V.LANGUAGE_SAMPLE))
    return F.when(F.length(head) >= V.LANGUAGE_MIN_CHARS, head)


def unknown_language(text: Column) -> Column:
    """What documents are labelled where no detector is given."""
    return F.lit(V.UNKNOWN)


def trigram_profiles(
    labelled: DataFrame, text: str = "texto", language: str = "idioma", rows: int | None = None
) -> DataFrame:
    """(idioma, gram, n, total): all trigrams of every language.

    They are counted map-side over whole texts: of all labelled rows, or, where ``rows`` is given,
    of each language the ``rows`` with the smallest hash of the text.
    """
    known = labelled.select(F.col(language).alias("idioma"), F.col(text).alias("_text")).where("idioma is not null")
    if rows is None:
        chosen = known.withColumn("_times", F.lit(1).cast("bigint"))
    else:
        chosen = _smallest_hashes(known.withColumn("_hash", F.xxhash64("_text")), rows)
    lower = chosen.select(F.col("idioma").cast("string").alias("idioma"), "_times", F.lower("_text").alias("_text"))
    counted = (
        lower.mapInArrow(_count, "idioma string, gram string, n bigint")
        .groupBy("idioma", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # The trigrams of a language, not its texts, meet in a task: its part of the model.
    return counted.withColumn("total", F.sum("n").over(Window.partitionBy("idioma")))


def _smallest_hashes(known: DataFrame, rows: int) -> DataFrame:
    """(idioma, _hash, _text, _times): of every language the ``rows`` first by hash and text.

    Hashes alone are counted and cut off, first by their leading bits and then inside the one range
    where a language's count is reached, so no task meets a language's texts.  Only texts up to the
    cut are shuffled, equal ones as one row with the times it counts.
    """
    hashes = known.groupBy("idioma", "_hash").agg(F.count("*").alias("_n"))
    ranged = hashes.withColumn("_range", F.shiftright("_hash", 64 - _RANGE_BITS))
    ranges = ranged.groupBy("idioma", "_range").agg(F.sum("_n").alias("_n"))
    reached = _reached(ranges, ["idioma"], "_range", F.lit(0), rows)
    inside = ranged.join(F.broadcast(reached), ["idioma", "_range"])
    cuts = _reached(inside, ["idioma"], "_hash", F.col("_before"), rows).withColumnRenamed("_hash", "_cut")
    # One row a language, as in the model.
    below = known.join(F.broadcast(cuts), "idioma").where(F.col("_hash") <= F.col("_cut"))
    texts = below.groupBy("idioma", "_hash", "_text").agg(
        F.count("*").alias("_n"), F.any_value("_cut").alias("_cut"), F.any_value("_before").alias("_before")
    )
    # Texts of one hash: more than one by chance alone.
    earlier = Window.partitionBy("idioma", "_hash").orderBy("_text").rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(rows) - F.col("_before") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    times = F.when(F.col("_hash") < F.col("_cut"), F.col("_n")).otherwise(F.least(F.col("_n"), room))
    return texts.withColumn("_times", times).where("_times > 0").select("idioma", "_hash", "_text", "_times")


def _reached(counts: DataFrame, keys: list[str], place: str, start: Column, rows: int) -> DataFrame:
    """(keys, place, _before): the last place of a key with fewer than ``rows`` before it, and how many."""
    earlier = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", start + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    last = before.where(F.col("_before") < rows).groupBy(*keys).agg(F.max(F.struct(place, "_before")).alias("_last"))
    return last.select(*keys, "_last.*")


def _codes(text: str) -> np.ndarray:
    """Trigrams as numbers: three code points; a shorter text is padded."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    points = np.concatenate([points, np.full(max(GRAM - len(points), 0), _NONE)])
    return (((points[:-2] << _BITS) | points[1:-1]) << _BITS) | points[2:]


def _grams(codes: np.ndarray) -> list[str]:
    """The texts of such numbers."""
    points = np.column_stack([codes >> (_BITS + _BITS), (codes >> _BITS) & _NONE, codes & _NONE])
    there = points != _NONE
    chars = np.where(there, points, 0).astype("<u4").tobytes().decode("utf-32-le")
    return [chars[GRAM * i : GRAM * i + n] for i, n in enumerate(there.sum(axis=1).tolist())]


def _code(gram: str) -> Column:
    """As ``_codes``, of a column of single trigrams."""
    parts = [
        F.when(F.length(gram) > i, F.ascii(F.substring(gram, i + 1, 1)).cast("bigint")).otherwise(int(_NONE))
        for i in range(GRAM)
    ]
    first, second, third = parts
    return F.shiftleft(first, 2 * int(_BITS)).bitwiseOR(F.shiftleft(second, int(_BITS))).bitwiseOR(third)


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number once, with the sum of its ``n``."""
    found, place = np.unique(codes, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, n)
    return found, total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(idioma, times, text) to (idioma, gram, n).

    A trigram comes once from a task, or more often if the task meets very many: counts are
    added up over batches and passed on when there are too many to hold.
    """
    parts, chars = defaultdict(list), 0
    held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}

    def settle() -> None:
        for key, codes in parts.items():
            found, n = np.unique(np.concatenate(codes), return_counts=True)
            if key in held:
                found, n = _summed(np.concatenate([held[key][0], found]), np.concatenate([held[key][1], n]))
            held[key] = found, n
        parts.clear()

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (idioma, times), (codes, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([idioma] * len(n), pa.string()), pa.array(_grams(codes), pa.string()), pa.array(n * times, pa.int64())],
                names=["idioma", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for idioma, times, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text is None:
                continue
            # A long text goes in pieces that share their trigrams' last characters.
            for at in range(0, max(len(text) - GRAM + 1, 1), _CHARS_AT_ONCE):
                codes = _codes(text[at : at + _CHARS_AT_ONCE + GRAM - 1])
                parts[idioma, times].append(codes)
                chars += len(codes)
                if chars >= _CHARS_AT_ONCE:
                    settle()
                    chars = 0
                    if sum(len(n) for _, n in held.values()) >= _GRAMS_HELD:
                        yield from passed_on()
    settle()
    yield from passed_on()


def trigram_detector(profiles: DataFrame):
    """Column function text -> language from profiles.

    The driver and the tasks hold every trigram with the languages that have shown it: a number
    for each trigram, and one for each trigram and language of the profiles.
    """
    table = profiles.select("idioma", _code("gram").alias("code"), "n", "total").toArrow()
    table = table.to_pandas(categories=["idioma"]).sort_values("code", kind="stable")
    names = table["idioma"].cat.categories.tolist()
    languages = sorted(names)
    column = np.searchsorted(languages, names)[table["idioma"].cat.codes] if names else np.empty(0, int)
    total = np.full(len(languages), 1.0)
    total[column] = table["total"].to_numpy(float) + SMOOTHING
    keys, first = np.unique(table["code"].to_numpy(np.uint64), return_index=True)
    # A score is that of a text without a known trigram, and a gain for each that a language has shown.
    model = (
        languages, -np.log(total), keys, np.append(first, len(table)),
        column.astype(np.int32), np.log(table["n"].to_numpy(float) + 1),
    )
    shared = profiles.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(StringType())
    def identify(texts: pd.Series) -> pd.Series:
        languages = shared.value[0]
        out = pd.Series([None] * len(texts), dtype=object)
        given = np.flatnonzero(texts.notna().to_numpy())
        if not len(given):
            return out
        if not languages:
            out.iloc[given] = V.UNKNOWN
            return out
        # A score for every trigram and language: a few texts at a time, whatever the size of a batch.
        few = min(max(_SCORES_AT_ONCE // (V.LANGUAGE_SAMPLE * len(languages)), 1), _TEXTS_AT_ONCE)
        for at in range(0, len(given), few):
            some = given[at : at + few]
            scores = _scores(shared.value, [_codes(t) for t in texts.iloc[some].str.lower()])
            best = scores.argmax(axis=1)
            prob = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            out.iloc[some] = np.where(prob >= V.LANGUAGE_MIN_PROB, np.array(languages, object)[best], V.UNKNOWN)
        return out

    return lambda text: F.coalesce(identify(sample(text)), F.lit(V.UNKNOWN))


def _scores(model: tuple, parts: list[np.ndarray]) -> np.ndarray:
    """The log-probability of every text, given as numbers of its trigrams, in every language."""
    languages, unseen, keys, first, column, gain = model
    sizes = np.array([len(p) for p in parts])
    flat = np.concatenate(parts)
    place = np.searchsorted(keys, flat)
    place[place == len(keys)] = 0
    known = np.flatnonzero(keys[place] == flat)
    place = place[known]
    # A known trigram's languages are neighbours: as many places from its first on.
    shown = first[place + 1] - first[place]
    entry = np.arange(shown.sum()) + np.repeat(first[place] - (np.cumsum(shown) - shown), shown)
    text = np.repeat(np.repeat(np.arange(len(parts)), sizes)[known], shown)
    gains = np.bincount(text * len(languages) + column[entry], gain[entry], len(parts) * len(languages))
    return gains.reshape(len(parts), -1) + sizes[:, None] * unseen
