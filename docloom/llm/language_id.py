"""Language of a text by interpolated Kneser-Ney models over characters.

Each language has a model of character 4-grams.  All models share sorted arrays of gram
hashes, one per order, with a row of log-probabilities and of back-off weights, a column for
each language: a gram is looked up once for all languages, and only grams no
language has seen go on to a lower order.  A text gets the language of the lowest
cross-entropy per character.  What a language's own texts cost at most, with a margin for
length, is learned from texts kept apart from the counts; what costs more is rejected.

Models are learned from a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import shingles as S
from docloom.llm.common import cut_lineage, read

ORDER = 4
#: Labelled rows learned from, for each language; a quarter of them calibrates if there are MIN_TO_CALIBRATE.
ROWS_PER_LANGUAGE, MIN_TO_CALIBRATE = 800, 20
#: The table of languages, a label and a count each, is sent to the tasks up to this many rows.
BROADCAST_LANGUAGES = 100_000
#: Rejection: this many times the largest excess seen in calibration, and so many nats a
#: character above the median at least: a text of two languages, or with numbers and
#: names in it, stays below; random letters do not.
MARGIN, LEAST_EXCESS = 2.0, 1.2
UNDETERMINED = "und"
_BEGIN, _SPACE = 1, 32
_CHARS_AT_ONCE = 1 << 19
_LENGTH_FOR_SCORE, _LENGTH_FOR_EXCESS = 200, 400
_U = np.uint64


@cache
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each as begin, space, words, space; and where each begins."""
    parts, sizes = [], []
    frame = np.array([_BEGIN, _SPACE], np.uint32), np.array([_SPACE], np.uint32)
    for text in texts:
        codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
        parts += [frame[0], codes, frame[1]]
        sizes.append(len(codes) + 3)
    raw = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    plain = _letters()[raw]
    plain[at[:-1]] = _BEGIN
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != _SPACE) | (plain[:-1] != _SPACE)
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return plain[keep].astype(_U), kept_before[at]


@cache
def _factors() -> np.ndarray:
    return S.constants(ORDER, 3)


def _keys(symbols: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` symbols that end at each place from order - 1 on."""
    n = len(symbols) - order + 1
    key = np.full(max(n, 0), order, _U)
    for k in range(order):
        key += symbols[k : k + n] * _factors()[k]
    return S.mix(key)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "") + 3
        if size > _CHARS_AT_ONCE:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for low, high in _chunks(texts):
            for lang in set(langs[low:high]):
                own = [texts[i] for i in range(low, high) if langs[i] == lang]
                symbols, at = _symbols(own)
                if len(symbols) < ORDER:
                    continue
                grams = np.lib.stride_tricks.sliding_window_view(symbols, ORDER)
                inside = np.ones(len(grams), bool)
                for cut in at[1:-1]:
                    inside[cut - ORDER + 1 : cut] = False
                found, n = np.unique(grams[inside], axis=0, return_counts=True)
                packed = [row.tobytes() for row in found.astype(np.uint32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array(packed, pa.binary()), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


@dataclass
class Model:
    """``keys[n]``: sorted hashes of order n + 1; ``logp``, ``back``: a row for each, a column for each language."""

    languages: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    back: list[np.ndarray]
    unseen: np.ndarray
    sharpness: float = 1.0
    limits: np.ndarray | None = None

    def _rows(self, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.keys[order]
        place = np.searchsorted(known, keys)
        place[place == len(known)] = 0
        return place, known[place] == keys

    def cost(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy in nats a character of each text and language, characters, whether it has a letter)."""
        n = len(texts)
        total, length, lettered = np.zeros((n, len(self.languages))), np.zeros(n), np.zeros(n, bool)
        for low, high in _chunks(texts):
            symbols, at = _symbols(texts[low:high])
            is_letter = (symbols != _SPACE) & (symbols != _BEGIN)
            lettered[low:high] = np.add.reduceat(is_letter, at[:-1]) > 0
            sizes = np.diff(at)
            scored = np.maximum(sizes - ORDER + 1, 0)
            length[low:high] = scored
            if len(symbols) < ORDER:
                continue
            ends = np.arange(ORDER - 1, len(symbols))
            start = np.repeat(at[:-1], sizes)[ORDER - 1 :]
            ends = ends[ends - start >= ORDER - 1]
            value = self._log(symbols, ends)
            doc = np.repeat(np.arange(high - low), scored)
            has = scored > 0
            firsts = np.searchsorted(doc, np.flatnonzero(has))
            if len(doc):
                total[low:high][has] = np.add.reduceat(value, firsts, axis=0, dtype=np.float64)
        return -total / np.maximum(length, 1)[:, None], length, lettered

    def _log(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = np.zeros((len(ends), len(self.languages)), np.float32)
        open_rows, at = np.arange(len(ends)), ends
        for order in range(ORDER - 1, -1, -1):
            keys = _keys(symbols, order + 1)
            place, seen = self._rows(order, keys[at - order])
            value[open_rows[seen]] += self.logp[order][place[seen]]
            open_rows, at = open_rows[~seen], at[~seen]
            if not len(at):
                return value
            if order:
                # The history alone, one order down, carries the back-off weight.
                history = _keys(symbols, order)
                place, seen = self._rows(order - 1, history[at - order])
                value[open_rows[seen]] += self.back[order - 1][place[seen]]
        value[open_rows] += self.unseen
        return value

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        if not self.languages:
            return pd.DataFrame({"lang": [UNDETERMINED] * len(texts), "score": 0.0, "cost": 0.0, "rejected": True})
        cost, length, lettered = self.cost(texts)
        best = cost.argmin(axis=1)
        low = cost[np.arange(len(best)), best]
        logits = -(cost - low[:, None]) * (np.minimum(length, _LENGTH_FOR_SCORE) * self.sharpness)[:, None]
        score = 1 / np.exp(logits).sum(axis=1)
        odd = np.zeros(len(best), bool)
        if self.limits is not None:
            middle, most = self.limits
            excess = low - middle[best]
            odd = (excess > LEAST_EXCESS) & (excess * np.sqrt(np.minimum(length, _LENGTH_FOR_EXCESS)) > most[best])
        return pd.DataFrame(
            {
                "lang": np.where(lettered, np.array(self.languages, object)[best], UNDETERMINED),
                "score": np.where(lettered, score, 0.0),
                "cost": np.where(lettered, low, 0.0),
                "rejected": ~lettered | odd,
            }
        )


def _kneser_ney(table: pd.DataFrame) -> Model:
    """Interpolated probabilities of all orders from counts of 4-grams (lang, gram, n)."""
    languages = sorted(table["lang"].unique())
    if not languages:
        return Model([], [], [], [], np.zeros(0))
    grams = np.frombuffer(b"".join(table["gram"]), np.uint32).reshape(-1, ORDER).astype(_U)
    codes = np.searchsorted(languages, table["lang"])
    counts = table["n"].to_numpy(np.float64)
    # Of each order the grams of each language: raw counts above, numbers of different
    # left neighbours below.
    levels = {ORDER: (grams, codes, counts)}
    for order in range(ORDER - 1, 0, -1):
        above, lang, _ = levels[order + 1]
        both = np.column_stack([lang.astype(_U), above[:, 1:]])
        found, n = np.unique(both, axis=0, return_counts=True)
        levels[order] = (found[:, 1:], found[:, 0].astype(np.int64), n.astype(np.float64))
    n_languages = len(languages)
    symbols = [max(2, len(np.unique(levels[1][0][levels[1][1] == k]))) + 1 for k in range(n_languages)]
    uniform = 1.0 / np.array(symbols)
    keys, logs, backs = [], [], []
    lower = np.broadcast_to(uniform, (1, n_languages))
    base_weight = None
    for order in range(1, ORDER + 1):
        own, lang, n = levels[order]
        hashed = np.array([], _U) if not len(own) else _row_keys(own)
        known = np.unique(hashed)
        row = np.searchsorted(known, hashed)
        history = _row_keys(own[:, :-1]) if order > 1 else np.zeros(len(own), _U)
        contexts = np.unique(history)
        context = np.searchsorted(contexts, history)
        total = np.zeros((len(contexts), n_languages))
        kinds = np.zeros((len(contexts), n_languages))
        np.add.at(total, (context, lang), n)
        np.add.at(kinds, (context, lang), 1)
        once = np.bincount(lang[n == 1], minlength=n_languages)
        twice = np.bincount(lang[n == 2], minlength=n_languages)
        discount = np.clip(once / np.maximum(once + 2.0 * twice, 1), 0.1, 0.95)
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(total > 0, discount * kinds / total, 1.0)
        # A row of this order for every gram that any language has: what it has seen, plus the lower order.
        first = np.zeros(len(known), np.int64)
        first[row] = np.arange(len(own))
        ctx = context[first]
        if order == 1:
            below = np.broadcast_to(uniform, (len(known), n_languages))
        else:
            below = lower[np.searchsorted(keys[-1], _row_keys(own[first][:, 1:]))]
        prob = weight[ctx] * below
        seen = np.maximum(n - discount[lang], 0) / total[context, lang]
        np.add.at(prob, (row, lang), seen)
        if order == 1:
            base_weight = weight[0]
        else:
            # Weights are kept beside the grams of the order below that are their histories.
            back = np.zeros((len(keys[-1]), n_languages))
            place = np.searchsorted(keys[-1], contexts)
            place[place == len(keys[-1])] = 0
            there = keys[-1][place] == contexts
            back[place[there]] = np.log(weight[there])
            backs.append(back.astype(np.float32))
        keys.append(known)
        logs.append(np.log(prob).astype(np.float32))
        lower = prob
    return Model(languages, keys, logs, backs, np.log(base_weight * uniform).astype(np.float32))


def _row_keys(grams: np.ndarray) -> np.ndarray:
    key = np.full(len(grams), grams.shape[1], _U)
    for k in range(grams.shape[1]):
        key += grams[:, k] * _factors()[k]
    return S.mix(key)


def held_out(doc_id: Column) -> Column:
    """Whether nothing may be learned from the row."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE,
    doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
) -> Model:
    """A model of the languages labelled in ``docs``.

    Learned from rows with a label and a text whose crc32(doc_id) mod 3 is not 1, of each
    language a share by a hash of doc_id that is ``rows_per_language`` in expectation, or all if
    there are fewer: what comes to the driver are this sample's gram counts and
    calibration costs.  Rows without a doc_id are not learned from.
    """
    known = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id")))
    # A share of each language by a hash: no task gathers the candidates of a language.
    counts = cut_lineage(known.groupBy("lang").agg(F.count("*").alias("_count")))
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_LANGUAGES else counts
    scale = 1 << 30
    share = F.pmod(F.xxhash64("doc_id"), F.lit(scale)) * F.col("_count") < float(scale) * rows_per_language
    sample = known.join(counts, "lang").where(share & F.col("text").isNotNull())
    kept_apart = (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) == 0) & (F.col("_count") >= MIN_TO_CALIBRATE)
    learn, check = sample.where(~kept_apart), sample.where(kept_apart)
    counted = learn.select("lang", "text").mapInArrow(_count, "lang string, gram binary, n bigint")
    model = _kneser_ney(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().to_pandas())
    if model.languages:
        _calibrate(model, check)
    return model


def _calibrate(model: Model, labelled: DataFrame) -> None:
    shared = labelled.sparkSession.sparkContext.broadcast(model)
    columns = [f"c{k}" for k in range(len(model.languages))]

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cost, length, lettered = shared.value.cost(b.column(1).to_pylist())
            arrays = [b.column(0), pa.array(length), pa.array(lettered), *[pa.array(c) for c in cost.T]]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "length", "lettered", *columns])

    schema = "lang string, length double, lettered boolean, " + ", ".join(f"{c} double" for c in columns)
    rows = labelled.select("lang", "text").mapInArrow(costs, schema).toArrow().to_pandas()
    rows = rows[rows["lettered"] & rows["lang"].isin(model.languages)]
    if not len(rows):
        return
    cost, length = rows[columns].to_numpy(), rows["length"].to_numpy()
    truth = np.searchsorted(model.languages, rows["lang"])
    least = cost.min(axis=1, keepdims=True)

    def loss(sharpness: float) -> float:
        logits = -(cost - least) * (np.minimum(length, _LENGTH_FOR_SCORE) * sharpness)[:, None]
        return float((np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(truth)), truth]).mean())

    model.sharpness = min((2.0**-k for k in range(9)), key=loss)
    middle, most = np.full(len(model.languages), least.mean()), np.full(len(model.languages), np.inf)
    for k in range(len(model.languages)):
        own = cost[truth == k, k]
        if len(own):
            middle[k] = np.median(own)
            spread = (own - middle[k]) * np.sqrt(np.minimum(length[truth == k], _LENGTH_FOR_EXCESS))
            most[k] = MARGIN * max(spread.max(), 1.0)
    model.limits = np.array([middle, most])


def detector(spark: SparkSession, model: Model):
    """Column function text -> struct(lang, score, cost, rejected)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, cost double, rejected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return shared.value.judge([None if t is None else t for t in texts])

    return judge


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, cost, rejected) for every row.

    ``lang_pred`` is a learned language, or ``und`` for a text that is null, has no letter, or
    where nothing was learned; such texts have score 0 and are rejected.  Score is the
    calibrated share of the chosen language, from 0 to 1; ties go to the first language in
    code point order.  A text is rejected if its cost per character is above what its
    language's texts cost in calibration, with MARGIN.  Rows are independent: repeated rows
    are judged alike, rows without a doc_id are judged as any other.  Other columns are
    ignored.
    """
    judge = detector(docs.sparkSession, model)
    judged = docs.select(
        F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
        judge(F.col(text).cast("string")).alias("_j"),
    )
    return judged.select(
        "doc_id", "held_out", F.col("_j.lang").alias("lang_pred"), F.col("_j.score").alias("score"),
        F.col("_j.cost").alias("cost"), F.col("_j.rejected").alias("rejected"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
