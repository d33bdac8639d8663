"""Text to arrays of sentences, by language.

Splitting is a regular expression per row; a language picks one of the
expressions, so a mixed corpus is still a single scan without a shuffle.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from docloom import fixed_values as V
from docloom.functions.text import StrCol, col, strip

Segmenter = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Guarded:
    """A segmenter in Python, ``cut(text, language)``, whose failures stay with their row.

    ``checked`` gives (oraciones, error): what ``cut`` returned, or what it raised.  As a plain
    segmenter it gives NULL for a text that failed.
    """

    cut: Callable[[str, str | None], list[str]]

    def checked(self, text: StrCol, language: StrCol) -> Column:
        return _guarded_udf(self.cut)(col(text), col(language))

    def __call__(self, text: StrCol, language: StrCol) -> Column:
        return self.checked(text, language)["oraciones"]


def _guarded_udf(cut):
    # Row by row: Spark sends a hundred texts at a time, where an Arrow batch holds ten thousand and their sentences.
    @F.udf("oraciones array<string>, error string", useArrow=False)
    def segment(text: str | None, language: str | None) -> tuple:
        try:
            return (list(cut(text, language)) if text is not None else []), None
        except Exception as failure:  # noqa: BLE001 - it becomes the row's error
            return None, str(failure) or type(failure).__name__

    return segment


def _split(text: Column, gap: str) -> Column:
    return F.filter(F.transform(F.split(text, gap), strip), lambda s: s != "")


def punctuation_sentences(text: StrCol) -> Column:
    return _split(col(text), V.SENTENCE_GAP)


def cjk_sentences(text: StrCol) -> Column:
    return _split(col(text), V.CJK_SENTENCE_GAP)


def whole_text(text: StrCol) -> Column:
    """The text as its only sentence, no sentence when it is blank."""
    t = col(text)
    return F.when(strip(t) != "", F.array(t)).otherwise(F.array().cast("array<string>"))


def by_language(text: StrCol, language: StrCol) -> Column:
    """Default routing: Chinese by CJK marks, every other language at punctuation.

    The rule based segmenter of ``RULE_LANGUAGES`` is a library that may be
    absent; ``by_rule_library`` uses it, and this is the same split without it.
    """
    cjk = F.coalesce(F.lower(col(language)).startswith("zh"), F.lit(False))
    return F.when(cjk, cjk_sentences(text)).otherwise(punctuation_sentences(text))


def by_strict_routing(text: StrCol, language: StrCol) -> Column:
    """Like ``by_language``, but a language that is not listed is left whole.

    NULL, regional codes such as ``zh-cn`` and unlisted codes give one sentence.
    """
    lang = col(language)
    return (
        F.when(lang == "zh", cjk_sentences(text))
        .when(lang.isin(*V.RULE_LANGUAGES, *V.PUNCTUATION_LANGUAGES), punctuation_sentences(text))
        .otherwise(whole_text(text))
    )


def rule_library_present() -> bool:
    return importlib.util.find_spec("pysbd") is not None


@cache
def _rule_udf():
    @F.pandas_udf(ArrayType(StringType()))
    def segment(texts: pd.Series, languages: pd.Series) -> pd.Series:
        import pysbd

        segmenters: dict = {}

        def one(text, language):
            if text is None:
                return None
            if language not in segmenters:
                segmenters[language] = pysbd.Segmenter(language=language, clean=False)
            found = (s.strip() for s in segmenters[language].segment(text))
            return [s for s in found if s]

        return pd.Series([one(t, g) for t, g in zip(texts, languages)])

    return segment


def by_rule_library(text: StrCol, language: StrCol) -> Column:
    """Optional: rule based sentences for ``RULE_LANGUAGES``, else strict routing.

    Rows of other languages reach the Python worker as NULL.
    """
    lang = col(language)
    ruled = F.when(lang.isin(*V.RULE_LANGUAGES), col(text))
    return F.coalesce(_rule_udf()(ruled, lang), by_strict_routing(text, lang))
