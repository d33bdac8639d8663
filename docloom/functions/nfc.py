"""Unicode NFC, the one text step Spark has no expression for.

Only text holding a character that normalisation can touch is sent to a Python
worker; all other rows travel as NULL, so the scan stays single and the Arrow
traffic is proportional to the text that needs work.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@cache
def touchable_class() -> str:
    """Java character class of every code point that may change or compose.

    Marks by category, and from the Unicode data the others that are not NFC alone
    or stand second in a canonical composition.  The leading intersection lets the
    matcher dismiss the most common characters with one comparison.
    """
    touched = set()
    # Nothing below U+0300 qualifies, and no plane above the third has such characters.
    for cp in range(0x300, 0x40000):
        ch = chr(cp)
        parts = unicodedata.normalize("NFD", ch)
        if unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
            touched.add(cp)
        if len(parts) > 1:
            touched.update(map(ord, parts[1:]))
    ranges: list[list[int]] = []
    for cp in sorted(c for c in touched if unicodedata.category(chr(c))[0] != "M"):
        if ranges and ranges[-1][1] >= cp - 8:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    listed = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)
    return rf"[\x{{300}}-\x{{3ffff}}&&[\p{{M}}{listed}]]"


def _normalise(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@cache
def _udf():
    return F.pandas_udf(_normalise, StringType())


def to_nfc(text: Column) -> Column:
    touched = text.rlike(touchable_class())
    return F.coalesce(_udf()(F.when(touched, text)), text)
