"""Spans of regular expressions in texts, with JVM functions only.

Patterns are Java's; runs are possessive and begin at a run's start, so that no text
makes them slow.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import once, prefix_sums

SPAN = "array<struct<start:bigint,end:bigint,kind:string,value:string>>"


def none(kind: str = SPAN) -> Column:
    return F.array().cast(kind)


def find(df: DataFrame, text: str, patterns: Mapping[str, str], gaps: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a column for each pattern: its leftmost non-overlapping matches as spans.

    ``gaps`` names patterns for which a column ``<name>_gaps`` keeps what lies between
    the matches.
    """
    keep = df.columns
    names = list(patterns)
    hits = {f"_hit_{n}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for n, p in patterns.items()}
    df = once(df, keep, **hits)

    def some(n: str, value: Column, kind: str) -> Column:
        return F.when(F.size(f"_hit_{n}") > 0, value).otherwise(none(kind))

    between = {
        f"{n}_gaps": some(n, F.split(text, p, -1), "array<string>") for n, p in patterns.items()
    }
    df = once(df, [*keep, *hits], **between)
    steps = {
        f"_step_{n}": F.transform(
            F.arrays_zip(F.col(f"{n}_gaps").alias("g"), F.col(f"_hit_{n}").alias("h")),
            # The gap after the last match has no partner.
            lambda x: (F.length(x["g"]) + F.coalesce(F.length(x["h"]), F.lit(0))).cast("bigint"),
        )
        for n in names
    }
    df = once(df, [*keep, *hits, *between], **steps)
    starts = {f"_from_{n}": some(n, prefix_sums(F.col(f"_step_{n}")), "array<bigint>") for n in names}
    df = once(df, [*keep, *hits, *between], **starts)

    def spans(n: str) -> Column:
        zipped = F.arrays_zip(
            F.col(f"_from_{n}").alias("s"), F.col(f"{n}_gaps").alias("g"), F.col(f"_hit_{n}").alias("h")
        )
        return F.transform(
            F.filter(zipped, lambda x: x["h"].isNotNull()),
            lambda x: F.struct(
                (x["s"] + F.length(x["g"])).alias("start"),
                (x["s"] + F.length(x["g"]) + F.length(x["h"])).alias("end"),
                F.lit(n).alias("kind"), x["h"].alias("value"),
            ),
        )

    return once(df, [*keep, *[f"{n}_gaps" for n in gaps]], **{n: spans(n) for n in names})


def valid(spans: str, test: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: test(s["value"]))


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, comma-joined."""
    ranks = F.array(*[F.lit(k) for k in kinds])
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.array_position(ranks, s["kind"]).alias("rank"),
                s["end"].alias("end"), s["kind"].alias("kind"),
            ),
        )
    )
    return F.array_join(
        F.transform(
            ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
