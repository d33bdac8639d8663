"""Secrets in texts: known forms, and windows of high entropy in token-like strings.

Candidate strings are runs of token characters with a digit.  A window slides over a
candidate; the counts of its characters follow by one that enters and one that leaves,
and with them the Shannon entropy.  Each character class has its own alphabet,
window and threshold.  Windows above it that touch are one span.  An allow list takes
candidates out of the entropy spans; spans of known forms stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import once, read
from docloom.llm.spans import find, joined, valid

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
MIN_VALUE = 8

#: Candidates that look random and are no secrets: UUIDs, placeholders, digests that say so, one repeated piece.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]",
    r"(?i)^(sha1|sha256|sha384|sha512|md5)[=_-]",
    r"^(.{1,6})\1+$",
    r"(?i)0123456789|abcdefghij",
)


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    alphabet: str
    window: int
    bits: float
    fold_case: bool = False


#: Thresholds lie between values that a window's counts can give.
CLASSES = (
    CharacterClass("entropy_hex", "0123456789abcdef", 24, 3.0001, True),
    CharacterClass(
        "entropy_base64", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 20, 3.6501
    ),
)
KINDS = ("assign", "access", "hex", *[c.kind for c in CLASSES])


def _runs(codes: Column, cls: CharacterClass) -> Column:
    """(a, b) of every stretch of windows above the threshold; ``codes`` are places in the alphabet, -1 outside.

    A window must hold a digit and another character: numbers and words are neither.
    """
    size, w = len(cls.alphabet), cls.window
    logs = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 1)])
    slots = F.sequence(F.lit(0), F.lit(size - 1))
    empty = F.transform(slots, lambda _: F.lit(0))
    gone = F.slice(F.concat(F.array_repeat(F.lit(-1), w), codes), F.lit(1), F.size(codes))
    steps = F.zip_with(codes, gone, lambda i, o: F.struct(i.alias("i"), o.alias("o")))
    start = F.struct(
        empty.alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("held"), F.lit(0).alias("digits"),
        F.lit(0).alias("at"), F.lit(-1).alias("a"), F.lit(-1).alias("b"),
        F.array().cast("array<struct<a:int,b:int>>").alias("done"),
    )

    def step(state: Column, x: Column) -> Column:
        member, full = x["i"] >= 0, state["held"] == w
        out = F.when(full, x["o"]).otherwise(F.lit(-1))
        same = out == x["i"]

        def moved(count: Column, by: int) -> Column:
            return F.get(logs, count + by) - F.get(logs, count)

        counts = F.when(
            member,
            F.when(same, state["n"]).otherwise(
                F.transform(
                    state["n"],
                    lambda c, k: c + F.when(k == x["i"], 1).otherwise(0) - F.when(k == out, 1).otherwise(0),
                )
            ),
        ).otherwise(empty)
        summed = F.when(
            member,
            F.when(same, state["s"]).otherwise(
                state["s"] + moved(F.get(state["n"], x["i"]), 1)
                + F.when(out >= 0, moved(F.get(state["n"], F.greatest(out, F.lit(0))), -1)).otherwise(0.0)
            ),
        ).otherwise(0.0)
        held = F.when(member, F.least(state["held"] + 1, F.lit(w))).otherwise(0)
        digits = F.when(
            member,
            state["digits"] + F.when(x["i"] < 10, 1).otherwise(0)
            - F.when((out >= 0) & (out < 10), 1).otherwise(0),
        ).otherwise(0)
        return F.struct(
            counts.alias("n"), summed.alias("s"), held.alias("held"), digits.alias("digits"),
            state["at"].alias("at"), state["a"].alias("a"), state["b"].alias("b"), state["done"].alias("done"),
        )

    def judge(state: Column, x: Column) -> Column:
        """Counts first, then the window that ends here, so that nothing is computed twice."""
        nxt = step(state, x)
        return F.element_at(
            F.transform(
                F.array(nxt),
                lambda t: F.struct(
                    t["n"].alias("n"), t["s"].alias("s"), t["held"].alias("held"), t["digits"].alias("digits"),
                    (t["at"] + 1).alias("at"),
                    F.when(_hot(t), F.when(t["b"] >= t["at"] + 1 - w, t["a"]).otherwise(t["at"] + 1 - w))
                    .otherwise(t["a"]).cast("int").alias("a"),
                    F.when(_hot(t), t["at"] + 1).otherwise(t["b"]).cast("int").alias("b"),
                    F.when(
                        _hot(t) & (t["b"] >= 0) & (t["b"] < t["at"] + 1 - w),
                        F.concat(t["done"], F.array(F.struct(t["a"].alias("a"), t["b"].alias("b")))),
                    ).otherwise(t["done"]).alias("done"),
                ),
            ),
            1,
        )

    def _hot(t: Column) -> Column:
        return (
            (t["held"] == w) & (t["digits"] > 0) & (t["digits"] < w)
            & (math.log2(w) - t["s"] / w >= cls.bits)
        )

    def finish(t: Column) -> Column:
        last = F.array(F.struct(t["a"].alias("a"), t["b"].alias("b")))
        return F.when(t["b"] >= 0, F.concat(t["done"], last)).otherwise(t["done"])

    return F.aggregate(steps, start, judge, finish)


def _entropy_spans(candidates: Column, cls: CharacterClass) -> Column:
    def spans(c: Column) -> Column:
        text = F.lower(c["value"]) if cls.fold_case else c["value"]
        codes = F.transform(F.split(text, ""), lambda x: F.instr(F.lit(cls.alphabet), x) - 1)
        codes = F.transform(codes, lambda i: i.cast("int"))
        return F.transform(
            _runs(codes, cls),
            lambda r: F.struct(
                (c["start"] + r["a"]).alias("start"), (c["start"] + r["b"]).alias("end"),
                F.lit(cls.kind).alias("kind"),
                F.substring(c["value"], r["a"] + 1, r["b"] - r["a"]).alias("value"),
            ),
        )

    return F.flatten(F.transform(candidates, spans))


def scan(
    docs: DataFrame, allow: tuple[str, ...] = ALLOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, base, found): arrays of spans (start, end, kind, value) for every row.

    ``base`` holds assignments with a value of MIN_VALUE characters, access keys and long
    hexadecimal strings, in this order; ``found`` what entropy adds, and may overlap it.
    A null text is empty and has no spans.  Rows are independent: repeated and null
    doc_ids are kept as they come.  Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    marked = find(rows, "_text", {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}).drop("_text")
    value = lambda pattern: lambda s: ~s["value"].rlike(pattern)
    left = F.col("candidate")
    for pattern in allow:
        left = F.filter(left, value(pattern))
    long_enough = valid("assign", lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= MIN_VALUE)
    parts = once(marked, ["doc_id"], base=F.concat(long_enough, "access", "hex"), left=left)
    found = F.when(
        F.size("left") > 0, F.concat(*[_entropy_spans(F.col("left"), c) for c in CLASSES])
    ).otherwise(F.slice("base", 1, 0))
    return once(parts, ["doc_id", "base"], found=found)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.concat("base", "found"), KINDS).alias("spans"),
    )
