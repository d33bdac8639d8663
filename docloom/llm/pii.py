"""Personal data: known forms, and identifiers that only their context gives away.

The known forms are the seeds: each valid span of the text is an instance, with the
spaces it holds.  So is every other number with enough digits that touches no such span:
a word, short groups of digits, or what follows a plus.  The words before an instance's
own word are its lexical patterns: the last one, and the last two.  Patterns and instances form a graph that is scored in rounds: a pattern by the share of its
different instances that are held to be identifiers, an instance by the patterns it
appears in.  Patterns that end with high confidence and enough seeds turn their other
instances into finds.  A pattern takes part only if it announces identifiers: if seeds
follow it in at least half of all its own places in the corpus.  Else a common word before many numbers would vouch for any number.

The graph has one edge for each different pair of pattern and instance, and each round
sums it over either end, combined before the shuffle.  What is found confers: the values found
are seeds of the next hop, in which other words before them can become patterns, until a
hop finds no new value or HOPS are done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut_lineage, once, read
from docloom.llm.spans import SPAN, find, joined, none

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_WORD = r"[^\x20\x09-\x0D]*+"
#: A number that may be an identifier of no known form: what follows a plus, groups of at most five
#: digits with a space between, or a word with a digit or an at sign.
RUN = (
    r"(?<![^\x20\x09-\x0D])(?:"
    rf"[^\x20\x09-\x0D0-9@+]*+\+[0-9][\x20().0-9-]*[0-9]{_WORD}"
    rf"|[^\x20\x09-\x0D0-9@]*+[0-9]{{1,5}}+(?![0-9])(?:\x20[0-9]{{1,5}}+(?![0-9]))++{_WORD}"
    rf"|[^\x20\x09-\x0D0-9@]*+[0-9@]{_WORD})"
)
KINDS = ("email", "ip", "card", "phone", "context")

MIN_DIGITS = 6
ROUNDS = 3
#: So often found values become seeds of further patterns, the first search included.
HOPS = 3
#: A pattern counts from this score and this many different seeds on.
MIN_SCORE, MIN_SEEDS = 0.9, 5
#: Least share of a pattern's places that seeds follow.
MIN_SHARE = 0.5
#: So many seeded patterns are broadcast at most.
LIMIT = 100_000
_CONTEXT = 80
#: A match and the gap before it hold two code points at least, so these many fill the context.
_PIECES = _CONTEXT // 2


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def is_ip(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, r"^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))


def is_card(value: Column) -> Column:
    """14 to 19 digits with a valid check digit."""
    digits = _digits(value)
    fits = F.length(digits).between(14, 19)

    def doubled(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    chars = F.filter(F.split(F.reverse(F.substring(digits, 1, 19)), ""), lambda c: c != "")
    total = F.aggregate(F.transform(chars, doubled), F.lit(0), lambda a, x: a + x)
    return F.when(fits, total % 10 == 0).otherwise(False)


def is_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(10, 15)


def is_number(value: Column) -> Column:
    return F.length(_digits(value)) >= MIN_DIGITS


#: What makes a match of each pattern an instance.
TESTS: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: v.isNotNull(), "ip": is_ip, "card": is_card, "phone": is_phone, "run": is_number,
}


def _fit(kind: str) -> Column:
    """The matches of ``kind`` that pass its test, each with its number."""
    numbered = F.transform(kind, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    return F.filter(numbered, lambda x: TESTS[kind](x["t"]["value"]))


def _pieces(kind: str) -> Column:
    """For each match the one before it and the gap between, both cut to the context's length."""
    tail = lambda c: F.substring(c, -_CONTEXT, _CONTEXT)
    previous = F.concat(F.array(F.lit("")), F.transform(kind, lambda t: tail(t["value"])))
    zipped = F.arrays_zip(previous.alias("p"), F.col(f"{kind}_gaps").alias("g"))
    return F.transform(zipped, lambda x: F.concat(x["p"], tail(x["g"])))


def _instances(kind: str) -> Column:
    """The instances of ``kind``, with the words before their own word and where that begins."""

    def instance(x: Column) -> Column:
        value, start = x["t"]["value"], x["t"]["start"]
        if kind == "run":
            core = F.regexp_extract(value, r"[\p{L}0-9+](?:.*[\p{L}0-9])?", 0)
            start = start + F.instr(value, core) - 1
            value = core
        near = F.slice(
            f"_pieces_{kind}", F.greatest(x["i"] + 2 - _PIECES, F.lit(1)), F.least(x["i"] + 1, F.lit(_PIECES))
        )
        context = F.substring(F.array_join(near, ""), -_CONTEXT, _CONTEXT)
        plain = F.regexp_replace(F.lower(context), r"[0-9]", "0")
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
            F.regexp_extract(plain, r"([^\s]+)\s+[^\s]*+\z", 1).alias("one"),
            F.regexp_replace(
                F.regexp_extract(plain, r"([^\s]+\s+[^\s]+)\s+[^\s]*+\z", 1), r"\s+", " "
            ).alias("two"),
            (x["t"]["start"] - F.length(F.regexp_extract(context, r"[^\s]*+\z", 0))).alias("place"),
            F.lit(kind != "run").alias("seed"),
        )

    return F.transform(f"_fit_{kind}", instance)


def _apart(each: DataFrame) -> DataFrame:
    """Without the instances that touch a seed of their row."""
    row = Window.partitionBy("_row")
    end = F.max(F.when(F.col("seed"), F.col("end"))).over(row.orderBy("start"))
    start = F.min(F.when(F.col("seed"), F.col("start"))).over(row.orderBy(F.desc("start")))
    met = each.withColumn("_end", end).withColumn("_start", start)
    free = F.coalesce(F.col("_end") <= F.col("start"), F.lit(True)) & F.coalesce(
        F.col("_start") >= F.col("end"), F.lit(True)
    )
    return met.where(F.col("seed") | free).drop("_end", "_start")


def _places(rows: DataFrame) -> DataFrame:
    """(pattern): every word of every text, and every two words that follow each other."""
    plain = F.regexp_replace(F.lower("_text"), "[0-9]", "0")
    split = F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = once(rows, [], _words=split)
    following = F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0)))
    zipped = F.arrays_zip(F.col("_words").alias("a"), following.alias("b"))
    # The last word has no partner: null.
    pairs = F.transform(zipped, lambda x: F.concat(x["a"], F.lit(" "), x["b"]))
    return words.select(F.explode(F.concat("_words", pairs)).alias("pattern")).where("pattern is not null")


def announcing(each: DataFrame, rows: DataFrame) -> DataFrame:
    """Patterns that seeds follow in enough of their own places, counted over all texts.

    A place counts once, however many seeds its word holds.  Up to LIMIT seeded patterns
    are sent to the tasks, so only their places are counted; beyond that all places are counted and
    joined by key.
    """
    seeded = (
        each.where("seed").select("_row", "place", "pattern").distinct().groupBy("pattern")
        .agg(F.count("*").alias("_seeds")).where(F.col("_seeds") >= MIN_SEEDS)
    )
    seeded = cut_lineage(seeded)
    places = _places(rows)
    if seeded.limit(LIMIT + 1).count() <= LIMIT:
        places = places.join(F.broadcast(seeded.select("pattern")), "pattern", "left_semi")
    places = places.groupBy("pattern").agg(F.count("*").alias("_places"))
    return (
        seeded.join(places, "pattern").where(F.col("_seeds") >= MIN_SHARE * F.col("_places")).select("pattern")
    )


def scored_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, score, seeds) of distinct ``edges`` (pattern, instance, seed) after the rounds.

    A pattern's score is the confidence of its instances over their number plus one; an
    instance that is no seed is as sure as its patterns together, each missing
    with one minus its score.  Patterns below MIN_SCORE / 2 lend nothing.
    """
    state = edges.withColumn("conf", F.when(F.col("seed"), 1.0).otherwise(0.0))
    for at in range(rounds):
        patterns = state.groupBy("pattern").agg(
            (F.sum("conf") / (F.count("*") + 1)).alias("score"), F.count_if("seed").alias("seeds")
        )
        if at == rounds - 1:
            return patterns
        lend = F.when((F.col("score") >= MIN_SCORE / 2) & (F.col("seeds") >= MIN_SEEDS), F.col("score")).otherwise(0.0)
        lent = edges.join(patterns.select("pattern", lend.alias("_lend")), "pattern")
        sure = lent.groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.col("_lend"))))).alias("_sure"))
        state = edges.join(sure, "instance").withColumn(
            "conf", F.when(F.col("seed"), 1.0).otherwise(F.col("_sure"))
        )
        state = cut_lineage(state.select("pattern", "instance", "seed", "conf"))
    return state


def _found_patterns(each: DataFrame, rows: DataFrame, rounds: int, hops: int) -> DataFrame:
    """(pattern) of high confidence after all hops over ``each`` (_row, place, value, pattern, seed, ...).

    The set only grows, and with it the values found; both stay tables, joined by key.
    """
    good, marked, before = None, each, 0
    for hop in range(hops):
        told = cut_lineage(marked.join(announcing(marked, rows), "pattern", "left_semi"))
        edges = told.select("pattern", F.xxhash64("value").alias("instance"), "seed").distinct()
        strong = scored_patterns(edges, rounds).where((F.col("score") >= MIN_SCORE) & (F.col("seeds") >= MIN_SEEDS))
        strong = strong.select("pattern")
        good = cut_lineage(strong if good is None else good.unionAll(strong).distinct())
        if hop == hops - 1:
            break
        # In the first hop what the patterns tell is known already; later ones add to it.
        among = told if hop == 0 else each
        values = among.where("not seed").join(good, "pattern", "left_semi").select("value").distinct()
        values = cut_lineage(values.withColumn("_known", F.lit(True)))
        now = values.count()
        if now == before:
            break
        before = now
        marked = each.join(values, "value", "left").withColumn(
            "seed", F.col("seed") | F.coalesce("_known", F.lit(False))
        ).drop("_known")
    return good


def detect(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, hops: int = HOPS
) -> DataFrame:
    """(doc_id, base, found): arrays of spans (start, end, kind, value) for every row.

    ``base`` holds valid emails, IP addresses, cards and phones, in this order; ``found``
    the instances of high-confidence patterns that touch no base span, as ``context``.
    A null text is empty and has no spans.  Rows keep their own spans, so repeated and
    null doc_ids are kept as they come; repeated rows add no weight to a pattern, which
    counts different instances.  Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kinds = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "run": RUN}
    marked = find(rows, "_text", kinds, tuple(kinds)).drop("_text")
    fit = once(
        marked, ["doc_id"], **{f"_fit_{k}": _fit(k) for k in kinds}, **{f"_pieces_{k}": _pieces(k) for k in kinds}
    )
    base = F.concat(*[F.transform(f"_fit_{k}", lambda x: x["t"]) for k in KINDS[:4]])
    parts = once(fit, ["doc_id"], base=base, instances=F.concat(*[_instances(k) for k in kinds]))
    # Numbered before they are stored: the number names a row from here on.
    parts = cut_lineage(parts.withColumn("_row", F.monotonically_increasing_id()))
    each = _apart(parts.select("_row", F.explode("instances").alias("i")).select("_row", "i.*"))
    each = each.withColumn("pattern", F.explode(F.array("one", "two"))).where("pattern <> ''")
    good = _found_patterns(each, rows, rounds, hops)
    hits = (
        each.where("not seed")
        .join(good, "pattern", "left_semi")
        .groupBy("_row")
        .agg(F.collect_set(F.struct("start", "end", F.lit("context").alias("kind"), "value")).alias("_hits"))
    )
    return parts.drop("instances").join(hits, "_row", "left").select(
        "doc_id", "base", F.coalesce(F.col("_hits").cast(SPAN), none()).alias("found")
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.concat("base", "found"), KINDS).alias("spans"),
    )
