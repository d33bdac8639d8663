"""Conversations as training text: every assistant turn is an example of its own.

A conversation is rendered once.  An example is a prefix of that text: all turns before
an assistant turn are its context, and only the reply is trainable, given as a span of
code points.  ``prefix_examples`` writes the prefixes out, one row each; the query reads
every reply back from them by its span.

Turns are marked by control strings.  Where a control string (of this template or of
common others) stands inside a text, its first character becomes an entity; what
looks like an entity is escaped first.  So no text can close its turn, and the
text comes back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import once, prefix_sums, read

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
CONTROL = (
    ROLE, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|endoftext|>",
)
ENTITIES = {"&": "&amp;", "<": "&lt;", "[": "&lb;"}
TRAINABLE = "assistant"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    for entity in ENTITIES.values():
        text = _replace(text, entity, "&amp;" + entity[1:])
    for mark in CONTROL:
        text = _replace(text, mark, ENTITIES[mark[0]] + mark[1:])
    return text


def unescape(text: Column) -> Column:
    for char, entity in list(ENTITIES.items())[::-1]:
        if char != "&":
            # An escaped entity has its ampersand spelled out and so does not match.
            text = _replace(text, entity, char)
    for entity in list(ENTITIES.values())[::-1]:
        text = _replace(text, "&amp;" + entity[1:], entity)
    return text


def format_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, n_turns, formatted, examples) for each conversation.

    ``examples`` holds (turn, start, end, reply) for each assistant turn: its place among the
    turns, from 0, the trainable span of ``formatted`` in code points, end exclusive, and what
    it covers.  ``formatted`` up to ``end`` is the example's whole text.
    Turns are in order of ``turn``, null first, ties by role and text; repeated rows are
    turns of their own.  Null texts and roles are empty.  Rows without conv_id are one
    conversation.  Other columns are ignored.  A conversation is one row and is
    gathered as such.
    """
    blank = F.lit("")
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), blank).alias("role"),
            F.coalesce(F.col(text).cast("string"), blank).alias("text"),
        ).alias("_turn"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    pieces = once(
        gathered, ["conv_id"],
        _pieces=F.transform(
            "_turns",
            lambda t: F.struct(
                F.concat(F.lit(ROLE), escape(t["role"]), F.lit(TEXT)).alias("head"),
                escape(t["text"]).alias("body"), t["role"].alias("role"),
            ),
        ),
    )
    whole = lambda p: F.concat(p["head"], p["body"], F.lit(END))
    lengths = once(
        pieces, ["conv_id", "_pieces"],
        _sizes=F.transform("_pieces", lambda p: F.length(whole(p)).cast("bigint")),
    )
    placed = once(lengths, ["conv_id", "_pieces"], _from=prefix_sums(F.col("_sizes")))
    numbered = F.transform(
        F.arrays_zip(F.col("_pieces").alias("p"), F.col("_from").alias("s")),
        lambda x, i: F.struct(
            i.cast("bigint").alias("turn"),
            (x["s"] + F.length(x["p"]["head"])).alias("start"),
            (x["s"] + F.length(x["p"]["head"]) + F.length(x["p"]["body"])).alias("end"),
            x["p"]["body"].alias("reply"), x["p"]["role"].alias("role"),
        ),
    )
    examples = F.transform(
        F.filter(numbered, lambda e: e["role"] == TRAINABLE),
        lambda e: F.struct(e["turn"].alias("turn"), e["start"].alias("start"), e["end"].alias("end"), e["reply"].alias("reply")),
    )
    return once(
        placed, ["conv_id"],
        n_turns=F.size("_pieces").cast("bigint"),
        formatted=F.array_join(F.transform("_pieces", whole), ""),
        examples=examples,
    )


def prefix_examples(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn, text, loss_start, loss_end): every example written out, context and reply."""
    each = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    return each.select(
        "conv_id", F.col("e.turn").alias("turn"),
        F.substring("formatted", F.lit(1), F.col("e.end").cast("int")).alias("text"),
        F.col("e.start").alias("loss_start"), F.col("e.end").alias("loss_end"),
    )


def loss_texts(examples: DataFrame) -> DataFrame:
    """(conv_id, loss): what the spans of written-out examples cover, unescaped, joined by turn."""
    length = (F.col("loss_end") - F.col("loss_start")).cast("int")
    covered = F.substring("text", (F.col("loss_start") + 1).cast("int"), length)
    replies = examples.select("conv_id", F.struct("turn", unescape(covered).alias("reply")).alias("_reply"))
    gathered = replies.groupBy("conv_id").agg(F.sort_array(F.collect_list("_reply")).alias("_replies"))
    return gathered.select("conv_id", F.array_join(F.transform("_replies", lambda r: r["reply"]), "").alias("loss"))


def turns_of(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted text."""
    # What follows the last end mark is empty.
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring(F.substring_index(p, TEXT, 1), F.lit(len(ROLE) + 1), F.length(p))).alias("role"),
            unescape(
                F.substring(p, F.length(F.substring_index(p, TEXT, 1)) + len(TEXT) + 1, F.length(p))
            ).alias("text"),
        ),
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted_text = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TRAINABLE).alias("role"), F.lit(planted_text).alias("text"),
    )
    formatted = format_conversations(conversations.unionByName(planted))
    # Conversations without a reply have no example.
    loss = loss_texts(prefix_examples(formatted)).select(F.col("conv_id").alias("_loss_id"), F.col("loss").alias("_loss"))
    read_back = once(formatted, ["conv_id", "formatted"], _turns=turns_of(F.col("formatted")))
    rendered = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    whole = read_back.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(rendered, ""), 256).alias("turns_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    met = whole.join(loss, F.col("conv_id").eqNullSafe(F.col("_loss_id")), "left")
    said = F.coalesce(F.col("_loss"), F.lit(""))
    return met.select(
        "conv_id", "n_turns", "turns_sha256",
        F.length(said).cast("bigint").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _sql_escape(column: str) -> str:
    for entity in ENTITIES.values():
        column = f"replace({column}, '{entity}', '&amp;{entity[1:]}')"
    for mark in CONTROL:
        column = f"replace({column}, '{mark}', '{ENTITIES[mark[0]]}{mark[1:]}')"
    return column


SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_sql_escape('role')}) + length({_sql_escape('text')}) + {len(ROLE + TEXT + END)})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
