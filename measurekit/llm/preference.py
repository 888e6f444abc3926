"""Preference pairs: one prompt for what two conversations share, and a masked completion of each.

The longest common prefix of turns (role and text equal) is rendered once; what follows it in the chosen and in
the rejected conversation is rendered apart, with the spans of characters that are trained on: the turns of the
assistant. Everything is column expressions on arrays of turns.

Defined results: null conversations count as empty; null roles and texts are rendered as empty text and equal only each other; a
completion may be empty; turns stand in the order of their number, ties by role and text; rows with equal
keys are rows of their own; other columns stay, but those called like an output column are replaced; an
empty table gives an empty table. A conversation is one cell of the result, so its turns do meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: How a turn is written.
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"
ASSISTANT = "assistant"


def assemble(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns array<struct<turn, role, text>>)``, one row per conversation; a null id is a conversation too."""
    one = F.struct(F.col(f"`{turn}`").cast("long").alias("turn"), F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").cast("string").alias("text"))
    return turns.groupBy(F.col(f"`{conv_id}`").alias(conv_id)).agg(F.array_sort(F.collect_list(one)).alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(AFTER_ROLE), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns with equal role and text."""
    shorter = F.least(F.size(a), F.size(b))
    same = lambda i: F.get(a, i)["role"].eqNullSafe(F.get(b, i)["role"]) & F.get(a, i)["text"].eqNullSafe(F.get(b, i)["text"])
    places = F.sequence(F.lit(0), shorter)
    return F.array_min(F.filter(places, lambda i: (i == shorter) | ~same(i)))


def spans(turns: Column) -> Column:
    """``array<struct<start, end>>``: the characters of the rendered turns that are trained on."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    step = lambda state, turn: F.struct(
        (state["at"] + F.length(rendered(turn))).alias("at"),
        F.when(
            turn["role"] == ASSISTANT,
            F.concat(state["found"], F.array(F.struct((state["at"] + F.length(F.lit(OPEN + AFTER_ROLE)) + F.length(turn["role"])).alias("start"), (state["at"] + F.length(rendered(turn))).alias("end")))),
        ).otherwise(state["found"]).alias("found"),
    )
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda state: state["found"])


def format_pairs(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``df`` with ``prompt``, ``n_prompt_turns``, ``chosen_text``, ``chosen_spans``, ``rejected_text``, ``rejected_spans``.

    The inputs are arrays of turns as ``assemble`` makes them; they are not kept.
    """
    outputs = ["prompt", "n_prompt_turns", "chosen_text", "chosen_spans", "rejected_text", "rejected_spans"]
    kept = [c for c in df.columns if c not in (*outputs, chosen, rejected)]
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    a, b = F.coalesce(F.col(f"`{chosen}`"), empty), F.coalesce(F.col(f"`{rejected}`"), empty)
    keys = [F.col(f"`{c}`") for c in kept]
    sides = df.select(F.struct(*keys).alias("row") if keys else F.lit(0).alias("row"), a.alias("a"), b.alias("b"))
    cut = sides.withColumn("n", common_turns(F.col("a"), F.col("b"))).select(
        "row",
        "n",
        F.slice("a", F.lit(1), F.col("n")).alias("shared"),
        F.slice("a", F.col("n") + 1, F.size("a")).alias("a"),
        F.slice("b", F.col("n") + 1, F.size("b")).alias("b"),
    )
    text = lambda c: F.array_join(F.transform(c, rendered), "")
    return cut.select(
        *[F.col(f"row.`{c}`") for c in kept],
        text(F.col("shared")).alias("prompt"),
        F.col("n").cast("long").alias("n_prompt_turns"),
        text(F.col("a")).alias("chosen_text"),
        spans(F.col("a")).alias("chosen_spans"),
        text(F.col("b")).alias("rejected_text"),
        spans(F.col("b")).alias("rejected_spans"),
    )


def with_foreign_answers(conversations: DataFrame, conv_id: str = "conv_id", turns: str = "turns") -> DataFrame:
    """Pairs ``(conv_id, chosen, rejected)`` from plain conversations.

    Chosen is the conversation itself. Rejected has, in place of its last answer and what follows, the last answer of
    the neighbour, whose id differs in the last bit; without such an answer it ends before. A conversation
    without answers is paired with itself.
    """
    last = F.array_max(F.transform(F.col(turns), lambda t, i: F.when(t["role"] == ASSISTANT, i + 1)))
    own = conversations.select(F.col(conv_id), F.col(turns).alias("chosen"), last.alias("place"))
    answers = own.where(F.col("place").isNotNull()).select(
        F.col(conv_id).bitwiseXOR(F.lit(1)).alias("neighbour"), F.get("chosen", F.col("place") - 1)["text"].alias("answer"), F.lit(True).alias("found")
    )
    paired = own.join(answers, F.col(conv_id) == F.col("neighbour"), "left")
    before = F.slice("chosen", F.lit(1), F.col("place") - 1)
    foreign = F.array(F.struct(F.get("chosen", F.col("place") - 1)["turn"].alias("turn"), F.lit(ASSISTANT).alias("role"), F.col("answer").alias("text")))
    rejected = F.when(F.col("place").isNull(), F.col("chosen")).when(F.col("found"), F.concat(before, foreign)).otherwise(before)
    return paired.select(conv_id, "chosen", rejected.alias("rejected"))
