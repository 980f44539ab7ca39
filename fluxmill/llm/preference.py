"""Preference formatting: the shared turns of two conversations once as prompt, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
TRAINED_ROLE = "assistant"


def conversations_as_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turns) from rows (conv_id, turn, role, text): turns in order, ties by role and text.

    A null turn number comes first, a null role or text is empty, rows without conv_id are left
    out. A repeated row is a turn of its own. A conversation is one value, as it is one example.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    return grouped.select("conv_id", F.transform("all", lambda t: F.struct(t["role"], t["text"])).cast(TURNS).alias("turns"))


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))


TAIL = "<|im_end|>\n"


def render(turns: Column) -> Column:
    """The turns as one string in the chat template."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit(TAIL))), "")


def spans(turns: Column) -> Column:
    """Character ranges [start, end) of render(turns) that are trained on: text and end mark of the trained role."""
    tail = len(TAIL)
    empty = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_head(t["role"]))
        end = begin + F.length(t["text"]) + tail
        mine = F.array(F.struct(begin.alias("start"), end.alias("end")))
        found = F.when(t["role"] == TRAINED_ROLE, F.concat(state["found"], mine)).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(turns, start, step, lambda state: state["found"])


def preference_examples(pairs: DataFrame) -> DataFrame:
    """One row per pair (pair_id, chosen, rejected), both arrays of (role, text):

    n_shared      turns of the longest common prefix, equal in role and text
    prompt        those turns, rendered once
    chosen, rejected              what follows, rendered
    chosen_spans, rejected_spans  ranges of these strings that are trained on; all else is masked
    tie           true where both completions are equal, so that nothing is preferred

    A null conversation has no turns. Nulls inside turns are empty strings. Whatever marks a text
    holds are kept as text. No shuffle.
    """
    clean = lambda c: F.transform(
        F.coalesce(F.col(c), F.array().cast(TURNS)),
        lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")),
    )
    both = pairs.select("pair_id", clean("chosen").alias("a"), clean("rejected").alias("b"))
    n = F.least(F.size("a"), F.size("b"))
    differs = F.array_position(F.transform(F.arrays_zip("a", "b"), lambda z: z["a"].eqNullSafe(z["b"])), False)
    both = both.withColumn("n_shared", F.when(differs == 0, n).otherwise(differs - 1).cast("int"))
    rest = lambda c: F.slice(c, F.col("n_shared") + 1, F.size(c))
    both = both.withColumn("rest_a", rest("a")).withColumn("rest_b", rest("b"))
    return both.select(
        "pair_id",
        "n_shared",
        render(F.slice("a", F.lit(1), F.col("n_shared"))).alias("prompt"),
        render(F.col("rest_a")).alias("chosen"),
        spans(F.col("rest_a")).alias("chosen_spans"),
        render(F.col("rest_b")).alias("rejected"),
        spans(F.col("rest_b")).alias("rejected_spans"),
        (F.col("rest_a") == F.col("rest_b")).alias("tie"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from (conv_id, turns): chosen is the conversation up to its last reply, rejected ends in another's reply.

    The other is conversation 2k+1 for 2k and the reverse. Without one, or without a reply in it,
    the rejected side ends before the reply. A conversation without a reply is its own rejected side.
    """
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == TRAINED_ROLE), True)
    known = conversations.withColumn("last", F.when(F.exists("turns", lambda t: t["role"] == TRAINED_ROLE), last))
    replies = known.where("last is not null").select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
        F.slice("turns", (F.col("last") + 1).cast("int"), F.lit(1)).alias("reply"),
    )
    before = F.slice("turns", F.lit(1), F.col("last").cast("int"))
    return known.join(replies, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"),
        F.when(F.col("last").isNull(), F.col("turns"))
        .otherwise(F.slice("turns", F.lit(1), (F.col("last") + 1).cast("int")))
        .alias("chosen"),
        F.when(F.col("last").isNull(), F.col("turns"))
        .otherwise(F.concat(before, F.coalesce("reply", F.array().cast(TURNS))))
        .alias("rejected"),
    )
