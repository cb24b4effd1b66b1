"""Preference formatting: shared prompt, paired masked completions.

Only DataFrame functions. A pair is two conversations; their longest common
prefix of turns is rendered once as the prompt, the turns after it as the
chosen and the rejected completion. A mask lists the character spans of a
completion that are trained on: what the assistant said, with its end mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
ASSISTANT = "assistant"


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as array<struct<role, text>>.

    A conversation becomes one row, as the rendered text it turns into is one.
    A null role or text counts as empty; turns of equal number are in order of
    role and text, and repeated ones stay. Rows without a conversation id are
    no conversation.
    """
    parts = F.struct(F.col(f"`{turn}`").cast("long").alias("turn"),
                     F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    gathered = (turns.select(F.col(f"`{conv}`").alias("conv_id"), parts.alias("part"))
                .filter("conv_id is not null").groupBy("conv_id")
                .agg(F.sort_array(F.collect_list("part")).alias("turns")))
    return gathered.select("conv_id", F.transform(
        "turns", lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text")))
        .alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(END))


def trained_spans(turns: Column) -> Column:
    """array<struct<start, end>>: characters of the rendered turns that carry loss."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def add(state, turn):
        whole = F.length(rendered(turn))
        said = F.length(turn["text"]) + F.lit(len(END))
        span = F.struct((state["at"] + whole - said).cast("int").alias("start"),
                        (state["at"] + whole).cast("int").alias("end"))
        return F.struct((state["at"] + whole).cast("int").alias("at"),
                        F.when(turn["role"] == ASSISTANT, F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(turns, begin, add, lambda state: state["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected), both array<struct<role, text>>, as training rows.

    Gives pair_id, n_prompt_turns, prompt, chosen, rejected and their masks. A
    null side counts as a conversation without turns. Where one side is a
    prefix of the other its completion is empty and its mask too; where both
    are equal, all is prompt. Other columns are dropped.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.select("pair_id", F.coalesce("chosen", empty).alias("c"),
                        F.coalesce("rejected", empty).alias("r"))
    shortest = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", F.lit(1), shortest), F.slice("r", F.lit(1), shortest),
                      lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))
    first_other = F.array_position(same, False)
    both = both.withColumn("n", F.when(first_other > 0, first_other - 1).otherwise(shortest)
                           .cast("int"))
    rest = {side: F.slice(side, F.col("n") + 1, F.size(side)) for side in ("c", "r")}
    text = {side: F.array_join(F.transform(turns, rendered), "") for side, turns in rest.items()}
    prompt = F.array_join(F.transform(F.slice("c", F.lit(1), F.col("n")), rendered), "")
    return both.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), prompt.alias("prompt"),
        text["c"].alias("chosen"), text["r"].alias("rejected"),
        trained_spans(rest["c"]).alias("chosen_mask"),
        trained_spans(rest["r"]).alias("rejected_mask"))


def branch_pairs(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Pairs from plain conversations, one for each: (pair_id, chosen, rejected).

    The chosen side is the conversation. The rejected side keeps its first
    turns, all but the last (pair_id mod number of turns) + 1, and goes on with
    what the conversation of the neighbouring id (2n and 2n+1) has there, as
    mismatched answers are a usual source of rejected ones. Without a
    neighbour the rejected side ends there.
    """
    told = conversations(turns, conv).select(F.col("conv_id").cast("long").alias("pair_id"),
                                             F.col("turns").alias("chosen"))
    beside = told.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"),
                         F.col("chosen").alias("other"))
    cut = F.size("chosen") - 1 - F.pmod("pair_id", F.size("chosen"))
    joined = told.join(beside, "pair_id", "left").withColumn("cut", cut.cast("int"))
    tail = F.when(F.size("other") > F.col("cut"),
                  F.slice("other", F.col("cut") + 1, F.size("other")))
    return joined.select("pair_id", "chosen", F.concat(
        F.slice("chosen", F.lit(1), F.col("cut")),
        F.coalesce(tail, F.slice("chosen", F.lit(1), F.lit(0)))).alias("rejected"))
