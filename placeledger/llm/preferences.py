"""Preference formatting of chosen and rejected conversations.

The longest prefix of turns that both conversations share, turn by turn in role and text, is
rendered once as the prompt. What follows is rendered for each side, with a mask that lets
only the assistant's words be trained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TRAINED_ROLE = "assistant"


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit("<|end|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), body(t))), "")


def mask(turns: Column) -> Column:
    """Runs of characters of the rendered turns: (n_chars, trained)."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.length(header(t)).alias("n_chars"), F.lit(False).alias("trained")),
        F.struct(F.length(body(t)).alias("n_chars"), (t["role"] == TRAINED_ROLE).alias("trained")),
    )))


def format_preferences(turns: DataFrame, pair_col: str = "pair_id") -> DataFrame:
    """One row per pair: pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.

    `turns` has the pair's id, side ('chosen' or 'rejected'), turn, role and text. Turns go by
    number, equal numbers by role and text; null numbers come first. Null roles and texts are
    empty. A side without turns, or one that ends where both still agree, has an empty
    completion; two equal sides have two. Rows with another side, or none, are left out. A null
    pair id is an id. A pair's turns meet in one row, because its texts are one row's values.
    """
    def side(name: str) -> Column:
        turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, turn))).alias(name)

    wanted = turns.select(F.col(pair_col).alias("pair_id"), "side", "turn", "role", "text").filter(
        F.col("side").isin("chosen", "rejected"))
    pairs = wanted.groupBy("pair_id").agg(side("chosen"), side("rejected"))
    alike = F.zip_with("chosen", "rejected", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    split = F.array_position(alike, False)
    shared = F.when(split == 0, F.size("chosen")).otherwise(split - 1).cast("int")
    cut = pairs.withColumn("n_prompt_turns", shared)
    rest = {s: F.slice(s, F.col("n_prompt_turns") + 1, F.size(s)) for s in ("chosen", "rejected")}
    cut = cut.select("pair_id", "n_prompt_turns", F.slice("chosen", 1, F.col("n_prompt_turns")).alias("prompt"),
                     rest["chosen"].alias("chosen"), rest["rejected"].alias("rejected"))
    return cut.select(
        "pair_id", "n_prompt_turns", rendered(F.col("prompt")).alias("prompt"), rendered(F.col("chosen")).alias("chosen"),
        rendered(F.col("rejected")).alias("rejected"), mask(F.col("chosen")).alias("chosen_mask"),
        mask(F.col("rejected")).alias("rejected_mask"),
    )


def stale_reply_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of pairs made from conversations: chosen as it is; in the rejected one the last
    assistant turn repeats the assistant turn before it (an empty text if there is none)."""
    trained = F.col("role") == TRAINED_ROLE
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"), F.desc("role"), F.desc("text"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    replies = conversations.select("conv_id", "turn", "role", "text").withColumns({
        "earlier": F.last(F.when(trained, F.coalesce("text", F.lit(""))), ignorenulls=True).over(before),
        "after": F.count(F.when(trained, 1)).over(back.rowsBetween(Window.unboundedPreceding, -1)),
    })
    stale = F.when(trained & (F.col("after") == 0), F.coalesce("earlier", F.lit(""))).otherwise(F.col("text"))
    sides = F.inline(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text")), F.struct(F.lit("rejected").alias("side"), stale.alias("text")),
    ))
    return replies.select(F.col("conv_id").alias("pair_id"), "turn", "role", sides)


def preference_digests(conversations: DataFrame) -> DataFrame:
    """All conversations as pairs, with the masks as text: characters and 1 or 0, run by run."""
    def runs(name: str) -> Column:
        return F.array_join(F.transform(name, lambda m: F.concat(
            m["n_chars"].cast("string"), F.when(m["trained"], ":1").otherwise(":0"))), ",").alias(name)

    return format_preferences(stale_reply_pairs(conversations)).select(
        F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", "rejected", runs("chosen_mask"), runs("rejected_mask"))
