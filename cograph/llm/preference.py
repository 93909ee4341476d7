"""Preference formatting: shared prompt, paired completions, loss masks.

DataFrame functions only.  Chosen and rejected conversations meet turn by turn
on (pair, position); the first position where they differ ends the prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def render(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def numbered(turns: DataFrame, key: str) -> DataFrame:
    """(pair_id, position, role, text): turns of a conversation in the order of
    turn, role, text, numbered from 0.  Null roles are "user", null texts empty;
    a null turn comes first; rows with a null key belong to no conversation."""
    order = Window.partitionBy("pair_id").orderBy("turn", "role", "text")
    rows = turns.select(F.col(f"`{key}`").alias("pair_id"), F.col("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.filter("pair_id is not null").withColumn("position", F.row_number().over(order) - 1).drop("turn")


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask, n_chosen, n_rejected, informative).

    ``chosen`` and ``rejected`` hold numbered turns (see `numbered`).  The
    prompt is the longest common prefix of their turns, rendered once; the
    completions are what follows.  A mask lists [start, end) spans of the
    completion, in characters, that take part in the loss: text and end mark of
    assistant turns.  A side without turns, or that is a prefix of the other,
    has an empty completion; equal sides have two, and ``informative`` is false.
    No rows give none.  One pair's turns are gathered in one row, as its output is.
    """
    side = lambda df, name: df.select("pair_id", "position", F.struct("role", "text").alias(name))
    both = side(chosen, "c").join(side(rejected, "r"), ["pair_id", "position"], "full")
    differs = ~F.col("c").eqNullSafe(F.col("r"))
    turns = both.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("position"))).alias("split"), F.max("position").alias("last"),
        F.array_sort(F.collect_list(F.struct("position", "c", "r"))).alias("turns"))
    turns = turns.withColumn("split", F.coalesce("split", F.col("last") + 1))
    piece = lambda t, s: F.when(t[s].isNotNull(), render(t[s]["role"], t[s]["text"])).otherwise(F.lit(""))
    part = lambda s, keep: F.array_join(F.transform(F.filter("turns", keep), lambda t: piece(t, s)), "")
    in_prompt, after = lambda t: t["position"] < F.col("split"), lambda t: t["position"] >= F.col("split")

    def mask(s: str) -> Column:
        """Spans by a running length: (length so far, spans)."""
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<array<int>>)").alias("spans"))

        def step(acc: Column, t: Column) -> Column:
            head = F.length(F.concat(F.lit("<|im_start|>"), t[s]["role"], F.lit("\n")))
            size = F.length(render(t[s]["role"], t[s]["text"]))
            span = F.array((acc["at"] + head).cast("int"), (acc["at"] + size - 1).cast("int"))
            spans = F.when(t[s]["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct((acc["at"] + size).cast("int").alias("at"), spans.alias("spans"))

        said = F.filter("turns", lambda t: (t["position"] >= F.col("split")) & t[s].isNotNull())
        return F.aggregate(said, start, step, lambda acc: acc["spans"])

    n = lambda s: F.size(F.filter("turns", lambda t: (t["position"] >= F.col("split")) & t[s].isNotNull()))
    return turns.select(
        "pair_id", F.col("split").alias("prompt_turns"), part("c", in_prompt).alias("prompt"),
        part("c", after).alias("chosen"), part("r", after).alias("rejected"),
        mask("c").alias("chosen_mask"), mask("r").alias("rejected_mask"), n("c").alias("n_chosen"), n("r").alias("n_rejected"),
        (F.col("split") <= F.col("last")).alias("informative"))


def mismatched_replies(turns: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """(chosen, rejected) numbered turns for a table that has only good
    conversations: a conversation is chosen; rejected is the same up to its last
    assistant turn, which is replaced by the last assistant turn of the
    conversation whose id differs in the lowest bit.  Without such a partner, or
    without an assistant turn, the rejected side ends there."""
    chosen = numbered(turns, key)
    last = chosen.filter(F.col("role") == "assistant").groupBy("pair_id").agg(F.max("position").alias("last"))
    replies = chosen.join(last, "pair_id").filter(F.col("position") == F.col("last"))
    kept = chosen.join(last, "pair_id", "left").filter(F.col("last").isNull() | (F.col("position") < F.col("last")))
    other = replies.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "role", "text")
    swapped = last.join(other, "pair_id").select("pair_id", F.col("last").alias("position"), "role", "text")
    return chosen, kept.select("pair_id", "position", "role", "text").unionByName(swapped)
