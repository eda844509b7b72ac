"""Multi-party perspective rotation: each dialogue rendered once for every participant.

For a participant, that speaker's turns become the assistant's and are trained on (mask 1); all others become
turns of a named user (mask 0); system turns stay system turns for everybody.  The result has one row per
(dialogue, participant, turn), so a dialogue of any length is never gathered in one task; ``in_order`` joins
the rows of one dialogue into one text where that is wanted.

Defined cases: a null role is a speaker without a name, rendered as user ``unknown``, and no participant; a null
text renders as an empty turn; null dialogue ids form one dialogue; equal turn numbers are all kept;
a dialogue of system turns alone has no perspective and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Marks around a turn, and how a named user opens it.
OPEN, NAME, CLOSE = "<|im_start|>", " name=", "<|im_end|>\n"
SYSTEM, NOBODY = "system", "unknown"


def rotate(turns: DataFrame, system: str = SYSTEM) -> DataFrame:
    """Rows of (conv_id, turn, role, text) for every perspective.

    conv_id, perspective, turn, speaker, role, name, content, rendered, mask, n_loss_chars (the characters trained on).
    """
    spoken = turns.select("conv_id", "turn", F.col("role").alias("speaker"), F.coalesce("text", F.lit("")).alias("content"))
    people = (
        turns.where(F.col("role").isNotNull() & (F.col("role") != system))
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective"))
        .distinct()
    )
    seen = spoken.join(people, spoken.conv_id.eqNullSafe(people["_conv"])).drop("_conv")
    own = F.col("speaker").eqNullSafe(F.col("perspective"))
    is_system = F.coalesce(F.col("speaker") == system, F.lit(False))
    role = F.when(own, "assistant").when(is_system, "system").otherwise("user")
    name = F.when(~own & ~is_system, F.coalesce("speaker", F.lit(NOBODY)))
    head = F.concat(F.lit(OPEN), "role", F.coalesce(F.concat(F.lit(NAME), "name"), F.lit("")), F.lit("\n"))
    return (
        seen.withColumns({"role": role, "name": name, "mask": own.cast("int")})
        .withColumn("rendered", F.concat(head, "content", F.lit(CLOSE)))
        .select(
            "conv_id", "perspective", "turn", "speaker", "role", "name", "content", "rendered", "mask",
            (F.col("mask") * F.length("content")).cast("long").alias("n_loss_chars"),
        )
    )


def in_order(rotated: DataFrame) -> DataFrame:
    """One row per dialogue and perspective: its whole text and the (start, end) spans that are trained on.

    A dialogue becomes one value here, so this is for dialogues that fit into one.
    """
    turns = F.array_sort(F.collect_list(F.struct("turn", "rendered", "content", "mask")))
    whole = rotated.groupBy("conv_id", "perspective").agg(turns.alias("turns"))
    close = F.lit(len(CLOSE))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, turn):
        after = state.at + F.length(turn.rendered)
        span = F.struct((after - close - F.length(turn.content)).alias("start"), (after - close).alias("end"))
        return F.struct(after.alias("at"), F.when(turn.mask == 1, F.array_append(state.spans, span)).otherwise(state.spans).alias("spans"))

    return whole.select(
        "conv_id", "perspective",
        F.array_join(F.transform("turns", lambda t: t.rendered), "").alias("text"),
        F.aggregate("turns", empty, step, lambda s: s.spans).alias("spans"),
    )
