"""Multi-party perspective rotation of dialogues, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns of one dialogue are summed up in blocks of so many turn numbers.
BLOCK = 256
SYSTEM, UNKNOWN = "system", "unknown"


def perspective_rotation(turns: DataFrame, system: str = SYSTEM) -> DataFrame:
    """(conv_id, turn, role, text, ...) -> one row per turn and participant's perspective:
    conv_id, perspective, turn, role, name, segment, mask, start, end, mask_start, mask_end.

    For every participant, its own turns are the assistant's, all others are users' under their
    names; ``system`` turns stay system turns and give no perspective.  ``segment`` is the rendered
    turn; segments in the order of ``start`` joined with nothing are the whole dialogue, of which
    ``start`` and ``end`` are code points.  ``mask`` is 1 for turns to learn from, whose content is
    [mask_start, mask_end), the closing mark included.

    Rows without conv_id belong to no dialogue and go; a null role is the participant "unknown"; a
    null text is empty; a null turn comes first; turns with the same number are ordered by role and
    text, repeated rows are rendered each.  An empty table gives an empty result.
    """
    t = (turns.filter("conv_id is not null")
         .select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("name"),
                 F.coalesce("text", F.lit("")).alias("content")))
    speakers = t.filter(F.col("name") != system).select("conv_id", F.col("name").alias("perspective")).distinct()
    role = (F.when(F.col("name") == system, F.lit("system"))
            .when(F.col("name") == F.col("perspective"), F.lit("assistant")).otherwise(F.lit("user")))
    head = F.concat(F.lit("<|im_start|>"), F.col("role"),
                    F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(F.lit("")),
                    F.lit("\n"))
    r = (t.join(speakers, "conv_id").withColumn("role", role).withColumn("head", head)
         .withColumn("segment", F.concat("head", "content", F.lit("<|im_end|>\n")))
         .withColumn("size", F.length("segment").cast("long"))
         .withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK)))
    # running starts in two steps: blocks of turns first, so no task has to hold a whole long dialogue
    up = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (r.groupBy("conv_id", "perspective", "block").agg(F.sum("size").alias("size"))
              .select("conv_id", "perspective", "block", F.coalesce(F.sum("size").over(up), F.lit(0)).alias("before")))
    within = (Window.partitionBy("conv_id", "perspective", "block").orderBy(F.col("turn").asc_nulls_first(), "name", "content")
              .rowsBetween(Window.unboundedPreceding, -1))
    r = (r.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
         .join(blocks, ["conv_id", "perspective", "block"]).withColumn("start", F.col("before") + F.col("local")))
    mine = F.col("role") == "assistant"
    return r.select(
        "conv_id", "perspective", "turn", "role", "name", "segment", mine.cast("int").alias("mask"),
        "start", (F.col("start") + F.col("size")).alias("end"),
        F.when(mine, F.col("start") + F.length("head")).alias("mask_start"),
        F.when(mine, F.col("start") + F.col("size") - 1).alias("mask_end"))
