"""Chat formatting by perspective rotation, in DataFrame functions only.

Every participant of a conversation takes a turn as the assistant: the dialogue is rendered
once for each, with that speaker's turns as the assistant's, the turns of all others as
named users' and system turns as they are. The mask of a rendering is the list of character
spans that the chosen speaker wrote, closing marker included, which is what a model learns.

A rendering is one row. A dialogue of more than `part_chars` characters is several: a new
part starts with the turn at which the turns so far (text and a fixed allowance) pass the
next multiple of it, at the same turns for every speaker, and spans count from the start of
their part. So no row and no group is larger than a part and one turn, whatever the length
of a conversation. The running length that places the turns spans tasks (`running_totals`); ranges are
cut by turn and speaker, so no text reaches the driver.

Edge cases: a null text is empty. A turn without a speaker is a nameless user's, and its
speaker is no participant; neither is the system, so a conversation without any other speaker
has no rendering. Turns without a conversation id form one conversation. Turns come in the
order of their number (null first), speaker and text; repeated rows are repeated turns. Other columns are
not read and may have any names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldergrid.operators.layout import Running, running_totals

SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PART_CHARS = 1 << 20
TURN_ALLOWANCE = 64   # characters that a turn counts for besides its text


def rotate(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """conversation, `perspective`, `part`, `n_turns`, `n_own` (turns of the perspective),
    `rendered` and `spans` (array<struct<start, end>> of `rendered` to learn)."""
    said = turns.select(
        F.col(conversation).alias("_c"), F.col(turn).alias("_t"), F.col(speaker).alias("_s"), F.coalesce(text, F.lit("")).alias("_x")
    ).withColumn("_size", F.length("_x") + F.lit(TURN_ALLOWANCE))
    order = ["_t", "_s", "_x"]
    placed = running_totals(said, [Running("_before", ("_c",), "_size")], order, range_by=order[:2]).withColumn(
        "part", F.floor(F.col("_before") / F.lit(part_chars)).cast("int")
    )
    people = said.where(F.col("_s").isNotNull() & (F.col("_s") != SYSTEM)).select(
        F.col("_c").alias("_pc"), F.col("_s").alias("perspective")
    ).distinct()
    views = placed.join(people, F.col("_c").eqNullSafe(F.col("_pc"))).drop("_pc", "_size")
    own = F.coalesce(F.col("_s") == F.col("perspective"), F.lit(False))
    head = (
        F.when(own, F.lit("assistant")).when(F.col("_s") == SYSTEM, F.lit(SYSTEM))
        .when(F.col("_s").isNull(), F.lit("user")).otherwise(F.concat(F.lit("user name="), F.col("_s")))
    )
    segments = views.withColumn("_own", own).withColumn("_head", F.concat(F.lit(OPEN), head, F.lit("\n"))).withColumn(
        "_segment", F.concat("_head", "_x", F.lit(CLOSE + "\n"))
    )
    group = ["_c", "perspective", "part"]
    # of turns that are equal in every column it does not matter which comes first
    earlier = Window.partitionBy(*group).orderBy("_before", *order).rowsBetween(Window.unboundedPreceding, -1)
    at = segments.withColumn("_at", F.coalesce(F.sum(F.length("_segment")).over(earlier), F.lit(0)))
    start = F.col("_at") + F.length("_head")
    span = F.struct(start.alias("start"), (start + F.length("_x") + F.lit(len(CLOSE))).alias("end"))
    return at.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_turns"), F.count_if("_own").alias("n_own"),
        F.array_sort(F.collect_list(F.struct("_at", "_segment"))).alias("_parts"),
        F.array_sort(F.collect_list(F.when(F.col("_own"), span))).alias("spans"),
    ).select(
        F.col("_c").alias(conversation), "perspective", "part", "n_turns", "n_own",
        F.array_join(F.transform("_parts", lambda p: p["_segment"]), "").alias("rendered"), "spans",
    )
