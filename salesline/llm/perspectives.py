"""Multi-party dialogues seen by each participant in turn.

For every participant of a dialogue the whole dialogue is rendered with that speaker as the assistant and
all others as users under their own names; only the assistant's words (and the end mark after them) are
trained on. A rendering is a sequence of segments, one per turn, in the order of ``turn``, ``role``,
``text``: a dialogue of any length stays spread over tasks, and joining the segments of a perspective in
that order gives its text. All work is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM_ROLES = ("system",)
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def clean_name(speaker: Column) -> Column:
    """A speaker's name safe inside a header: the characters of the marks and line breaks become ``_``."""
    return F.regexp_replace(F.coalesce(speaker, F.lit("")), r"[<>|\r\n]", "_")


def safe_text(text: Column) -> Column:
    """Text in which no mark of the format can be read: ``<|`` becomes ``<\\|``; null is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def rotate_perspectives(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system_roles: Sequence[str] = SYSTEM_ROLES,
) -> DataFrame:
    """One row per dialogue, participant and turn: the rendered segment and its training mask.

    Columns: conv_id, turn, speaker (as given), perspective (the participant who is the assistant),
    segment (header, text, end mark), trained (the segment holds the perspective's own words), mask_start
    and mask_end (code points of the segment that are trained on; both 0 if none).

    System turns belong to every perspective and are nobody's; a dialogue of system turns alone has no
    perspective and gives no rows. A null speaker is a participant of its own without a name; null text is
    empty; a null conversation is one conversation; turns that are repeated rows are rendered as often as
    they occur. Other columns are ignored.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(speaker).alias("speaker"), F.col(text).alias("_text")
    ).withColumn("_system", F.coalesce(F.col("speaker").isin(*system_roles), F.lit(False)))
    seats = rows.where(~F.col("_system")).groupBy("conv_id", "speaker").agg(F.lit(1).alias("_seat"))
    seats = seats.select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective"))
    both = rows.join(seats, rows["conv_id"].eqNullSafe(seats["_conv"]))
    own = F.col("speaker").eqNullSafe(F.col("perspective")) & ~F.col("_system")
    head = (
        F.when(F.col("_system"), F.lit(f"{OPEN}system{CLOSE}"))
        .when(own, F.lit(f"{OPEN}assistant{CLOSE}"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), clean_name(F.col("speaker")), F.lit(CLOSE)))
    )
    body = F.concat(safe_text(F.col("_text")), F.lit(END))
    out = both.select("conv_id", "turn", "speaker", "perspective", head.alias("_head"), body.alias("_body"), own.alias("trained"))
    return out.select(
        "conv_id",
        "turn",
        "speaker",
        "perspective",
        F.concat("_head", "_body").alias("segment"),
        "trained",
        F.when(F.col("trained"), F.length("_head")).otherwise(0).alias("mask_start"),
        F.when(F.col("trained"), F.length("_head") + F.length("_body")).otherwise(0).alias("mask_end"),
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role AS speaker, text, coalesce(role IN ('system'), false) AS is_system FROM conversations
), seats AS (SELECT DISTINCT conv_id AS conv, speaker AS perspective FROM rows WHERE NOT is_system),
parts AS (
  SELECT conv_id, turn, speaker, perspective, (speaker IS NOT DISTINCT FROM perspective) AND NOT is_system AS trained,
    CASE WHEN is_system THEN '<|system|>' || chr(10)
         WHEN speaker IS NOT DISTINCT FROM perspective THEN '<|assistant|>' || chr(10)
         ELSE '<|user name=' || regexp_replace(coalesce(speaker, ''), '[<>|\r\n]', '_', 'g') || '|>' || chr(10) END AS head,
    replace(coalesce(text, ''), '<|', '<\|') || '<|end|>' || chr(10) AS body
  FROM rows JOIN seats ON rows.conv_id IS NOT DISTINCT FROM seats.conv
)
SELECT conv_id, turn, speaker, perspective, head || body AS segment, trained,
  CASE WHEN trained THEN length(head) ELSE 0 END::int AS mask_start,
  CASE WHEN trained THEN length(head) + length(body) ELSE 0 END::int AS mask_end
FROM parts
"""
