"""Log cleaning (P1-P7): raw text lines or typed rows -> validated clean log.

Pure projection + filter: no shuffle, fully inside whole-stage codegen, and a filter on the
result (e.g. one user) is pushed down through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.behavior import VALID_BEHAVIORS
from cartograph.functions.text import java_trim, parse_long, split_fields

CLEAN_COLUMNS = ["user_id", "item_id", "category_id", "behavior_type", "ts"]


def clean_text(lines: DataFrame, value_col: str = "value",
               behaviors: tuple[str, ...] = VALID_BEHAVIORS) -> DataFrame:
    """Parse raw log lines.

    A line is kept when, after trimming, it is not blank and not a header, splits into
    exactly five fields (on commas if it has one, else on whitespace), its trimmed
    behaviour is one of ``behaviors`` (exact case) and the four numeric fields parse as
    signed 64-bit integers. Ids come out canonical ('+7', '007' -> 7).
    """
    line = F.col("_l")
    header = ((line.contains("user_id") & line.contains("timestamp"))
              | line.startswith("user_id") | line.startswith("timestamp"))

    def field(i: int):
        return java_trim(F.try_element_at(F.col("_p"), F.lit(i + 1)))

    # The one-element explode is a barrier: without it every predicate on a field is pushed
    # below the projection with a split of its own.
    staged = (lines.select(java_trim(F.col(value_col)).alias("_l"))
              .where((F.length(line) > 0) & ~header)
              .select(F.explode(F.array(split_fields(line))).alias("_p"))
              .where(F.size("_p") == 5))
    typed = staged.select(
        parse_long(field(0)).alias("user_id"),
        parse_long(field(1)).alias("item_id"),
        parse_long(field(2)).alias("category_id"),
        field(3).alias("behavior_type"),
        parse_long(field(4)).alias("ts"),
    )
    return clean_typed(typed, behaviors)


def clean_typed(log: DataFrame, behaviors: tuple[str, ...] = VALID_BEHAVIORS) -> DataFrame:
    """Validate an already typed log: behaviour in the valid set, no missing id or time."""
    ok = F.col("behavior_type").isin(*behaviors)
    for c in ("user_id", "item_id", "category_id", "ts"):
        ok = ok & F.col(c).isNotNull()
    return log.select(*CLEAN_COLUMNS).where(ok)
