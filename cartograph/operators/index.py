"""Graph edges and the item -> users inverted index.

The users of an item are cut into parts by one rule for every item and size: part ``p`` holds
the users from ``p * width`` to ``(p + 1) * width - 1``. A row so has at most ``width`` users,
the parts of an item are in order, and the only shuffle of the grouping is on (item, part), so
an item with a third of all edges is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.behavior import DEEP_BEHAVIORS

DEFAULT_PART_WIDTH = 100_000


def deep_edges(clean: DataFrame, behaviors: tuple[str, ...] = DEEP_BEHAVIORS) -> DataFrame:
    """Distinct (item_id, user_id) of deep interactions; negative user ids are not indexed.

    The distinct is a hash aggregate on both columns, so a hot item or user spreads over
    all partitions.
    """
    return (clean.where(F.col("behavior_type").isin(*behaviors) & (F.col("user_id") >= 0))
            .select("item_id", "user_id").distinct())


def item_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("item_id").agg(F.count(F.lit(1)).alias("degree"))


def inverted_index(clean: DataFrame, width: int = DEFAULT_PART_WIDTH) -> DataFrame:
    """(item_id, part, users array<bigint> sorted); users of a part have ids of one range."""
    if width < 1:
        raise ValueError("width must be >= 1")
    tagged = deep_edges(clean).select("item_id", "user_id", F.expr(f"user_id DIV {width}").alias("part"))
    return (tagged.groupBy("item_id", "part")
            .agg(F.sort_array(F.collect_list("user_id")).alias("users")))


def index_lines(index: DataFrame) -> DataFrame:
    """K3 text: ``item<TAB>u1,u2,...`` (one line per item and part)."""
    return index.select(F.concat(F.col("item_id").cast("string"), F.lit("\t"),
                                 F.array_join(F.col("users").cast("array<string>"), ","))
                        .alias("value"))
