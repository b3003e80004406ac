"""Dense numbers for text ids.

The walk runs on 64-bit numbers. ``dictionary`` numbers the distinct texts of a column from 0 without
gaps, in the order of their UTF-8 bytes: they are range-partitioned and sorted, each task numbers its own
texts, and the counts of the tasks (one row per task) give each task's first number. Nothing is collected.
``encode`` brings the numbers to the edges without a hot group, ``decode`` brings texts back to a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.operators.skew import lookup
from cartograph.scratch import Scratch

_WITHIN = 33  # bits of monotonically_increasing_id that count within a task


def dictionary(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(text, id) of the distinct values of the one column of ``texts``; ids ascend with the texts."""
    column = texts.columns[0]
    distinct = texts.select(F.col(column).alias("text")).where(F.col("text").isNotNull()).distinct()
    placed = scratch.cut(distinct.repartitionByRange("text").sortWithinPartitions("text")
                         .withColumn("_at", F.monotonically_increasing_id()), "dictionary")
    task, within = F.shiftright("_at", _WITHIN), F.col("_at").bitwiseAND((1 << _WITHIN) - 1)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n")) \
        .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return placed.withColumn("_task", task).join(first, "_task") \
        .select("text", (F.col("_first") + within).alias("id"))


def encode(edges: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Text edges (item_id, user_id) as numbers."""
    one = lookup(edges, items.select(F.col("text").alias("item_id"), F.col("id").alias("_item")),
                 "item_id", "user_id")
    both = lookup(one, users.select(F.col("text").alias("user_id"), F.col("id").alias("_user")),
                  "user_id", "_item")
    return both.select(F.col("_item").alias("item_id"), F.col("_user").alias("user_id"))


def number_of(table: DataFrame, text: str) -> int | None:
    """The number of one text, None where the dictionary lacks it."""
    row = table.where(F.col("text") == F.lit(text)).select("id").first()
    return row["id"] if row else None
