"""Joins and counts by a key that may hold a third of all rows.

Rows are cut by a hash of another column into ``SALTS`` slices of each key. What is needed from the key
is first brought to the (key, slice) pairs - at most SALTS rows of a key, however many rows it has -
and carried to the rows from there, in groups of one slice. No step has all rows of a key in one
group, whatever joins the planner picks, and no list of hot keys is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def sliced(rows: DataFrame, other: str, salts: int = SALTS) -> DataFrame:
    return rows.withColumn("_slice", F.pmod(F.xxhash64(other), F.lit(salts)).cast("int"))


def lookup(rows: DataFrame, table: DataFrame, key: str, other: str, how: str = "inner",
           salts: int = SALTS) -> DataFrame:
    """rows joined to ``table``, which has one row for a key; rows of a key are told apart by ``other``."""
    cut = sliced(rows, other, salts)
    found = cut.select(key, "_slice").distinct().join(table, key, how)
    return cut.join(found, [key, "_slice"], how).drop("_slice")


def with_group_size(rows: DataFrame, key: str, other: str, name: str, salts: int = SALTS) -> DataFrame:
    """rows with the number of rows of their key: counted by slice, summed over the slices of a key."""
    cut = sliced(rows, other, salts)
    counts = cut.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.withColumn(name, F.sum("_n").over(Window.partitionBy(key))).drop("_n")
    return cut.join(sizes, [key, "_slice"]).drop("_slice")
