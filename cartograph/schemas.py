"""Typed schemas of the data sets that move between the operators."""

from pyspark.sql import types as T

# Clean behaviour log: one validated action per row.
CLEAN_LOG = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("item_id", T.LongType(), False),
    T.StructField("category_id", T.LongType(), False),
    T.StructField("behavior_type", T.StringType(), False),
    T.StructField("ts", T.LongType(), False),
])

FEATURE_COLUMNS = ("f1", "f2", "f3")
