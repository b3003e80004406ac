"""Deterministic, engine-portable hashing (md5 gives the same hex in Spark and in SQL engines)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_order_key(col: Column, seed: int) -> Column:
    """Pseudo-random but repeatable sort key: md5 of '<seed>:<value>'."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))
