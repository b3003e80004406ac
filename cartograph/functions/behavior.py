"""Behaviour codes and their weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the original job's constants) ----
# Valid behaviour codes, exact case.
VALID_BEHAVIORS = ("pv", "cart", "fav", "buy")
# Weight of each behaviour in the per-user score; anything else (pv) weighs 1.
BEHAVIOR_SCORES = {"buy": 4, "cart": 3, "fav": 2}
DEFAULT_SCORE = 1
# Behaviours that make an edge of the user-item graph / the inverted index.
DEEP_BEHAVIORS = ("cart", "fav", "buy")
# Behaviour whose baskets feed the co-occurrence count.
BUY = "buy"
# ---- end of fixed values ----


def behavior_score(col: Column, scores: dict[str, int] | None = None,
                   default: int = DEFAULT_SCORE) -> Column:
    """CASE WHEN chain; stays inside whole-stage codegen."""
    scores = scores or BEHAVIOR_SCORES
    expr = None
    for code, weight in scores.items():
        expr = (F.when(col == code, F.lit(weight)) if expr is None
                else expr.when(col == code, F.lit(weight)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
