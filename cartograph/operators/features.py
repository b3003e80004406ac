"""Per-user features.

raw features per user:  f1 = days since the user's last action, counted back from the
                        latest time in the whole log ((max_ts - last_ts) / 86400.0, where
                        last_ts starts at 0 so negative times clamp to 0),
                        f2 = number of actions, f3 = sum of behaviour scores;
scaled features:        (x - min) / range clamped to [0, 1] over all users; a constant
                        column (range < 1e-12) scales to 0.0.

Plan: one partial+final hash aggregate by user (map-side combine, so a hot user costs one
partial row per map task), then a one-row global aggregate over the per-user table, joined
back as a broadcast of exactly one row. The per-user shuffle is reused by both branches
(ReusedExchange), so the log is scanned once. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.behavior import behavior_score
from cartograph.functions.numeric import minmax_scaled

SECONDS_PER_DAY = 86400.0


def user_activity(clean: DataFrame) -> DataFrame:
    """(user_id, max_ts, last_ts, cnt, score_sum); log rows are not deduplicated.

    The column order matters: with ``last_ts`` next to ``max_ts``, every consumer's pruned
    aggregate lists its functions in the same order (max, count, sum), so the scaling plan
    reuses one per-user shuffle (ReusedExchange) instead of aggregating the log twice.
    """
    agg = clean.groupBy("user_id").agg(
        F.max("ts").alias("max_ts"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum(behavior_score(F.col("behavior_type"))).cast("bigint").alias("score_sum"),
    )
    return agg.select("user_id", "max_ts",
                      F.greatest(F.lit(0).cast("bigint"), F.col("max_ts")).alias("last_ts"),
                      "cnt", "score_sum")


def cutoff_ts(clean: DataFrame) -> DataFrame:
    """A1: one row, the latest time of the whole log (NULL for an empty log)."""
    return clean.agg(F.max("ts").alias("max_ts"))


def _bounds(activity: DataFrame) -> DataFrame:
    """One row with every global value the scaling needs, from the per-user table."""
    return activity.agg(
        F.max("max_ts").alias("cutoff"),
        F.min("last_ts").alias("last_min"), F.max("last_ts").alias("last_max"),
        F.min("cnt").alias("cnt_min"), F.max("cnt").alias("cnt_max"),
        F.min("score_sum").alias("score_min"), F.max("score_sum").alias("score_max"),
    )


def _days(cutoff, last):
    return (cutoff - last).cast("double") / F.lit(SECONDS_PER_DAY)


def raw_features(clean: DataFrame) -> DataFrame:
    """(user_id, f1 days since last action, f2 count, f3 score sum) before scaling."""
    act = user_activity(clean)
    b = _bounds(act).select("cutoff")
    return (act.crossJoin(F.broadcast(b))
            .select("user_id",
                    _days(F.col("cutoff"), F.col("last_ts")).alias("f1"),
                    F.col("cnt").cast("double").alias("f2"),
                    F.col("score_sum").cast("double").alias("f3")))


def feature_bounds(clean: DataFrame) -> DataFrame:
    """A3: one row of min / max of the three raw features."""
    b = _bounds(user_activity(clean))
    return b.select(
        _days(F.col("cutoff"), F.col("last_max")).alias("f1_min"),
        _days(F.col("cutoff"), F.col("last_min")).alias("f1_max"),
        F.col("cnt_min").cast("double").alias("f2_min"),
        F.col("cnt_max").cast("double").alias("f2_max"),
        F.col("score_min").cast("double").alias("f3_min"),
        F.col("score_max").cast("double").alias("f3_max"),
    )


def user_features(clean: DataFrame) -> DataFrame:
    """(user_id, f1, f2, f3) min-max scaled; empty log -> empty result."""
    act = user_activity(clean)
    b = _bounds(act)
    j = act.crossJoin(F.broadcast(b))   # exactly one row on the broadcast side
    f1 = _days(F.col("cutoff"), F.col("last_ts"))
    f1_lo = _days(F.col("cutoff"), F.col("last_max"))
    f1_hi = _days(F.col("cutoff"), F.col("last_min"))
    return j.select(
        "user_id",
        minmax_scaled(f1, f1_lo, f1_hi).alias("f1"),
        minmax_scaled(F.col("cnt").cast("double"), F.col("cnt_min").cast("double"),
                      F.col("cnt_max").cast("double")).alias("f2"),
        minmax_scaled(F.col("score_sum").cast("double"), F.col("score_min").cast("double"),
                      F.col("score_max").cast("double")).alias("f3"),
    )
