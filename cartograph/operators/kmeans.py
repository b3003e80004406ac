"""Lloyd k-means on the scaled user features.

* Start: the k users first in md5('<seed>:<user_id>') order (ties by user_id) - a
  repeatable pseudo-random pick made by a distributed top-k, so only k rows reach the
  driver. Equal points can both be picked. Fewer than k users is an error.
* Round: every point goes to the nearest centre (Euclidean, strict '<', lowest index wins
  ties); the centres are a one-row frame with an array of k structs, joined as a one-row
  broadcast, so the generated code is the same in every round and for every k. One partial+final aggregate by cluster returns k rows
  of sums and counts; an empty cluster keeps its centre.
* Stop after ``max_iter`` rounds or when the sum of the k centre moves is below ``tol``;
  on convergence the centres from before that last round are kept.

The feature table is written to the shared checkpoint folder before the loop, so each round
reads it instead of recomputing the features, and a lost executor reads its files again; it is
removed when the centres are found. User ids can be of any type: the start order and the labels
go by their text.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.functions.hashing import stable_order_key
from cartograph.functions.numeric import argmin_struct
from cartograph.schemas import FEATURE_COLUMNS
from cartograph.scratch import Scratch

# ---- fixed values (defaults of the original job) ----
DEFAULT_SEED = 42
DEFAULT_MAX_ITER = 30
DEFAULT_TOL = 1e-6
# ---- end of fixed values ----

Center = tuple[float, ...]


@dataclass
class KMeansModel:
    centers: list[Center]
    iterations: int
    converged: bool
    shifts: list[float] = field(default_factory=list)


def init_centers(features: DataFrame, k: int, seed: int = DEFAULT_SEED,
                 cols: tuple[str, ...] = FEATURE_COLUMNS) -> list[Center]:
    if k < 1:
        raise ValueError("k must be >= 1")
    rows = (features.orderBy(stable_order_key(F.col("user_id"), seed), F.col("user_id"))
            .limit(k).select(*cols).collect())
    if len(rows) < k:
        raise ValueError(f"users={len(rows)} < k={k}")
    return [tuple(float(r[c]) for c in cols) for r in rows]


def centers_row(spark: SparkSession, centers: list[Center]) -> DataFrame:
    """One row, ``centers``: array of (i, c), made in the JVM from k rows of numbers."""
    rows = json.dumps([{"i": i, "c": list(map(float, c))} for i, c in enumerate(centers)])
    return spark.range(1).select(F.from_json(F.lit(rows), "array<struct<i:int,c:array<double>>>").alias("_centers"))


def assign(features: DataFrame, centers: list[Center],
           cols: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """features + cluster_id (index of the nearest centre)."""
    nearest = argmin_struct(F.col("_centers"), [F.col(c) for c in cols])
    return features.crossJoin(F.broadcast(centers_row(features.sparkSession, centers))) \
        .withColumn("cluster_id", nearest).drop("_centers")          # exactly one row


def cluster_sums(features: DataFrame, centers: list[Center],
                 cols: tuple[str, ...] = FEATURE_COLUMNS) -> dict[int, tuple[list[float], int]]:
    """cluster -> (vector sum, size); at most k rows come back."""
    agg = (assign(features, centers, cols).groupBy("cluster_id")
           .agg(*[F.sum(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n")))
    return {r["cluster_id"]: ([r[c] for c in cols], r["n"]) for r in agg.collect()}


def update_centers(centers: list[Center], sums: dict[int, tuple[list[float], int]]
                   ) -> tuple[list[Center], float, list[int]]:
    """New centres (empty cluster keeps its centre), total move, cluster sizes."""
    new, shift, sizes = [], 0.0, []
    for i, old in enumerate(centers):
        vec, n = sums.get(i, (None, 0))
        ctr = tuple(v / n for v in vec) if n else tuple(old)
        new.append(ctr)
        sizes.append(n)
        shift += math.dist(old, ctr)
    return new, shift, sizes


def lloyd_step(features: DataFrame, centers: list[Center],
               cols: tuple[str, ...] = FEATURE_COLUMNS) -> tuple[list[Center], float, list[int]]:
    return update_centers(centers, cluster_sums(features, centers, cols))


def fit(features: DataFrame, k: int, max_iter: int = DEFAULT_MAX_ITER, tol: float = DEFAULT_TOL,
        seed: int = DEFAULT_SEED, cols: tuple[str, ...] = FEATURE_COLUMNS,
        cut: bool = True) -> KMeansModel:
    """The centres; ``cut=False`` where the caller has written the features already."""
    data = features.select("user_id", *cols)
    if cut:
        with Scratch(features.sparkSession, "k-means") as scratch:
            return fit(scratch.cut(data), k, max_iter, tol, seed, cols, cut=False)
    centers = init_centers(data, k, seed, cols)
    shifts: list[float] = []
    converged, it = False, 0
    while it < max_iter and not converged:
        it += 1
        new, shift, _ = lloyd_step(data, centers, cols)
        shifts.append(shift)
        if shift < tol:
            converged = True
        else:
            centers = new
    return KMeansModel(centers, it, converged, shifts)


def labels(features: DataFrame, centers: list[Center],
           cols: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """(user_id, cluster_id) - one narrow projection."""
    return assign(features, centers, cols).select("user_id", "cluster_id")


def centers_frame(spark: SparkSession, centers: list[Center],
                  cols: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """The k centres as a DataFrame (cluster_id int, f1, f2, f3)."""
    schema = "cluster_id int, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centers)], schema)


def center_lines(centers: DataFrame, cols: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """K5 text: ``cid<TAB>F1,F2,F3`` with four decimals (Java rounding, point as separator)."""
    nums = [F.format_string("%.4f", F.col(c)) for c in cols]
    return centers.orderBy("cluster_id").select(
        F.concat(F.col("cluster_id").cast("string"), F.lit("\t"), F.concat_ws(",", *nums))
        .alias("value"))


def label_lines(lab: DataFrame) -> DataFrame:
    """K6 text: ``uid,cid``."""
    return lab.select(F.concat_ws(",", F.col("user_id").cast("string"),
                                  F.col("cluster_id").cast("string")).alias("value"))
