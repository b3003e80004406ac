"""Centroid clustering with a progressive Walsh-Hadamard search, in exact integers.

A vector's components become integers ``floor(1024 x)`` and are replaced once by their
Walsh-Hadamard coefficients, ordered from coarse to fine (by their sign changes). The transform
keeps distances up to the factor 64, so the squares of coefficient differences add up to 64 times
the squared distance, and a partial sum is a lower bound of it. The search of a vector

1. adds the coarsest differences of all centroids,
2. finishes the one that leads there, whose distance no nearest centroid can exceed,
3. goes on coarse to fine with the others, leaving out those whose sum is strictly greater,
4. has all 64 coefficients of those that are left; the nearest wins, ties go to the lower number.

A round is one pass over the table of coefficients. A task returns at most one sum per centroid and
coefficient; Spark adds them as decimals, and k x 64 numbers reach the driver, which turns them back
into components (the transform is its own inverse up to 64) and divides.

Defined cases: a vector that is null, has another length, or holds a null, an infinite number or
one beyond ``LIMIT`` has no row. Null vec_ids are kept, and come last in the choice of the first
centroids; rows with equal vec_id come in the order of their coefficients' bytes. Repeated rows count
as often as they come. With fewer than k vectors there are as many centroids as vectors; an empty
table gives an empty result. Distances or sums beyond a long are null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Ends of the coefficient steps of the search.
STEPS = [2, 4, 8, 16, 32, 64]
#: Integers below SAFE in size have distances that fit 64 bits; others, up to LIMIT, are computed as Python integers.
SAFE, LIMIT = 1 << 24, 1 << 56
LONG = (1 << 63) - 1


def walsh() -> np.ndarray:
    """Walsh-Hadamard matrix with its rows from coarse to fine."""
    h = np.ones((1, 1), np.int64)
    while len(h) < DIMENSIONS:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")]


WALSH = walsh()


def exact(w: np.ndarray) -> np.ndarray:
    """The coefficients in a type in which sums of their squares are exact."""
    return w if not w.size or int(np.abs(w).max()) < SAFE * DIMENSIONS else w.astype(object)


def nearest(w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and 64-fold distance of each vector's nearest centroid, from their coefficients."""
    w, c = exact(w), exact(c)
    n, k = len(w), len(c)
    kind = object if object in (w.dtype, c.dtype) else np.int64

    def part(v: np.ndarray, j: np.ndarray, a: int, b: int) -> np.ndarray:
        return ((w[v, a:b] - c[j, a:b]) ** 2).sum(axis=1)
    total = ((w[:, None, :STEPS[0]] - c[None, :, :STEPS[0]]) ** 2).sum(axis=2).astype(kind)
    lead, every = np.argmin(total, axis=1), np.arange(n)
    bound = total[every, lead] + part(every, lead, STEPS[0], DIMENSIONS)
    v, j = np.nonzero(total <= bound[:, None])
    sums = total[v, j]
    for a, b in zip(STEPS, STEPS[1:], strict=False):
        sums = sums + part(v, j, a, b)
        stay = sums <= bound[v]
        v, j, sums = v[stay], j[stay], sums[stay]
    best = np.full((n, k), -1, kind)
    best[v, j] = sums
    # every vector has a centroid left: the one that led, or one at most as far
    best = np.where(best < 0, best.max() + 1 if n else 0, best)
    number = np.argmin(best, axis=1)
    return number, best[every, number]


def coefficients(vectors: DataFrame) -> DataFrame:
    """(vec_id, w): the coefficients of every vector that is kept, as 32- or 64-bit integers."""
    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            column, ids = b.column("v"), b.column("vec_id")
            right = np.flatnonzero(pc.list_value_length(column).fill_null(-1).to_numpy() == DIMENSIONS)
            x = column.take(pa.array(right)).flatten()
            x = x.to_numpy(zero_copy_only=False).astype(float).reshape(-1, DIMENSIONS)  # null: NaN
            with np.errstate(over="ignore"):
                x = np.floor(x * SCALE)
            stay = (np.abs(x) < LIMIT).all(axis=1)  # false for NaN
            w = x[stay].astype(np.int64) @ WALSH.T
            small = np.abs(w).max(axis=1, initial=0) < 1 << 31
            packed = [r.astype("<i4" if s else "<i8").tobytes() for r, s in zip(w, small, strict=True)]
            return pa.RecordBatch.from_arrays([ids.take(pa.array(right[stay])), pa.array(packed, pa.binary())],
                                              ["vec_id", "w"])
        return step
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    return common.map_arrow(kept, make, "vec_id long, w binary")


def unpacked(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.array([np.frombuffer(r, "<i4" if len(r) == 4 * DIMENSIONS else "<i8") for r in rows],
                    np.int64).reshape(-1, DIMENSIONS)


def start(table: DataFrame, k: int = CENTROIDS) -> list[list[int]]:
    """Components of the first centroids: vectors in the order of the hashes of their ids."""
    key = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = table.select(key.alias("key"), "w").orderBy(F.col("key").asc_nulls_last(), "w").limit(k).collect()
    return [components(np.frombuffer(r.w, "<i4" if len(r.w) == 4 * DIMENSIONS else "<i8").tolist()) for r in first]


def components(w: list[int], count: int = 1) -> list[int]:
    """Floor of the components, divided by count, that coefficients (or sums of them) stand for."""
    return [sum(int(s) * x for s, x in zip(column, w, strict=True)) // DIMENSIONS // count
            for column in WALSH.T.tolist()]


def transformed(centroids: list[list[int]]) -> np.ndarray:
    c = np.array(centroids, np.int64).reshape(-1, DIMENSIONS)
    return c @ WALSH.T


def sums(table: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """Vectors, 64-fold distance and coefficient sums of every centroid that has vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, held = transformed(centroids), {}
        for b in batches:
            if not b.num_rows:
                continue
            w = unpacked(b.column("w"))
            number, distance = nearest(w, c)
            for j in np.unique(number).tolist():
                own = number == j
                total = [int(x) for x in exact(w[own]).sum(axis=0)]
                had = held.get(j, (0, 0, [0] * DIMENSIONS))
                held[j] = (had[0] + int(own.sum()), had[1] + sum(map(int, distance[own])),
                           [x + y for x, y in zip(had[2], total, strict=True)])
        rows = [(j, p, Decimal(x)) for j, (n, d, s) in held.items() for p, x in enumerate([n, d, *s])]
        if rows:
            types = [pa.int32(), pa.int32(), pa.decimal128(38, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types, strict=True)],
                                             ["cluster", "place", "x"])
    found: dict[int, list[int]] = {}
    parts = table.select("w").mapInArrow(run, "cluster int, place int, x decimal(38,0)")
    for r in parts.groupBy("cluster", "place").agg(F.sum("x").alias("x")).collect():
        found.setdefault(r.cluster, [0] * (DIMENSIONS + 2))[r.place] = int(r.x)
    return {j: (x[0], x[1], x[2:]) for j, x in found.items()}


def long(x: int) -> int | None:
    return x if x <= LONG else None


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that is kept."""
    table = common.cut(coefficients(vectors))
    centroids = start(table, k)
    for _ in range(rounds if centroids else 0):
        for j, (n, _, total) in sums(table, centroids).items():
            centroids[j] = components(total, n)
    spread = {j: d // DIMENSIONS for j, (_, d, _) in (sums(table, centroids) if centroids else {}).items()}
    inertia = long(sum(spread.values()))
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def make():
        c = transformed(centroids)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            number, distance = nearest(unpacked(b.column("w")), c)
            own = number.tolist()
            columns = [b.column("vec_id"), pa.array(own, pa.int32()),
                       pa.array([long(int(d) // DIMENSIONS) for d in distance], pa.int64()),
                       pa.array([long(spread[j]) for j in own], pa.int64()),
                       pa.array([inertia] * len(own), pa.int64()), pa.array([told[j] for j in own])]
            return pa.RecordBatch.from_arrays(columns, OUT_NAMES)
        return step
    return common.map_arrow(table, make, OUT)


OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]


def op11_walsh_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector of all embeddings: its cluster after ten rounds, and its distance."""
    common.prepare(spark)
    return cluster(common.read(spark, sf_dir, "embeddings"))
