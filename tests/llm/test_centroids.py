"""Centroid clustering, against plain distances in Python integers."""
import hashlib
import math
import random

import numpy as np
import pytest

from cartograph.llm import centroids

from .conftest import SF

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, w int, x double"


def plain(rows, k=8, rounds=10):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) by every distance in full."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    cs = [c for _, c in first[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(near(x)[1], []).append(x)
        for j, xs in own.items():
            cs[j] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [(i, *near(x)[::-1]) for i, x in kept]
    spread = {}
    for _, j, d in found:
        spread[j] = spread.get(j, 0) + d
    return [(i, j, d, spread[j], sum(spread.values()),
             hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for i, j, d in found]


def order(rows):
    return sorted(rows, key=lambda r: [-1 if x is None else x for x in r])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3.0) for i, v in rows], SCHEMA).repartition(3)


def test_op11_equals_plain_distances(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert order(map(tuple, centroids.op11_walsh_centroids(spark, SF).collect())) == order(plain(rows))


def test_edges(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(64)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]                       # ties and a large group of copies
    rows += [(rows[1][0], rows[1][1])] * 3 + [(200, [0.0] * 64), (201, [1e9] * 64), (202, [-3e9] + [1e-9] * 63)]
    bad = [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63),
           (305, [float("nan")] + [1.0] * 63), (306, [float("inf")] * 64)]
    got = order(map(tuple, centroids.cluster(frame(spark, rows + bad)).collect()))
    assert got == order(plain(rows))
    assert centroids.cluster(frame(spark, bad)).count() == 0
    assert centroids.cluster(frame(spark, bad).where("vec_id < 0")).count() == 0
    few = rows[:3]
    assert order(map(tuple, centroids.cluster(frame(spark, few)).collect())) == order(plain(few))
    null = centroids.cluster(frame(spark, [(None, rows[0][1]), *rows[1:9]])).collect()
    assert len(null) == 9 and sum(r.vec_id is None for r in null) == 1
    assert centroids.cluster(frame(spark, [(1, [1e300] * 64)])).count() == 0   # beyond LIMIT


def test_numbers_beyond_a_long_are_null(spark):
    rows = [(i, [s * 2.0**45] * 64) for i, s in enumerate((1, -1, 1, -1))]
    got = centroids.cluster(frame(spark, rows), k=1).collect()
    assert len(got) == 4 and all(r.inertia is None and r.distance is None for r in got)


@pytest.mark.parametrize("top", [3, 40, 1 << 20, 1 << 40])
def test_search_equals_all_distances(top):
    rng = np.random.default_rng(top)
    x, c = rng.integers(-top, top + 1, (200, 64)), rng.integers(-top, top + 1, (8, 64))
    c[5] = c[2]                                                              # a tie in full
    x[:8] = c
    number, distance = centroids.nearest(x @ centroids.WALSH.T, c @ centroids.WALSH.T)
    every = ((x.astype(object)[:, None, :] - c.astype(object)[None]) ** 2).sum(axis=2)
    assert number.tolist() == [min(range(8), key=lambda j: (r[j], j)) for r in every]
    assert [int(d) for d in distance] == [64 * min(r) for r in every]


def test_transform():
    w = centroids.WALSH
    assert (w @ w.T == 64 * np.eye(64, dtype=int)).all()
    assert [(np.diff(r) != 0).sum() for r in w] == list(range(64))
    x = list(range(-32, 32))
    assert centroids.components((np.array(x) @ w.T).tolist()) == x
