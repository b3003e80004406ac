import random

import pytest

from cartograph.operators import personal_rank as prk
from cartograph.operators.clean import clean_typed
from cartograph.operators.index import deep_edges


def _scores(clean, target, **kw):
    g = prk.build_graph(deep_edges(clean), **kw)
    pr = prk.personal_rank(g, target)
    return {(r["is_item"], r["node"]): r["score"] for r in prk.node_scores(g, pr).collect()}


def test_worked_target_3(worked_clean):
    s = _scores(worked_clean, 3)
    assert s[(False, 3)] == pytest.approx(0.245237546, abs=1e-9)
    assert s[(True, 9)] == pytest.approx(0.331554060, abs=1e-9)
    assert s[(False, 1)] == pytest.approx(0.149404510, abs=1e-9)
    assert s[(False, 2)] == pytest.approx(0.149404510, abs=1e-9)
    assert s[(True, 10)] == pytest.approx(0.124399375, abs=1e-9)
    assert sum(s.values()) == pytest.approx(1.0, abs=1e-12)


def test_worked_recommendations(worked_clean):
    top = prk.recommend(worked_clean, 3)
    assert [(r["rank"], r["item_id"]) for r in top.collect()] == [(1, 10)]
    assert prk.recommendation_line(top, 3).collect()[0]["value"] == "3\t10:0.124"


def test_cold_target_zero_scores(worked_clean):
    top = prk.recommend(worked_clean, 5)
    assert [(r["item_id"], r["score"]) for r in top.orderBy("rank").collect()] == [(9, 0.0), (10, 0.0)]
    assert prk.recommendation_line(top, 5).collect()[0]["value"] == "5\t9:0.000,10:0.000"


def test_everything_seen_gives_empty_line(worked_clean):
    top = prk.recommend(worked_clean, 1)
    assert top.count() == 0
    assert prk.recommendation_line(top, 1).collect()[0]["value"] == "1\t"


def _brute_rank(edges, target, rounds=30, alpha=0.85):
    nbr = {}
    for i, u in edges:
        nbr.setdefault((True, i), []).append((False, u))
        nbr.setdefault((False, u), []).append((True, i))
    pr = {n: (1.0 if n == (False, target) else 0.0) for n in nbr}
    for _ in range(rounds):
        new = {}
        for n, ns in nbr.items():
            for m in ns:
                new[m] = new.get(m, 0.0) + alpha * (pr.get(n, 0.0) / len(ns))
        new[(False, target)] = new.get((False, target), 0.0) + (1 - alpha)
        pr = new
    return pr


def test_salted_hot_nodes_match_brute_force(spark):
    rnd = random.Random(7)
    edges = {(rnd.randrange(30), rnd.randrange(40)) for _ in range(300)}
    edges |= {(0, u) for u in range(40)} | {(i, 3) for i in range(30)}   # hot item and user
    rows = [(u, i, 0, "cart", 1) for i, u in sorted(edges)]
    log = clean_typed(spark.createDataFrame(rows, "user_id long, item_id long, category_id long, "
                                                  "behavior_type string, ts long"))
    want = _brute_rank(sorted(edges), 3)
    for fanout in (4, 50_000):
        got = _scores(log, 3, max_fanout=fanout)
        assert set(got) == set(want)
        for k, v in want.items():
            assert got[k] == pytest.approx(v, abs=1e-12)


def test_scores_below_twelve_decimals_keep_their_order(spark):
    rows = [(u, i, 0, "fav", 1) for u in range(25)
            for i in (u, u + 1, *range(100 * u + 101, 100 * u + 107))]
    log = clean_typed(spark.createDataFrame(rows, "user_id long, item_id long, category_id long, "
                                                  "behavior_type string, ts long"))
    top = prk.recommend(log, 0, n=100).orderBy("rank").collect()
    want = _brute_rank([(i, u) for u, i, *_ in rows], 0)
    items = {i for _, i, *_ in rows} - {i for u, i, *_ in rows if u == 0}
    order = sorted(items, key=lambda i: (-float(f"{want.get((True, i), 0.0):.11e}"), i))
    assert [r["item_id"] for r in top] == order[:100]
    assert min(r["score"] for r in top if r["score"]) < 1e-12


def test_rank_files_are_deleted(worked_clean):
    spark = worked_clean.sparkSession
    before = _left(spark)
    prk.recommend(worked_clean, 3).collect()
    assert _left(spark) == before


def _left(spark):
    return set(_checkpoint_files(spark)), {t.name for t in spark.catalog.listTables()}


def _checkpoint_files(spark):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(f.getPath()) for f in fs.listStatus(path) if "rank-graph" in str(f.getPath())]
