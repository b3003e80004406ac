"""One user and one item each hold about a third of all rows: every operator still gives
the exact result, with the hot key split (small thresholds make the split paths run)."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cartograph.operators import cooccur as co
from cartograph.operators import index as ix
from cartograph.operators import personal_rank as prk
from cartograph.operators.clean import clean_typed
from cartograph.operators.features import raw_features


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(300):                       # hot user 0 buys 300 items
        rows.append((0, i, 0, "buy", i))
    for u in range(1, 301):                    # hot item 7 bought by 300 users
        rows.append((u, 7, 0, "buy", u))
    for _ in range(300):                       # background
        rows.append((rnd.randrange(1, 60), rnd.randrange(300), 0,
                     rnd.choice(["pv", "cart", "fav", "buy"]), rnd.randrange(1000)))
    schema = "user_id long, item_id long, category_id long, behavior_type string, ts long"
    return rows, clean_typed(spark.createDataFrame(rows, schema).repartition(4))


def test_features_hot_user(skewed):
    rows, log = skewed
    got = {r["user_id"]: r["f2"] for r in raw_features(log).collect()}
    assert got[0] == sum(1 for r in rows if r[0] == 0)


def test_index_hot_item_split(skewed):
    rows, log = skewed
    spark = log.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        idx = ix.inverted_index(log, width=40).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [r for r in idx if r["item_id"] == 7]
    assert len(hot) > 1 and max(len(r["users"]) for r in hot) <= 40
    assert all(u // 40 == r["part"] for r in hot for u in r["users"])
    assert len({r["task"] for r in hot}) > 1
    want = {u for (u, i, _, b, _) in rows if i == 7 and b in ("cart", "fav", "buy") and u >= 0}
    assert {u for r in hot for u in r["users"]} == want


def test_pairs_hot_basket_split(skewed):
    rows, log = skewed
    baskets = {}
    for u, i, _, b, _ in rows:
        if b == "buy":
            baskets.setdefault(u, set()).add(str(i))
    want = {}
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    got = {(r["item_a"], r["item_b"]): r["cnt"] for r in co.pair_counts(log, block_size=25).collect()}
    assert got == want


def test_rank_hot_nodes_salted(skewed):
    rows, log = skewed
    edges = {(i, u) for (u, i, _, b, _) in rows if b in ("cart", "fav", "buy")}
    g = prk.build_graph(ix.deep_edges(log), max_fanout=30)
    assert g.nodes.where('nsalt > 1').count() > 1
    got = {(r["is_item"], r["node"]): r["score"] for r in prk.node_scores(g, prk.personal_rank(g, 0)).collect()}
    nbr = {}
    for i, u in sorted(edges):
        nbr.setdefault((True, i), []).append((False, u))
        nbr.setdefault((False, u), []).append((True, i))
    pr = {n: (1.0 if n == (False, 0) else 0.0) for n in nbr}
    for _ in range(30):
        new = {}
        for n, ns in nbr.items():
            for m in ns:
                new[m] = new.get(m, 0.0) + 0.85 * (pr.get(n, 0.0) / len(ns))
        new[(False, 0)] = new.get((False, 0), 0.0) + 0.15
        pr = new
    assert set(got) == set(pr)
    for k, v in pr.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
    g.release()


def test_repeated_edges_of_a_hot_item_are_cut_into_lines(spark):
    from cartograph.plans import catalog
    log = spark.range(0, 3000, numPartitions=4).selectExpr("if(id % 3 = 0, 1, id) AS item_id", "if(id % 3 = 0, 7, id) AS user_id")
    lines = catalog._repeated_lines(log, 100).collect()
    hot = [r.users for r in lines if r.item_id == 1]
    assert max(map(len, hot)) <= 100 and len(hot) >= 10
    assert sum(map(len, hot)) == log.where("item_id = 1").count()
    assert sum(len(r.users) for r in lines) == 3000
