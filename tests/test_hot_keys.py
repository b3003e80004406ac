"""Joins and counts by a key with a third of all rows, without broadcasts and without adaptive plans;
and scratch storage, which is empty after a call."""
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from cartograph.operators import cooccur as co
from cartograph.operators import kmeans as km
from cartograph.operators import personal_rank as prk
from cartograph.operators import skew
from cartograph.operators.clean import clean_typed
from cartograph.scratch import Scratch, left_over

N = 60_000


@contextmanager
def plain_plans(spark, partitions=12):
    had = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "true"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k, v in had.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def pairs(spark):
    """Item 1 and user 1 have a third of all pairs each."""
    i = F.col("id")
    return spark.range(N).select(F.when(i % 3 == 0, 1).otherwise(i).cast("long").alias("item_id"),
                                 F.when(i % 3 == 1, 1).otherwise(i + 7).cast("long").alias("user_id"))


def per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def assert_even(df, tasks=12):
    n = per_task(df)
    assert len(n) == tasks and n[-1] <= 3 * n[len(n) // 2], n


def test_a_plain_join_would_be_uneven(spark, pairs):
    degrees = pairs.groupBy("item_id").agg(F.count("*").alias("degree"))
    with plain_plans(spark):
        n = per_task(pairs.join(degrees, "item_id"))
        assert n[-1] > 3 * n[len(n) // 2]


@pytest.mark.parametrize("key,other", [("item_id", "user_id"), ("user_id", "item_id")])
def test_degrees_reach_hot_nodes_in_slices(spark, pairs, key, other):
    degrees = pairs.groupBy(key).agg(F.count("*").alias("degree"))
    with plain_plans(spark):
        joined = skew.lookup(pairs, degrees, key, other)
        assert_even(joined)
        assert joined.count() == N
        wrong = joined.groupBy(key).agg(F.count("*").alias("n"), F.max("degree").alias("d"), F.min("degree").alias("e"))
        assert wrong.where("n <> d OR n <> e").count() == 0


def test_lookup_keeps_rows_without_match_on_a_left_join(spark, pairs):
    table = pairs.where("item_id > 10").select("item_id").distinct().withColumn("x", F.lit(1))
    got = skew.lookup(pairs, table, "item_id", "user_id", "left")
    assert got.count() == N and got.where("x IS NULL AND item_id > 10").count() == 0


def test_group_sizes_of_hot_keys(spark, pairs):
    with plain_plans(spark):
        sized = skew.with_group_size(pairs, "user_id", "item_id", "n")
        assert_even(sized)
        want = Counter(r["user_id"] for r in pairs.collect())
        assert {r["user_id"]: r["n"] for r in sized.distinct().collect()} == want
    assert skew.with_group_size(pairs.where("user_id < 0"), "user_id", "item_id", "n").count() == 0


def test_graph_of_hot_nodes_without_broadcast(spark):
    """The edges of a hot item and a hot user, and their degrees, on plain plans."""
    rows = [(1, u) for u in range(200)] + [(i, 0) for i in range(2, 200)] + [(i, i + 1000) for i in range(200)]
    frame = spark.createDataFrame(rows, "item_id long, user_id long").repartition(4)
    before = left_over(spark)
    with plain_plans(spark):
        graph = prk.build_graph(frame, max_fanout=20)
        got = {(r["src_item"], r["src"], r["dst"]): (r["deg"], r["dst_nsalt"]) for r in graph.edges.collect()}
        graph.release()
    deg = Counter([(True, i) for i, _ in rows] + [(False, u) for _, u in rows])
    want = {}
    for i, u in rows:
        want[True, i, u] = (deg[True, i], max(1, -(-deg[False, u] // 20)))
        want[False, u, i] = (deg[False, u], max(1, -(-deg[True, i] // 20)))
    assert got == want
    assert left_over(spark) == before


def test_pairs_of_a_hot_basket_are_even(spark):
    """One user has a third of all purchases; no task of the sizing or of the pairs has most rows."""
    rows = [(0, i) for i in range(600)] + [(u, i) for u in range(1, 401) for i in (u, u + 1, u + 2)]
    log = clean_typed(spark.createDataFrame([(u, i, 0, "buy", 1) for u, i in rows],
                                            "user_id long, item_id long, category_id long, behavior_type string, ts long"))
    with plain_plans(spark, 8):
        found = co.item_pairs(co.buy_baskets(log), block_size=20)
        n = per_task(found)
        assert len(n) == 8 and n[-1] <= 3 * n[4], n
        got = {(r["item_a"], r["item_b"]): r["cnt"] for r in co.pair_counts(log, block_size=20).collect()}
    want = Counter()
    baskets = {}
    for u, i in rows:
        baskets.setdefault(u, []).append(str(i))
    for items in baskets.values():
        items.sort()
        want.update((a, b) for k, a in enumerate(items) for b in items[k + 1:])
    assert got == want


def test_scratch_is_empty_after_every_call(spark, worked_clean):
    from cartograph.operators.features import user_features
    before = left_over(spark)
    assert co.top_pairs(worked_clean).count() == 1
    feats = user_features(worked_clean)
    km.fit(feats, 2)
    prk.recommend(worked_clean, 3)
    assert left_over(spark) == before
    with Scratch(spark, "own") as scratch:
        top = co.top_pairs(worked_clean, scratch=scratch)
        assert len(left_over(spark)) == len(before) + 1 and top.count() == 1
    assert left_over(spark) == before
    scratch.release()                                      # a second time
