"""Physical-plan properties the scale design relies on."""

import os

import pytest

from cartograph.scratch import Scratch
from cartograph.operators import cooccur as co
from cartograph.operators import personal_rank as prk
from cartograph.operators.clean import clean_text
from cartograph.operators.features import user_features
from cartograph.operators.index import deep_edges
from cartograph.plans.logs import orders_clean
from cartograph.plans.catalog import queries

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def executed(df):
    """The final adaptive plan as text (without the initial plan AQE also prints)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_rank_round_keeps_edges_in_place(worked_clean):
    spark = worked_clean.sparkSession
    g = prk.build_graph(deep_edges(worked_clean))
    # round 1 starts from a literal, which Catalyst folds into a scan filter; test round 2
    first = prk.rank_step(prk._restart(spark, 3, 1, 1.0), g, 3).checkpoint(eager=True)
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = executed(prk.rank_step(first, g, 3))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # at most the rank vector onto the buckets and the partial sums by destination
        assert 1 <= plan.count("Exchange hashpartitioning") <= 2
        assert "Bucketed: true" in plan or "BroadcastHashJoin" in plan
    g.release()


def test_rank_round_has_a_row_per_node(worked_clean):
    """A round joins one list per node, not one row per edge, and sorts none of them."""
    spark = worked_clean.sparkSession
    g = prk.build_graph(deep_edges(worked_clean))
    assert g.lists.count() == g.nodes.count() < g.edges.count()
    first = prk.rank_step(prk._restart(spark, 3, 1, 1.0), g, 3).checkpoint(eager=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(prk.rank_step(first, g, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "Bucketed: true" in plan
    g.release()


def test_one_split_per_line(spark, worked_lines):
    plan = clean_text(worked_lines)._jdf.queryExecution().optimizedPlan().toString()
    # one for each delimiter of the single choice
    assert plan.count("split(") == 2


def test_top_pairs_shuffles_baskets_twice_before_pairing(spark, worked_clean):
    df = co.top_pairs(worked_clean)
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_features_reuse_the_per_user_shuffle(spark):
    plan = executed(user_features(orders_clean(spark, SF)))
    assert "ReusedExchange" in plan


@needs_tables
def test_seen_set_filter_reaches_the_scan(spark):
    df = queries()["seen_items"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,899)" in plan


@needs_tables
def test_top_pairs_is_take_ordered(spark):
    with Scratch(spark) as scratch:
        df = co.top_pairs(orders_clean(spark, SF), scratch=scratch)
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
