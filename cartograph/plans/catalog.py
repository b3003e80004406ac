"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through a binding (plans.logs) and runs over the whole
tables; the SQL twin of each lives in plans.oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.operators import cooccur as co
from cartograph.operators import features as feat
from cartograph.operators import index as ix
from cartograph.operators import kmeans as km
from cartograph.operators import personal_rank as prk
from cartograph.functions.numeric import significant
from cartograph.plans import exports
from cartograph.scratch import Scratch
from cartograph.plans.logs import events_clean, orders_clean, text_clean
from cartograph.sinks import writers
from cartograph.sources import readers
from cartograph.sources.bindings import read_table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["clean_log_events"] = events_clean
    q["clean_log_orders"] = orders_clean
    q["clean_text"] = text_clean
    q["cutoff_ts"] = lambda s, d: feat.cutoff_ts(orders_clean(s, d))
    q["user_raw_features"] = lambda s, d: feat.raw_features(orders_clean(s, d))
    q["feature_bounds"] = lambda s, d: feat.feature_bounds(orders_clean(s, d))
    q["user_features"] = lambda s, d: feat.user_features(orders_clean(s, d))
    q["user_features_events"] = lambda s, d: feat.user_features(events_clean(s, d))
    q["user_features_text"] = lambda s, d: feat.user_features(text_clean(s, d))
    q["deep_edges"] = lambda s, d: ix.deep_edges(orders_clean(s, d))
    q["item_degree"] = lambda s, d: ix.item_degrees(ix.deep_edges(orders_clean(s, d)))
    q["inverted_index"] = lambda s, d: _index_rows(ix.inverted_index(orders_clean(s, d)))
    q["inverted_index_split"] = lambda s, d: _index_rows(
        ix.inverted_index(events_clean(s, d), width=3))
    q["buy_baskets"] = lambda s, d: co.buy_baskets(orders_clean(s, d))
    q["pair_counts"] = lambda s, d: co.pair_counts(orders_clean(s, d))
    q["pair_counts_split"] = lambda s, d: co.pair_counts(events_clean(s, d), block_size=3)
    q["top_pairs"] = lambda s, d: co.top_pairs(orders_clean(s, d))
    q["top_pairs_events"] = lambda s, d: co.top_pairs(events_clean(s, d))
    q["kmeans_init"] = lambda s, d: km.centers_frame(s, km.init_centers(_feats_b(s, d), K))
    q["kmeans_assign"] = lambda s, d: km.labels(
        _feats_b(s, d), km.init_centers(_feats_b(s, d), K))
    q["kmeans_step"] = _kmeans_step
    q["kmeans_centers"] = lambda s, d: _centres(s, km.fit(_feats_b(s, d), K).centers)
    q["kmeans_labels"] = _kmeans_labels
    q["kmeans_centers_events"] = lambda s, d: _centres(
        s, km.fit(feat.user_features(events_clean(s, d)), K_EVENTS).centers)
    q["kmeans_labels_events"] = lambda s, d: _kmeans_labels(s, d, events=True)
    q["graph_degree"] = lambda s, d: prk.node_degrees(ix.deep_edges(orders_clean(s, d)))
    q["seen_items"] = lambda s, d: prk.seen_items(orders_clean(s, d), TARGET)
    q["pr_step"] = lambda s, d: _pr_scores(s, d, 1)
    q["pr_scores"] = lambda s, d: _pr_scores(s, d, 30)
    q["recommend_top10"] = lambda s, d: _rounded(prk.recommend(orders_clean(s, d), TARGET))
    q["recommend_top10_events"] = lambda s, d: _rounded(
        prk.recommend(events_clean(s, d), TARGET_EVENTS))
    q["recommend_cold_user"] = lambda s, d: _rounded(prk.recommend(orders_clean(s, d), COLD_TARGET))
    q["recommend_chain"] = lambda s, d: _rounded(prk.recommend(_chain_log(s, d), TARGET_CHAIN, n=100))
    q["graph_repeated_edges"] = _repeated_edges
    q["index_text_ids"] = exports.index_text_ids
    q["recommend_text_ids"] = lambda s, d: _rounded(exports.recommend_text_ids(s, d, TARGET_TEXT))
    q["recommend_text_cold"] = lambda s, d: _rounded(exports.recommend_text_ids(s, d, "nobody"))
    q["kmeans_labels_text_ids"] = lambda s, d: _fitted_labels(exports.text_features(s, d), K_EVENTS)
    q["clean_log_revalidated"] = exports.clean_log_revalidated
    q["recommend_line"] = lambda s, d: prk.recommendation_line(
        prk.recommend(orders_clean(s, d), TARGET), TARGET)
    q["clean_lines"] = lambda s, d: writers.clean_lines(orders_clean(s, d))
    q["feature_lines"] = lambda s, d: writers.feature_lines(_feats_b(s, d))
    q["index_lines"] = lambda s, d: ix.index_lines(ix.inverted_index(orders_clean(s, d)))
    q["pair_lines"] = lambda s, d: co.pair_lines(co.top_pairs(orders_clean(s, d)))
    q["center_lines"] = lambda s, d: km.center_lines(
        km.centers_frame(s, km.fit(_feats_b(s, d), K).centers))
    q["label_lines"] = lambda s, d: km.label_lines(_kmeans_labels(s, d))
    q["roundtrip_clean_text"] = exports.roundtrip_clean_text
    q["roundtrip_features_text"] = exports.roundtrip_features_text
    q["roundtrip_index_text"] = exports.roundtrip_index_text
    q["roundtrip_raw_text"] = exports.roundtrip_raw_text
    q["roundtrip_pairs_text"] = exports.roundtrip_pairs_text
    q["roundtrip_centers_text"] = lambda s, d: exports.lines_back(
        s, writers.write_centers_text(km.centers_frame(s, km.fit(_feats_b(s, d), K).centers),
                                      exports.export_dir(s, "centers")))
    q["roundtrip_labels_text"] = lambda s, d: exports.lines_back(
        s, writers.write_labels_text(_kmeans_labels(s, d), exports.export_dir(s, "labels")))
    q["overwrite_twice"] = exports.overwrite_twice
    q["stream_clean_events"] = exports.stream_clean_events
    q["batch_text_recommendation"] = lambda s, d: exports.batch_text_recommendation(
        s, d, TARGET_EVENTS)
    return q


# ---- fixed parameters of the registered queries ----
K = 5
K_EVENTS = 4
TARGET = 899          # binding B user with a full neighbourhood at sf0.01 and sf0.1
TARGET_EVENTS = 7
TARGET_TEXT = "u-8"
TARGET_CHAIN = 1      # its far items have scores below 1e-12
COLD_TARGET = -1      # no row in the log: every item scores 0.0
# ----


def _rounded(top: DataFrame) -> DataFrame:
    return top.select("user_id", "rank", "item_id", significant(F.col("score"), 7).alias("score"))


def _pr_scores(s: SparkSession, d: str, rounds: int) -> DataFrame:
    g = prk.build_graph(ix.deep_edges(orders_clean(s, d)))
    pr = prk.personal_rank(g, TARGET, iterations=rounds)
    scores = prk.node_scores(g, pr).select("is_item", "node", significant(F.col("score"), 7).alias("score"))
    return exports.materialised(scores, g.release)


def _repeated_edges(s: SparkSession, d: str) -> DataFrame:
    """Degrees of the graph of an index whose lines hold every deep action, repeated ones too."""
    log = events_clean(s, d).where(F.col("behavior_type") != "pv")
    path = writers.write_index_text(_repeated_lines(log), exports.export_dir(s, "repeated"))
    edges = readers.read_index_text(s, path, distinct=False)
    return exports.materialised(prk.node_degrees(edges), lambda: exports.delete_path(s, path))


def _repeated_lines(log: DataFrame, width: int = ix.DEFAULT_PART_WIDTH) -> DataFrame:
    """Users of an item in lines of at most `width`: one per run of rows of a scan task, so that a hot
    item, or a hot pair, is spread over many groups."""
    block = F.expr(f"monotonically_increasing_id() DIV {width}")
    return (log.select("item_id", "user_id", block.alias("part")).groupBy("item_id", "part")
            .agg(F.sort_array(F.collect_list("user_id")).alias("users")))


def _chain_log(s: SparkSession, d: str) -> DataFrame:
    """A log from customer keys: user i touches the items i and i + 1 and six items of their own, so
    scores fall steeply along the chain."""
    n = F.col("c_custkey").cast("bigint")
    own = [-(100 * n + j) for j in range(1, 7)]
    item = F.explode(F.array(n, n + 1, *own)).alias("item_id")
    return read_table(s, d, "customer").select(n.alias("user_id"), item).select(
        "user_id", "item_id", F.lit(0).cast("bigint").alias("category_id"), F.lit("fav").alias("behavior_type"),
        F.lit(0).cast("bigint").alias("ts"))


def _feats_b(s: SparkSession, d: str) -> DataFrame:
    return feat.user_features(orders_clean(s, d))


def _centres(s: SparkSession, centres) -> DataFrame:
    df = km.centers_frame(s, centres)
    return df.select("cluster_id", *[F.round(c, 6).alias(c) for c in ("f1", "f2", "f3")])


def _kmeans_step(s: SparkSession, d: str) -> DataFrame:
    f = _feats_b(s, d)
    start = km.init_centers(f, K)
    new, _, sizes = km.lloyd_step(f, start)
    rows = [(i, *[round(v, 9) for v in c], n) for i, (c, n) in enumerate(zip(new, sizes))]
    df = s.createDataFrame(rows, "cluster_id int, f1 double, f2 double, f3 double, n long")
    return df.select("cluster_id", *[F.round(c, 9).alias(c) for c in ("f1", "f2", "f3")], "n")


def _kmeans_labels(s: SparkSession, d: str, events: bool = False) -> DataFrame:
    f = feat.user_features(events_clean(s, d)) if events else _feats_b(s, d)
    return _fitted_labels(f, K_EVENTS if events else K)


def _fitted_labels(f: DataFrame, k: int) -> DataFrame:
    scratch = Scratch(f.sparkSession, "features")
    f = scratch.cut(f)
    return exports.materialised(km.labels(f, km.fit(f, k, cut=False).centers), scratch.release)


def _index_rows(index: DataFrame) -> DataFrame:
    return index.select("item_id", "part", F.size("users").cast("bigint").alias("n_users"),
                        F.array_join(F.col("users").cast("array<string>"), ",").alias("users"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 PersonalRank recommendation for user 7 of the events binding."""
    return _rounded(prk.recommend(events_clean(spark, sf_dir), TARGET_EVENTS))
