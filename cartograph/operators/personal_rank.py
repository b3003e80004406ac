"""PersonalRank (personalised random walk with restart) on the user-item graph (I4-I6, J1, J2,
A9, A10, U1, U2, P11, P12, T2).

Graph: every distinct deep (item, user) edge in both directions; the degree of a node is its
number of neighbours. Each round

    pr'(v) = alpha * sum over neighbours u of pr(u) / deg(u)  +  (1 - alpha) * [v == target]

starting from 1.0 at the target, for exactly ``iterations`` rounds (no convergence test).
Recommendation: item nodes not seen by the target in the whole clean log (any behaviour),
highest score first, ties by item id; items the walk never reached score 0.0.

Plan. The graph (pairs, node degrees, lists of neighbours) is written once to the shared checkpoint
folder; the lists are kept apart by side and bucketed by their source, so a round joins one row per
node, not one per edge, and only lists that mass reaches are unfolded. Edges lead from one side to
the other, so the walk's k-th power from the target is on one side only, and

    pr_n = (1 - alpha) * sum of alpha^k P^k over k < n  +  alpha^n P^n

needs one direction of the edges a round. The vector of a power holds only nodes with mass, is hashed
onto the buckets, built there as a hash table (no sort of the lists), and its shares are summed by
destination, partially before the shuffle. The plan is the same at every size.

A hot node (one node may own a third of all edges) is cut into ``ceil(deg / max_fanout)``
salted lists, so no single task walks all of its edges; these nodes, at most 2 * edges / max_fanout,
are broadcast. The powers are written to the graph's folder after each round and their
sum every ``checkpoint_every`` rounds: the plan stays small, and a lost executor restarts from there.

``build_graph`` and ``personal_rank`` run jobs while they build their DataFrames; what they
return is valid until ``RankGraph.release``. A graph can be used for many targets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartograph.functions.numeric import significant
from cartograph.functions.text import java_trim
from cartograph.operators import node_ids
from cartograph.operators.index import deep_edges
from cartograph.scratch import Scratch

# ---- fixed values (defaults of the original job) ----
DEFAULT_ALPHA = 0.85
DEFAULT_ITERATIONS = 30
DEFAULT_TOP_N = 10
# ---- end of fixed values ----

DEFAULT_MAX_FANOUT = 50_000
DEFAULT_CHECKPOINT_EVERY = 5
# Edge-table bucket sizing (a round reads each bucket in one task).
EDGES_PER_BUCKET = 2_000_000
SCORE_ORDER_DIGITS = 12

_SRC_KEY = ["src", "salt"]


@dataclass
class RankGraph:
    """Walk graph materialised for the rounds.

    ``lists``: (src, salt, deg, dsts, src_item) in a part for each src_item, bucketed on (src, salt).
    ``nodes``: (is_item, node, degree, nsalt). ``hot``: the nodes with more than one salt.
    """
    lists: DataFrame
    nodes: DataFrame
    hot: DataFrame
    scratch: Scratch | None = None
    table: str | None = None

    @property
    def edges(self) -> DataFrame:
        """(src_item, src, salt, dst_item, dst, dst_nsalt, deg), one row per edge and direction."""
        flat = self.lists.select("src_item", "src", "salt", (~F.col("src_item")).alias("dst_item"),
                                 F.explode("dsts").alias("dst"), "deg")
        salts = self.hot.select(F.col("is_item").alias("dst_item"), F.col("node").alias("dst"), F.col("nsalt").alias("dst_nsalt"))
        return flat.join(F.broadcast(salts), ["dst_item", "dst"], "left").select(
            "src_item", "src", "salt", "dst_item", "dst", F.coalesce("dst_nsalt", F.lit(1).cast("bigint")).alias("dst_nsalt"), "deg")

    def release(self) -> None:
        """Drop the materialised tables and rank vectors (they live in the checkpoint folder)."""
        if self.table:
            self.lists.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.scratch:
            self.scratch.release()
        self.table = self.scratch = None


def directed_edges(item_user: DataFrame) -> DataFrame:
    """(item, user) pairs in both directions as (src_item, src, dst_item, dst)."""
    fwd = item_user.select(F.lit(True).alias("src_item"), F.col("item_id").alias("src"),
                           F.lit(False).alias("dst_item"), F.col("user_id").alias("dst"))
    bwd = item_user.select(F.lit(False).alias("src_item"), F.col("user_id").alias("src"),
                           F.lit(True).alias("dst_item"), F.col("item_id").alias("dst"))
    return fwd.unionByName(bwd)


def node_degrees(item_user: DataFrame) -> DataFrame:
    """(is_item, node, degree) for every node of the graph."""
    return (directed_edges(item_user).groupBy("src_item", "src")
            .agg(F.count(F.lit(1)).alias("degree"))
            .select(F.col("src_item").alias("is_item"), F.col("src").alias("node"), "degree"))


def edge_buckets(spark, n_edges: int) -> int:
    """Bucket count from the measured edge count: about EDGES_PER_BUCKET edges per bucket, at
    least one bucket per core. Spark refuses a table beyond spark.sql.sources.bucketing.maxBuckets."""
    return int(max(spark.sparkContext.defaultParallelism, -(-n_edges // EDGES_PER_BUCKET), 1))


def build_graph(item_user: DataFrame, max_fanout: int = DEFAULT_MAX_FANOUT,
                buckets: int | None = None) -> RankGraph:
    """Node and list tables of the walk, written once to the shared checkpoint folder.

    Every row of ``item_user`` is an edge, so a repeated one weighs as often as it comes.
    Written tables also cut the lineage: a lost executor re-reads files instead of recomputing
    the log.
    """
    if max_fanout < 1:
        raise ValueError("max_fanout must be >= 1")
    spark = item_user.sparkSession
    nsalt = F.greatest(F.lit(1).cast("bigint"),
                       F.ceil(F.col("degree") / F.lit(float(max_fanout))).cast("bigint"))
    scratch = Scratch(spark, "rank-graph")
    # The pairs are written once; nodes and lists both read them back instead of recomputing
    # the log.
    item_user = scratch.cut(item_user.select("item_id", "user_id"), "pairs")
    n_pairs = item_user.count()                   # parquet footers only
    nodes = scratch.cut(node_degrees(item_user).withColumn("nsalt", nsalt), "nodes")
    hot = nodes.where("nsalt > 1")
    # A row's number deals a hot node's edges, repeated ones too, evenly to its lists.
    salts = F.broadcast(hot.select(F.col("is_item").alias("src_item"), F.col("node").alias("src"), "degree", "nsalt"))
    salt = F.coalesce(F.pmod(F.xxhash64("row"), F.col("nsalt")), F.lit(0).cast("bigint"))
    rows = item_user.withColumn("row", F.monotonically_increasing_id())
    ends = rows.select("row", F.inline(F.array(
        F.struct(F.lit(True).alias("src_item"), F.col("item_id").alias("src"), F.col("user_id").alias("dst")),
        F.struct(F.lit(False).alias("src_item"), F.col("user_id").alias("src"), F.col("item_id").alias("dst")))))
    n = buckets or edge_buckets(spark, 2 * n_pairs)
    lists = (ends.join(salts, ["src_item", "src"], "left").select("src_item", "src", salt.alias("salt"), "degree", "dst")
             .repartition(n, *_SRC_KEY).groupBy("src_item", *_SRC_KEY)
             .agg(F.collect_list("dst").alias("dsts"), F.first("degree").alias("degree"))
             .select(*_SRC_KEY, F.coalesce("degree", F.size("dsts")).cast("double").alias("deg"), "dsts", "src_item"))
    table = f"rank_edges_{uuid.uuid4().hex}"
    (lists.write.partitionBy("src_item").bucketBy(n, *_SRC_KEY)
     .option("path", scratch.path("lists")).saveAsTable(table))
    return RankGraph(spark.table(table), nodes, hot, scratch, table)


def _restart(spark, target: int, nsalt: int, mass: float) -> DataFrame:
    """One-row rank vector at the target, built JVM-side (no Python worker per round)."""
    return spark.range(0, 1, 1, 1).select(F.lit(False).alias("is_item"),
                                          F.lit(int(target)).cast("bigint").alias("node"),
                                          F.lit(int(nsalt)).cast("bigint").alias("nsalt"),
                                          F.lit(float(mass)).alias("pr"))


def _shares(pr: DataFrame, graph: RankGraph, alpha: float, item: bool | None = None) -> DataFrame:
    """(is_item, node, pr): what the mass (is_item, node, pr) hands on along every edge.

    Where all mass is on one side, ``item`` names it, and only its lists are read.
    """
    hot = F.broadcast(graph.hot.select("is_item", "node", "nsalt"))
    # The rank row of a hot node is repeated once per salt and meets that salt's list.
    last = F.coalesce(F.col("nsalt"), F.lit(1).cast("bigint")) - 1
    mass = (pr.select("is_item", "node", "pr").where(F.col("pr") != 0).join(hot, ["is_item", "node"], "left")
            .select("is_item", F.col("node").alias("src"), "pr",
                    F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("salt")))
    lists = graph.lists if item is None else graph.lists.where(F.col("src_item") == F.lit(item))
    # Not an equality, so that the join keys are the bucket's.
    own = F.when(F.col("src_item"), F.col("is_item")).otherwise(~F.col("is_item"))
    return lists.join(mass.hint("shuffle_hash"), _SRC_KEY).where(own).select(
        (~F.col("src_item")).alias("is_item"), F.explode("dsts").alias("node"),
        (F.lit(alpha) * (F.col("pr") / F.col("deg"))).alias("pr"))


def _with_salts(pr: DataFrame, graph: RankGraph) -> DataFrame:
    """(is_item, node, nsalt, pr) of (is_item, node, pr)."""
    hot = F.broadcast(graph.hot.select("is_item", "node", "nsalt"))
    return pr.join(hot, ["is_item", "node"], "left").select(
        "is_item", "node", F.coalesce("nsalt", F.lit(1).cast("bigint")).alias("nsalt"), "pr")


def rank_step(pr: DataFrame, graph: RankGraph, target: int, target_nsalt: int = 1,
              alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """One round: (is_item, node, nsalt, pr) -> the same for the next round."""
    restart = _restart(pr.sparkSession, target, target_nsalt, 1.0 - alpha).drop("nsalt")
    return _with_salts(_total([_shares(pr, graph, alpha), restart]), graph)


def _total(parts: list[DataFrame]) -> DataFrame:
    """(is_item, node, pr): the sum of vectors."""
    return reduce(DataFrame.unionByName, parts).groupBy("is_item", "node").agg(F.sum("pr").alias("pr"))


def personal_rank(graph: RankGraph, target: int, iterations: int = DEFAULT_ITERATIONS,
                  alpha: float = DEFAULT_ALPHA,
                  checkpoint_every: int = DEFAULT_CHECKPOINT_EVERY) -> DataFrame:
    """(is_item, node, nsalt, pr) after ``iterations`` rounds; nodes without mass are absent."""
    spark = graph.lists.sparkSession
    power = _restart(spark, target, 1, 1.0).select("is_item", "node", "pr")
    total = power.withColumn("pr", F.col("pr") * (1.0 - alpha if iterations else 1.0))
    parts = [total]
    for i in range(1, iterations + 1):
        power = graph.scratch.cut(_total([_shares(power, graph, alpha, item=i % 2 == 0)]), f"power-{i}")
        parts.append(power.withColumn("pr", F.col("pr") * F.lit(1.0 - alpha if i < iterations else 1.0)))
        if checkpoint_every and i % checkpoint_every == 0 and i < iterations:
            parts = [graph.scratch.cut(_total(parts), f"total-{i}")]
    return _with_salts(_total(parts), graph)


def node_scores(graph: RankGraph, pr: DataFrame) -> DataFrame:
    """Dense vector over the graph nodes: (is_item, node, score), 0.0 where no mass arrived."""
    total = pr.groupBy("is_item", "node").agg(F.sum("pr").alias("pr"))
    return (graph.nodes.select("is_item", "node")
            .join(total, ["is_item", "node"], "left")
            .select("is_item", "node", F.coalesce(F.col("pr"), F.lit(0.0)).alias("score")))


def seen_items(clean: DataFrame, target: int) -> DataFrame:
    """Items the target touched with any behaviour (pv included)."""
    return clean.where(F.col("user_id") == F.lit(target)).select("item_id").distinct()


def recommend(clean: DataFrame, target: int, n: int = DEFAULT_TOP_N,
              iterations: int = DEFAULT_ITERATIONS, alpha: float = DEFAULT_ALPHA,
              max_fanout: int = DEFAULT_MAX_FANOUT, graph: RankGraph | None = None,
              checkpoint_every: int = DEFAULT_CHECKPOINT_EVERY) -> DataFrame:
    """(user_id, rank, item_id, score): the n best unseen items for ``target``.

    The best has the highest score to SCORE_ORDER_DIGITS significant digits, and of equal ones
    the lowest item id. Without a ``graph``, one is built, the n rows are brought to the driver
    and the graph is released.

    The seen set joins as a left-anti join; AQE broadcasts it when its measured size is
    small and keeps a shuffle join otherwise (a hot user may have seen a huge set).
    """
    own_graph = graph is None
    graph = graph or build_graph(deep_edges(clean), max_fanout)
    pr = personal_rank(graph, target, iterations, alpha, checkpoint_every)
    items = (node_scores(graph, pr).where(F.col("is_item"))
             .select(F.col("node").alias("item_id"), "score"))
    cand = items.join(seen_items(clean, target), "item_id", "left_anti")
    order = [significant(F.col("score"), SCORE_ORDER_DIGITS).desc(), F.col("item_id")]
    top = cand.orderBy(*order).limit(n)
    result = top.select(F.lit(target).cast("bigint").alias("user_id"),
                        F.row_number().over(Window.orderBy(*order)).alias("rank"),
                        "item_id", "score")
    if not own_graph:
        return result
    # A graph built here is dropped again: the n result rows (bounded) are materialised
    # first, so the tables in the checkpoint folder do not outlive the call.
    rows = result.collect()
    graph.release()
    return clean.sparkSession.createDataFrame(rows, result.schema)


def seen_items_text(lines: DataFrame, target: str) -> DataFrame:
    """P11/A12 on lines of a clean log with text ids: the items of the lines that begin with the target
    and a comma. Such a line without a second field fails the job."""
    item = java_trim(F.get(F.split("value", ",", -1), F.lit(1)))
    bad = F.raise_error(F.concat(F.lit("no item in clean log line: "), F.col("value")))
    own = lines.where(F.startswith("value", F.lit(f"{target},")))
    return own.select(F.when(F.rtrim(F.col("value"), F.lit(",")) == F.lit(target), bad).otherwise(item).alias("item_id")).distinct()


def recommend_text(edges: DataFrame, seen: DataFrame, target: str, n: int = DEFAULT_TOP_N,
                   iterations: int = DEFAULT_ITERATIONS, alpha: float = DEFAULT_ALPHA,
                   max_fanout: int = DEFAULT_MAX_FANOUT) -> DataFrame:
    """(user_id, rank, item_id, score) like ``recommend``, for text ids of items and users.

    ``edges`` has the texts item_id and user_id, ``seen`` the texts item_id. The texts get dense numbers in their
    own order, so equal scores are ordered by text; the n result rows are brought to the driver, and
    the dictionaries and the graph are removed. A target without edges gets zero-score items.
    """
    spark = edges.sparkSession
    with Scratch(spark, "text-ids") as scratch:
        edges = scratch.cut(edges.select("item_id", "user_id"), "edges")
        items = scratch.cut(node_ids.dictionary(edges.select("item_id"), scratch), "items")
        users = scratch.cut(node_ids.dictionary(edges.select("user_id"), scratch), "users")
        number = node_ids.number_of(users, target)
        graph = build_graph(node_ids.encode(edges, items, users), max_fanout)
        try:
            pr = personal_rank(graph, -1 if number is None else number, iterations, alpha)
            scores = node_scores(graph, pr).where(F.col("is_item")).select(F.col("node").alias("id"), "score")
            known = seen.join(items, seen["item_id"] == items["text"]).select("id")
            order = [significant(F.col("score"), SCORE_ORDER_DIGITS).desc(), F.col("id")]
            top = scores.join(known, "id", "left_anti").orderBy(*order).limit(n) \
                .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
            rows = top.join(items, "id").select("rank", "text", "score").collect()  # n rows
        finally:
            graph.release()
    return spark.createDataFrame([(target, r["rank"], r["text"], r["score"]) for r in sorted(rows)],
                                 "user_id string, rank int, item_id string, score double")


def recommendation_line(top: DataFrame, target: int | str) -> DataFrame:
    """K7 text: ``target<TAB>item:score,...`` with three decimals; ``target<TAB>`` when empty."""
    parts = top.agg(F.sort_array(F.collect_list(F.struct(
        "rank", F.concat(F.col("item_id").cast("string"), F.lit(":"),
                         F.format_string("%.3f", F.col("score"))).alias("s")))).alias("xs"))
    return parts.select(F.concat(F.lit(f"{target}\t"),
                                 F.coalesce(F.array_join(F.col("xs.s"), ","), F.lit("")))
                        .alias("value"))
