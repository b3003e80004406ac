"""Item co-occurrence: number of users who bought both items of a pair.

Items of a pair are compared as text (so "10" sorts before "9") and each unordered pair is
counted once per user.

Plan. Pairs are made in the task from lists of bounded length, and counted there by item ids:

* a user with at most ``block_size`` distinct items is one list, and every item of it is paired
  with the items behind it;
* a hot basket is cut into ``ceil(n / block_size)`` blocks by a hash of the item, and each item
  is sent once for every block that its own one meets. Every block pair of the user is a group
  of its own, of two lists of about block_size items, so a basket with a third of all rows is
  spread over many tasks instead of one, and no list grows with the basket;
* one shuffle brings the lists together; there is no join of basket rows. The pairs are
  generated from the lists inside the stage of the partial aggregate and are never sent: a task
  sends one partial count for each of its distinct pairs;
* ids are the keys of that aggregate and its shuffle. An item has one text, so the counts by ids
  are those by texts; the texts and their order are made once per counted pair.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartograph.functions.behavior import BUY
from cartograph.operators.skew import with_group_size
from cartograph.scratch import Scratch

DEFAULT_BLOCK_SIZE = 2_000
DEFAULT_TOP_N = 1000


def _bought(clean: DataFrame) -> DataFrame:
    """Distinct (user_id, item) of purchases, item as its id; negative users dropped."""
    return (clean.where((F.col("behavior_type") == BUY) & (F.col("user_id") >= 0))
            .select("user_id", F.col("item_id").alias("item")).distinct())


def buy_baskets(clean: DataFrame) -> DataFrame:
    """Distinct (user_id, item) of purchases; item as text; negative users dropped."""
    return _bought(clean).select("user_id", F.col("item").cast("string").alias("item"))


def basket_lists(baskets: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE, items: int | None = None) -> DataFrame:
    """(user_id, lo, hi, xs, ys): the items of two blocks of a user; ys is empty where lo = hi.

    ``items`` is the number of distinct items in the baskets where it is known; no basket of so few is cut.
    """
    zero = F.lit(0).cast("bigint")
    if items is not None and items <= block_size:
        lists = baskets.groupBy("user_id").agg(F.collect_list("item").alias("xs"))
        return lists.select("user_id", zero.alias("lo"), zero.alias("hi"), "xs", F.slice("xs", 1, 0).alias("ys"))
    # Items are counted by (user, slice) first, then the slices of a user; the sum reaches the rows
    # by (user, slice), so a hot basket is never one group.
    sized = with_group_size(baskets, "user_id", "item", "n_items").select(
        "user_id", "item", F.ceil(F.col("n_items") / F.lit(float(block_size))).cast("bigint").alias("nb"))
    blk = F.when(F.col("nb") > 1, F.pmod(F.xxhash64("item"), F.col("nb"))).otherwise(zero)
    met = sized.withColumn("blk", blk).select(
        "user_id", "item", "blk", F.explode(F.sequence(zero, F.col("nb") - 1)).alias("other"))
    lo, hi = F.least("blk", "other"), F.greatest("blk", "other")
    sides = met.select("user_id", lo.alias("lo"), hi.alias("hi"), F.when(F.col("blk") == lo, F.col("item")).alias("x"),
                       F.when(F.col("blk") > lo, F.col("item")).alias("y"))
    return sides.groupBy("user_id", "lo", "hi").agg(F.collect_list("x").alias("xs"), F.collect_list("y").alias("ys"))


def item_pairs(baskets: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE, items: int | None = None) -> DataFrame:
    """One row (item_a, item_b) per user and unordered pair of distinct items, item_a < item_b in the
    order of the items' type; ``items`` as in ``basket_lists``."""
    if block_size < 1:
        raise ValueError("block_size must be >= 1")
    lists = basket_lists(baskets, block_size, items)
    behind = F.slice("xs", F.col("p") + 2, F.size("xs"))
    y = F.explode(F.when(F.col("lo") == F.col("hi"), behind).otherwise(F.col("ys"))).alias("y")
    return lists.select("lo", "hi", "xs", "ys", F.posexplode("xs").alias("p", "x")).select("x", y) \
        .select(F.least("x", "y").alias("item_a"), F.greatest("x", "y").alias("item_b"))


def _counted(pairs: DataFrame) -> DataFrame:
    """(item_a, item_b, cnt) of pairs of ids, the items as texts and in the order of texts."""
    counts = pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("cnt"))
    a, b = F.col("item_a").cast("string"), F.col("item_b").cast("string")
    return counts.select(F.least(a, b).alias("item_a"), F.greatest(a, b).alias("item_b"), "cnt")


def pair_counts(clean: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """(item_a, item_b, cnt) for every pair bought by at least one user."""
    return _counted(item_pairs(_bought(clean), block_size))


def _buyers(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("item").agg(F.count(F.lit(1)).alias("buyers"))


def count_lower_bound_frame(baskets: DataFrame, n: int,
                            seed_items: int | None = None) -> DataFrame:
    """One row ``t``: a lower bound on the n-th largest pair count, namely the n-th largest
    count among the pairs of the ``seed_items`` most-bought items (any subset of the pairs
    gives such a bound), or 1 when that subset has fewer than n pairs.

    Lazy; the baskets should be materialised, since the plan that uses it reads them too.
    """
    m = seed_items or max(64, 2 * int(math.isqrt(2 * n)) + 2)
    seeds = _buyers(baskets).orderBy(F.col("buyers").desc(), F.col("item")).limit(m)
    sub = baskets.join(seeds.select("item"), "item")      # at most m rows; AQE measures them
    counts = item_pairs(sub, items=m).groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("cnt"))
    best = counts.orderBy(F.col("cnt").desc()).limit(n)
    return best.agg(F.when(F.count(F.lit(1)) == n, F.min("cnt")).otherwise(F.lit(1))
                    .cast("bigint").alias("t"))


def count_lower_bound(baskets: DataFrame, n: int, seed_items: int | None = None) -> int:
    return int(count_lower_bound_frame(baskets, n, seed_items).first()["t"])


def top_pairs(clean: DataFrame, n: int = DEFAULT_TOP_N,
              block_size: int = DEFAULT_BLOCK_SIZE, scratch: Scratch | None = None) -> DataFrame:
    """The n most frequent pairs, ties broken by item_a, item_b; with a 1-based rank.

    Exact pruning: a pair's count is at most the buyer count of either item, so with a lower
    bound t on the n-th largest count (``count_lower_bound_frame``) every pair of the result
    has two items with at least t buyers. Items below t are dropped before any pair is formed -
    at scale that removes the long tail of rarely bought items, and with it most of the pair
    work - and no count of a remaining pair changes. The distinct baskets are written while the plan is
    built (a job), so they and their shuffle are made once. With a ``scratch`` of the caller, the result reads them
    until it is released; without one, the n rows are brought to the driver and the baskets are removed.

    orderBy + limit plans as TakeOrderedAndProject: every task keeps its own n best, only
    n rows per task reach the final merge. The rank is numbered over those n rows only.
    """
    if scratch is None:
        with Scratch(clean.sparkSession, "top-pairs") as own:
            top = top_pairs(clean, n, block_size, own)
            return clean.sparkSession.createDataFrame(top.collect(), top.schema)
    baskets = scratch.cut(_bought(clean), "baskets")
    t = count_lower_bound_frame(baskets, n)
    popular = (_buyers(baskets).crossJoin(F.broadcast(t))     # exactly one row
               .where(F.col("buyers") >= F.col("t")).select("item"))
    counts = _counted(item_pairs(baskets.join(popular, "item", "left_semi"), block_size))
    order = [F.col("cnt").desc(), F.col("item_a"), F.col("item_b")]
    top = counts.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def pair_lines(top: DataFrame) -> DataFrame:
    """K4 text: ``a,b<TAB>count`` in rank order (one partition, n rows)."""
    return (top.orderBy("rank").coalesce(1)
            .select(F.concat_ws("", F.col("item_a"), F.lit(","), F.col("item_b"), F.lit("\t"),
                                F.col("cnt").cast("string")).alias("value")))
