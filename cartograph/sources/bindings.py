"""Bindings of the driver's parquet tables to the behaviour-log schema.

Binding A (``events``): user, item from the JSON field ``k`` of ``props``, category
``item % 10``, event type mapped to a behaviour code (``error`` stays invalid), whole epoch
seconds of ``ts``.

Binding B (``orders`` joined to ``lineitem``): customer, part, supplier, behaviour from
``l_linenumber % 4``, epoch seconds of the order date.

Binding C (raw text): binding A rendered as text lines, with a dirty variant chosen by
``event_id % 10`` so that the text parser sees every rejection rule.

All three are lazy DataFrames; Catalyst prunes the parquet columns and pushes filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values of the bindings (shared with the SQL oracle) ----
EVENT_BEHAVIOR = {"view": "pv", "click": "fav", "signup": "cart", "purchase": "buy"}
LINENUMBER_BEHAVIOR = {0: "pv", 1: "cart", 2: "fav", 3: "buy"}
TEXT_HEADER = "user_id,item_id,category_id,behavior_type,timestamp"
TEXT_BLANK = "\t "
TEXT_EXTRA_FIELD = "extra"
# ---- end of fixed values ----

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(col_name: str) -> Column:
    """Whole seconds since 1970 (floor) of a timestamp_ntz column.

    Built from calendar fields so that no session time zone enters: a cast to an
    instant would shift by the zone's daylight-saving offset.
    """
    ts = F.col(col_name)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return (days * 86400 + F.hour(ts).cast("bigint") * 3600
            + F.minute(ts).cast("bigint") * 60 + F.second(ts).cast("bigint"))


def _event_behavior(col: Column) -> Column:
    expr = None
    for src, dst in EVENT_BEHAVIOR.items():
        expr = F.when(col == src, dst) if expr is None else expr.when(col == src, dst)
    return expr.otherwise(col)


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding A as a typed but not yet validated log (``error`` rows still present)."""
    return events_typed(read_table(spark, sf_dir, "events"))


def events_typed(ev: DataFrame) -> DataFrame:
    """Binding A on any events DataFrame, batch or streaming."""
    item = F.get_json_object("props", "$.k").try_cast("bigint")
    return ev.select(
        F.col("user_id"),
        item.alias("item_id"),
        (item % 10).alias("category_id"),
        _event_behavior(F.col("event_type")).alias("behavior_type"),
        epoch_seconds("ts").alias("ts"),
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding B: one action per line item, owned by the order's customer.

    orders x lineitem is a key/foreign-key equi-join of two large tables; Spark plans a
    shuffle (sort-merge) join on the order key, AQE splits skewed keys at run time.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    code = F.col("l_linenumber") % 4
    bt = None
    for k, v in LINENUMBER_BEHAVIOR.items():
        bt = F.when(code == k, v) if bt is None else bt.when(code == k, v)
    return o.join(li, o.o_orderkey == li.l_orderkey, "inner").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("category_id"),
        bt.alias("behavior_type"),
        epoch_seconds("o_orderdate").alias("ts"),
    )


def events_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding C: one raw text line (column ``value``) per event, dirty by ``event_id % 10``.

    0 whitespace separated (with U+007F after the user of every other such event), 1 spaces around
    the commas, 2 upper-case behaviour, 3 a sixth
    field, 4 four fields, 5 ``1.5`` as user, 6 leading ``+`` on the user, 7 blank line,
    8 header line, 9 plain comma separated.
    """
    ev = read_table(spark, sf_dir, "events")
    item = F.get_json_object("props", "$.k").try_cast("bigint")
    u = F.col("user_id").cast("string")
    i = item.cast("string")
    c = (item % 10).cast("string")
    b = _event_behavior(F.col("event_type"))
    t = epoch_seconds("ts").cast("string")
    v = F.col("event_id") % 10
    line = (
        F.when(F.col("event_id") % 20 == 0, F.concat_ws(" ", F.concat(u, F.lit("\x7f")), i, c, b, t))
        .when(v == 0, F.concat_ws(" ", u, i, c, b, t))
        .when(v == 1, F.concat_ws(" , ", u, i, c, b, t))
        .when(v == 2, F.concat_ws(",", u, i, c, F.upper(b), t))
        .when(v == 3, F.concat_ws(",", u, i, c, b, t, F.lit(TEXT_EXTRA_FIELD)))
        .when(v == 4, F.concat_ws(",", u, i, c, b))
        .when(v == 5, F.concat_ws(",", F.lit("1.5"), i, c, b, t))
        .when(v == 6, F.concat_ws(",", F.concat(F.lit("+"), u), i, c, b, t))
        .when(v == 7, F.lit(TEXT_BLANK))
        .when(v == 8, F.lit(TEXT_HEADER))
        .otherwise(F.concat_ws(",", u, i, c, b, t))
    )
    # The one-element explode is a barrier: without it the optimizer substitutes this large
    # CASE into every predicate the parser pushes down (a file source has a plain column).
    return ev.select(F.explode(F.array(line)).alias("value"))
