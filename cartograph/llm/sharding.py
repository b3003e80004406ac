"""Sharding by a k-d tree over document metadata (DataFrame functions only).

Every node of the tree is split along its widest metadata dimension at the weighted median, the
place that divides the node's bytes in proportion to the leaves on either side, until a leaf
holds the target bytes. The medians of all nodes of a level are found together: keys of 62 bits
(20 bits of the dimension, 30 bits of a document hash, 12 bits of a row number, so that a value
or a document with a third of all rows can still be divided) are narrowed by 12 bits a pass with
a histogram of nodes x 4096 sums. The text is read once, for its size and checksum; all passes
run over narrow rows, and only one row per node reaches the driver.

Law `bytes`: shards differ by about the largest document per level.

Defined cases: a null text has no bytes (size 1); null metadata takes the lowest coordinate;
repeated rows are rows of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

COORD_BITS, HASH_BITS, ROW_BITS = 20, 30, 12
KEY_BITS, DIGIT_BITS = COORD_BITS + HASH_BITS + ROW_BITS, 12
#: Rows that get their slots in one window group, about.
SLOT_GROUP_ROWS = 20_000


def _spread(c: Column, low, high) -> Column:
    """A number as a coordinate of COORD_BITS between its least and greatest value."""
    top = (1 << COORD_BITS) - 1
    if low is None or not high > low:
        return F.lit(0).cast("long")
    part = (c.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.coalesce(F.round(part * top), F.lit(0)).cast("long")


def _label(c: Column) -> Column:
    """A label as a coordinate: the top bits of its hash."""
    return F.when(c.isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(c), 64 - COORD_BITS)).cast("long")


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from driver values, made in the JVM."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return F.broadcast(spark.range(1).select(F.inline(text)))  # at most one row per node of the tree


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, a row number and the coordinates of every document."""
    text = F.col("text").cast("string")
    base = common.cut(docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *[(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c)
          for c in ("source", "lang")],
        F.monotonically_increasing_id().alias("row")))
    span = base.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
                    F.min(F.log2("size")).alias("c"), F.max(F.log2("size")).alias("d")).first()
    tie = F.shiftleft(F.xxhash64("doc_id", "text_crc32").bitwiseAND((1 << HASH_BITS) - 1), ROW_BITS) \
        .bitwiseOR(F.xxhash64("row").bitwiseAND((1 << ROW_BITS) - 1))
    return base.select(
        "doc_id", "size", "text_crc32", "row", tie.alias("tie"),
        F.array(_spread(F.col("doc_id"), span["a"], span["b"]), _spread(F.log2("size"), span["c"], span["d"]),
                _label(F.col("source")), _label(F.col("lang"))).alias("at"))


def split_level(df: DataFrame, leaves: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """Split all nodes of df with more than one leaf; node -> leaves of the next level.

    df has node, size, at and tie; a node's children are 2 * node and 2 * node + 1.
    """
    spark, dims = df.sparkSession, 4
    stats = df.groupBy("node").agg(
        F.sum("size").alias("bytes"),
        *[(F.max(F.get("at", F.lit(i))) - F.min(F.get("at", F.lit(i)))).alias(f"w{i}") for i in range(dims)]).collect()
    state = {r["node"]: {"node": r["node"], "dim": max(range(dims), key=lambda i: (r[f"w{i}"], -i)), "lo": 0,
                         "before": 0, "target": r["bytes"] * (leaves[r["node"]] // 2) / leaves[r["node"]]}
             for r in stats if leaves[r["node"]] > 1}
    schema = "node:long,dim:int,lo:long,before:long,target:double"
    key = F.shiftleft(F.get("at", F.col("dim")), HASH_BITS + ROW_BITS).bitwiseOR(F.col("tie"))
    done: dict[int, dict] = {}
    shift = KEY_BITS
    while state:
        shift = max(0, shift - DIGIT_BITS)
        keyed = df.join(_rows(spark, list(state.values()), schema), "node").withColumn("k", key - F.col("lo"))
        here = keyed.where((F.col("k") >= 0) & (F.shiftright("k", shift) < (1 << DIGIT_BITS)))
        sums = here.groupBy("node", "before", "target", F.shiftright("k", shift).alias("digit")) \
            .agg(F.sum("size").alias("w"), F.count("*").alias("n"))
        by = Window.partitionBy("node").orderBy("digit")
        sums = sums.withColumn("upto", F.col("before") + F.sum("w").over(by))
        cross = sums.where(F.col("upto") >= F.col("target")) \
            .groupBy("node").agg(F.min_by(F.struct("digit", "w", "n", "upto"), "digit").alias("x")).collect()
        for r in cross:
            s, x = state[r["node"]], r["x"]
            s["lo"] += x["digit"] << shift
            s["before"] = x["upto"] - x["w"]
            if x["n"] == 1 or shift == 0:
                left = s["target"] - s["before"] >= x["w"] / 2
                done[r["node"]] = {"node": r["node"], "dim": s["dim"], "cut": s["lo"] + (left << shift)}
                del state[r["node"]]
    table = _rows(spark, list(done.values()), "node:long,dim:int,cut:long")
    right = F.coalesce((key >= F.col("cut")).cast("long"), F.lit(0))
    split = df.join(table, "node", "left").withColumn("node", F.col("node") * 2 + right).drop("dim", "cut")
    below = {}
    for node, n in leaves.items():
        below |= {2 * node: n // 2, 2 * node + 1: n - n // 2} if n > 1 else {2 * node: 1}
    return split, below


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of docs, in `shards` shards or in as
    many as target_bytes asks for."""
    spark = docs.sparkSession
    base = narrow(docs)
    total = base.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    shards = shards or max(1, -(-(total["b"] or 0) // (target_bytes or 1 << 29)))
    tree, leaves = base.withColumn("node", F.lit(0).cast("long")), {0: shards}
    while total["n"] and max(leaves.values()) > 1:
        tree, leaves = split_level(tree, leaves)
    shard = _rows(spark, [{"node": x, "shard": i} for i, x in enumerate(sorted(leaves))], "node:long,shard:int")
    groups = max(1, -(-total["n"] // (SLOT_GROUP_ROWS * shards)))
    placed = tree.join(shard, "node").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "row"))
    return placed.withColumn("within", within).join(first, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("within") - 1).alias("slot"))


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    common.prepare(spark)
    return kd_shards(common.read(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
