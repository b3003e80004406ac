"""Readers for the raw log and for the exported text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.functions.text import java_trim, parse_long
from cartograph.schemas import CLEAN_LOG


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """One string per line (file, folder or glob). Splittable, so it scales with the files."""
    return spark.read.text(path)


def read_clean_log(spark: SparkSession, path: str) -> DataFrame:
    """S2 (parquet between our own stages): typed clean log."""
    return spark.read.schema(CLEAN_LOG).parquet(path)


def read_clean_log_fields(spark: SparkSession, path: str) -> DataFrame:
    """Re-validated lines of an exported clean log with its ids as text.

    A line counts when it has five or more comma-separated fields and its trimmed user id is
    all digits; further fields, blanks around fields, headers and short lines are harmless.
    Item and category ids need not be numeric; an empty item id is dropped.
    """
    fields = spark.read.text(path).select(F.explode(F.array(F.split("value", ",", -1))).alias("_p")) \
        .where(F.size("_p") >= 5)
    names = ("user_id", "item_id", "category_id", "behavior_type", "ts")
    out = fields.select(*[java_trim(F.get("_p", F.lit(i))).alias(c) for i, c in enumerate(names)])
    return out.where(F.col("user_id").rlike(r"^[0-9]+\z") & (F.col("item_id") != ""))


def read_clean_log_text(spark: SparkSession, path: str) -> DataFrame:
    """S2 (exported text) with numeric ids: ``uid,iid,cid,bt,ts`` lines as written by K1.

    Every line must have a valid user id of any sign; fields that are not integers are NULL.
    """
    fields = spark.read.text(path).select(F.explode(F.array(F.split("value", ",", -1))).alias("_p")) \
        .where(F.size("_p") >= 5)

    def field(i: int):
        return java_trim(F.get("_p", F.lit(i)))
    return fields.select(parse_long(field(0)).alias("user_id"), parse_long(field(1)).alias("item_id"),
                         parse_long(field(2)).alias("category_id"), field(3).alias("behavior_type"),
                         parse_long(field(4)).alias("ts")).where(F.col("user_id").isNotNull())


def read_features_text(spark: SparkSession, path: str) -> DataFrame:
    """S3 with numeric ids: ``uid,F1,F2,F3`` lines; blank lines skipped, extra fields ignored.

    A short or non-numeric row fails the job, as a feature file must be complete.
    """
    return _features(spark, path, parse_long)


def _features(spark: SparkSession, path: str, user_id) -> DataFrame:
    lines = spark.read.text(path).where(F.length(java_trim(F.col("value"))) > 0)
    parts = F.split(F.col("value"), ",", -1)
    out = lines.select(
        user_id(java_trim(F.try_element_at(parts, F.lit(1)))).alias("user_id"),
        *[java_trim(F.try_element_at(parts, F.lit(i + 2))).alias(f"_f{i + 1}") for i in range(3)],
        F.col("value"),
    )
    cols = []
    for i in range(3):
        raw = F.col(f"_f{i + 1}")
        val = raw.try_cast("double")
        cols.append(F.when(val.isNull(), F.raise_error(F.concat(
            F.lit("malformed feature line: "), F.col("value")))).otherwise(val).alias(f"f{i + 1}"))
    uid = F.when(F.col("user_id").isNull(), F.raise_error(F.concat(
        F.lit("malformed user id in feature line: "), F.col("value")))).otherwise(F.col("user_id"))
    return out.select(uid.alias("user_id"), *cols)


def read_feature_fields(spark: SparkSession, path: str) -> DataFrame:
    """S3 with user ids of any kind, kept as trimmed text; numbers are checked as in ``read_features_text``."""
    return _features(spark, path, lambda raw: raw)


def read_index_fields(spark: SparkSession, path: str, distinct: bool = False) -> DataFrame:
    """S4 with ids of any kind: ``item<TAB>u1,u2,...`` lines -> (item_id, user_id) as trimmed texts.

    Every token is used: an empty one between commas is the id ``''``. Empty fields at the end of a line or of
    its users are no tokens, and a line without users has no edges. Repeated users weigh as often as they come
    unless ``distinct`` is set.
    """
    lines = spark.read.text(path).where(F.length(java_trim(F.col("value"))) > 0)
    parts = F.split(F.regexp_replace("value", "\t+\\z", ""), "\t", -1)
    cut = lines.select(parts.alias("_p")).where(F.size("_p") >= 2) \
        .select(java_trim(F.col("_p")[0]).alias("item_id"), F.col("_p")[1].alias("_users"))
    some = cut.where(~F.col("_users").rlike("^,+\\z"))
    user = F.explode(F.split(F.regexp_replace("_users", ",+\\z", ""), ",", -1))
    edges = some.select("item_id", user.alias("user_id")).select("item_id", java_trim(F.col("user_id")).alias("user_id"))
    return edges.distinct() if distinct else edges


def read_index_text(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """``item<TAB>u1,u2,...`` lines -> (item_id, user_id) edges.

    Several lines for one item (its parts) add their users. Empty user tokens are skipped; any other
    token that is not a number fails the job (``read_index_fields`` takes ids of any kind).
    ``distinct=False`` keeps repeated users of a line, which weigh as often in the walk.
    """
    lines = spark.read.text(path).where(F.length(java_trim(F.col("value"))) > 0)
    parts = F.split(F.col("value"), "\t", -1)
    edges = (lines.where(F.size(parts) >= 2)
             .select(_index_id(F.try_element_at(parts, F.lit(1))).alias("item_id"),
                     F.explode(F.split(F.try_element_at(parts, F.lit(2)), ",", -1)).alias("u"))
             .where(java_trim(F.col("u")) != "").select("item_id", _index_id(F.col("u")).alias("user_id")))
    return edges.distinct() if distinct else edges


def _index_id(raw):
    number = parse_long(java_trim(raw))
    return F.when(number.isNull(), F.raise_error(F.concat(
        F.lit("not a numeric id in an index line: "), raw))).otherwise(number)
