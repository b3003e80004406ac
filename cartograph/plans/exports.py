"""Registered queries that go through files: text round trips (K1-K6 -> S1-S4), streaming
ingestion and the four-job batch run. Files go to the shared checkpoint folder; what was read
back is cut by a reliable checkpoint and the files are deleted. Spark removes the checkpoint of a result
that is no longer used where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as
``build_session`` does."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.operators import cooccur as co
from cartograph.operators import features as feat
from cartograph.operators import index as ix
from cartograph.plans.batch import run_jobs
from cartograph.plans.logs import events_clean, orders_clean
from cartograph.session import ensure_checkpoint_dir
from cartograph.sinks import writers
from cartograph.sources import readers
from cartograph.operators.clean import clean_text, clean_typed
from cartograph.operators import personal_rank as prk
from cartograph.scratch import delete_path
from cartograph.sources.bindings import events_text_lines, events_typed
from cartograph.streaming.ingest import ingest_clean_log


def export_dir(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, then: Callable[[], None]) -> DataFrame:
    """df cut from the files it was read from, which ``then`` removes."""
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    then()
    return kept


def _back(df: DataFrame, path: str) -> DataFrame:
    return materialised(df, lambda: delete_path(df.sparkSession, path))


def lines_back(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written text output."""
    return _back(spark.read.text(path), path)


def roundtrip_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_clean_log_text(orders_clean(spark, sf_dir), export_dir(spark, "clean"))
    return _back(readers.read_clean_log_text(spark, path), path)


def roundtrip_features_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_features_text(feat.user_features(orders_clean(spark, sf_dir)),
                                       export_dir(spark, "features"))
    return _back(readers.read_features_text(spark, path), path)


def roundtrip_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_index_text(ix.inverted_index(orders_clean(spark, sf_dir)),
                                    export_dir(spark, "index"))
    return _back(readers.read_index_text(spark, path), path)


def roundtrip_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty raw lines written, read by the raw log reader and cleaned."""
    path = writers.write_lines(events_text_lines(spark, sf_dir), export_dir(spark, "raw"))
    return _back(clean_text(readers.read_raw_log(spark, path)), path)


def roundtrip_pairs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_pairs_text(co.top_pairs(orders_clean(spark, sf_dir)), export_dir(spark, "pairs"))
    return lines_back(spark, path)


def overwrite_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a second write to the same path leaves only its own lines."""
    path = export_dir(spark, "twice")
    writers.write_clean_log_text(orders_clean(spark, sf_dir), path)
    writers.write_clean_log_text(events_clean(spark, sf_dir), path)
    return _back(readers.read_clean_log_text(spark, path), path)


def dirty_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-log lines of binding A that another program could have left, by ``user_id % 7``:
    0 a sixth field, 1 blanks around the fields, 2 a short line, 3 a negative user, 4 a text item,
    5 a header, 6 plain."""
    log = events_clean(spark, sf_dir)
    u, i, c, t = (F.col(x).cast("string") for x in ("user_id", "item_id", "category_id", "ts"))
    b, v = F.col("behavior_type"), F.col("user_id") % 7
    return log.select(F.explode(F.array(
        F.when(v == 0, F.concat_ws(",", u, i, c, b, t, F.lit("more")))
        .when(v == 1, F.concat_ws(" , ", u, i, c, b, t))
        .when(v == 2, F.concat_ws(",", u, i, c, b))
        .when(v == 3, F.concat_ws(",", F.concat(F.lit("-"), u), i, c, b, t))
        .when(v == 4, F.concat_ws(",", u, F.concat(F.lit("item"), i), c, b, t))
        .when(v == 5, F.lit("user_id,item_id,category_id,behavior_type,timestamp"))
        .otherwise(F.concat_ws(",", u, i, c, b, t)))).alias("value"))


def clean_log_revalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty lines written, read and validated again."""
    path = writers.write_lines(dirty_clean_lines(spark, sf_dir), export_dir(spark, "dirty"))
    return _back(readers.read_clean_log_fields(spark, path), path)


def index_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 over items that are not all numbers."""
    path = writers.write_lines(dirty_clean_lines(spark, sf_dir), export_dir(spark, "text-ids"))
    log = readers.read_clean_log_fields(spark, path).withColumn("user_id", F.col("user_id").cast("bigint"))
    return _back(ix.index_lines(ix.inverted_index(log)), path)


def with_text_ids(log: DataFrame) -> DataFrame:
    """A log whose ids are texts, and partly no numbers: every third item, and every user of an even number."""
    item, user = F.col("item_id"), F.col("user_id")
    return log.withColumn("item_id", F.when(item % 3 == 0, F.concat(F.lit("item "), item.cast("string"))).otherwise(item.cast("string"))) \
        .withColumn("user_id", F.when(user % 2 == 0, F.concat(F.lit("u-"), user.cast("string"))).otherwise(user.cast("string")))


def recommend_text_ids(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    """S4, I5, I4, I6 from written index lines and a written clean log of binding A, both with text ids."""
    log = with_text_ids(events_clean(spark, sf_dir))
    part = F.pmod(F.xxhash64("user_id"), F.lit(8))
    deep = log.where(F.col("behavior_type") != "pv").select("item_id", "user_id").distinct()
    lines = deep.groupBy("item_id", part.alias("part")).agg(F.sort_array(F.collect_list("user_id")).alias("users"))
    index = writers.write_index_text(lines, export_dir(spark, "text-index"))
    clean = writers.write_clean_log_text(log, export_dir(spark, "text-clean"))
    top = prk.recommend_text(readers.read_index_fields(spark, index),
                             prk.seen_items_text(spark.read.text(clean), target), target)
    for path in (index, clean):
        delete_path(spark, path)
    return top


def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 with text ids: the features of binding A written and read back."""
    feats = feat.user_features(events_clean(spark, sf_dir)).withColumn("item_id", F.lit(0))
    path = writers.write_features_text(with_text_ids(feats).drop("item_id"), export_dir(spark, "text-features"))
    return _back(readers.read_feature_fields(spark, path), path)


def stream_clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream source -> binding A -> cleaning -> parquet (availableNow)."""
    base = export_dir(spark, "stream")
    source = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(source).schema
    # a file source takes folders and patterns; this pattern matches the one name only
    stream = spark.readStream.schema(schema).parquet(source[:-1] + "[t]")
    q = ingest_clean_log(clean_typed(events_typed(stream)), f"{base}/data",
                         f"{base}/_checkpoint")
    q.awaitTermination()
    return _back(spark.read.parquet(f"{base}/data"), base)


def batch_text_recommendation(spark: SparkSession, sf_dir: str, target: int) -> DataFrame:
    """All four jobs on the raw text binding, handing over through the text formats."""
    base = export_dir(spark, "batch")
    res = run_jobs(spark, events_text_lines(spark, sf_dir), base, target, is_raw_text=True)
    return _back(spark.read.text(res.paths["recommendation"]), base)
