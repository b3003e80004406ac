import os
import tempfile

from pyspark.sql import functions as F

from cartograph.operators import cooccur as co
from cartograph.operators import index as ix
from cartograph.operators import kmeans as km
from cartograph.operators.features import user_features
from cartograph.plans.batch import run_jobs
from cartograph.sinks import writers
from cartograph.sources import readers
from cartograph.streaming.ingest import clean_log_stream, ingest_clean_log, user_activity_stream


def _tmp():
    return tempfile.mkdtemp(prefix="cartograph-test-")


def test_clean_log_text_roundtrip(spark, worked_clean):
    p = writers.write_clean_log_text(worked_clean, _tmp() + "/clean")
    lines = sorted(r["value"] for r in spark.read.text(p).collect())
    assert "-6,11,101,buy,173800" in lines and "5,11,101,pv,173800" in lines
    back = readers.read_clean_log_text(spark, p)
    assert sorted(back.collect()) == sorted(worked_clean.collect())


def test_feature_text_format_and_readback(spark, worked_clean):
    f = user_features(worked_clean)
    p = writers.write_features_text(f, _tmp() + "/feat")
    lines = sorted(r["value"] for r in spark.read.text(p).collect())
    assert "2,1.0000,0.5000,0.7500" in lines and "3,0.0000,0.0000,0.1250" in lines
    back = {r["user_id"]: (r["f1"], r["f2"], r["f3"]) for r in readers.read_features_text(spark, p).collect()}
    assert back[1] == (0.5, 1.0, 1.0)


def test_feature_reader_fails_on_short_line(spark):
    d = _tmp()
    with open(os.path.join(d, "part-0"), "w") as fh:
        fh.write("1,0.5,0.5\n")
    import pytest
    with pytest.raises(Exception):
        readers.read_features_text(spark, d).collect()


def test_feature_reader_ignores_blank_and_extra(spark):
    d = _tmp()
    with open(os.path.join(d, "part-0"), "w") as fh:
        fh.write("1, 0.5 ,0.25,1.0,extra\n\n   \n")
    assert [tuple(r) for r in readers.read_features_text(spark, d).collect()] == [(1, 0.5, 0.25, 1.0)]


def test_index_text_roundtrip(spark, worked_clean):
    p = writers.write_index_text(ix.inverted_index(worked_clean), _tmp() + "/idx")
    back = {(r["item_id"], r["user_id"]) for r in readers.read_index_text(spark, p).collect()}
    assert back == {(9, 1), (9, 2), (9, 3), (10, 1), (10, 2)}


def test_index_reader_skips_bad_lines(spark):
    d = _tmp()
    with open(os.path.join(d, "part-0"), "w") as fh:
        fh.write("9\t1,2,\n7\n\n8\t 3 \n")
    back = sorted((r["item_id"], r["user_id"]) for r in readers.read_index_text(spark, d).collect())
    assert back == [(8, 3), (9, 1), (9, 2)]


def test_pairs_centres_labels_text(spark, worked_clean):
    d = _tmp()
    writers.write_pairs_text(co.top_pairs(worked_clean), d + "/pairs")
    assert [r["value"] for r in spark.read.text(d + "/pairs").collect()] == ["10,9\t1"]
    cf = km.centers_frame(spark, [(0.0, 0.0, 1 / 6), (0.75, 0.75, 0.875)])
    writers.write_centers_text(cf, d + "/centres")
    assert [r["value"] for r in spark.read.text(d + "/centres").collect()] == [
        "0\t0.0000,0.0000,0.1667", "1\t0.7500,0.7500,0.8750"]
    lab = km.labels(user_features(worked_clean), [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)])
    writers.write_labels_text(lab, d + "/labels")
    assert "1,1" in {r["value"] for r in spark.read.text(d + "/labels").collect()}


def test_overwrite(spark, worked_clean):
    p = _tmp() + "/clean"
    writers.write_clean_log_text(worked_clean, p)
    writers.write_clean_log_text(worked_clean.limit(2), p)
    assert spark.read.text(p).count() == 2


def test_streaming_ingest_and_activity(spark):
    from tests.conftest import WORKED_LINES
    d = _tmp()
    os.makedirs(d + "/in")
    with open(d + "/in/a.txt", "w") as fh:
        fh.write("\n".join(WORKED_LINES[:8]) + "\n")
    with open(d + "/in/b.txt", "w") as fh:
        fh.write("\n".join(WORKED_LINES[8:]) + "\n")
    q = ingest_clean_log(clean_log_stream(spark, d + "/in"), d + "/out", d + "/ckpt")
    q.awaitTermination()
    assert spark.read.parquet(d + "/out").count() == 8
    act = user_activity_stream(clean_log_stream(spark, d + "/in"))
    mq = (act.writeStream.outputMode("update").format("memory").queryName("activity_test")
          .trigger(availableNow=True).start())
    mq.awaitTermination()
    rows = spark.sql("SELECT * FROM activity_test").groupBy("user_id").agg(
        F.max("cnt").alias("cnt"), F.max("score_sum").alias("s")).collect()
    assert {r["user_id"]: (r["cnt"], r["s"]) for r in rows} == {
        1: (3, 9), 2: (2, 7), 3: (1, 2), 5: (1, 1), -6: (1, 4)}


def test_batch_run_text_handover(spark, worked_lines):
    res = run_jobs(spark, worked_lines, _tmp() + "/out", target=3, k=2, is_raw_text=True)
    assert res.recommendation == "3\t10:0.124"
    assert res.kmeans.iterations >= 1
    assert spark.read.text(res.paths["pairs"]).first()["value"] == "10,9\t1"
    res2 = run_jobs(spark, worked_lines, _tmp() + "/out2", target=3, k=2, is_raw_text=True,
                    handover="parquet")
    assert res2.recommendation == "3\t10:0.124"
