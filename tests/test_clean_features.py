from cartograph.operators.clean import clean_text
from cartograph.operators.features import (cutoff_ts, feature_bounds, raw_features,
                                           user_features)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_clean_worked_example(worked_clean):
    got = rows(worked_clean, "user_id", "item_id", "category_id", "behavior_type", "ts")
    assert got == sorted([
        (1, 10, 100, "pv", 1000), (1, 9, 100, "buy", 87400), (1, 10, 100, "buy", 87400),
        (2, 9, 100, "buy", 1000), (2, 10, 100, "cart", 1000), (3, 9, 100, "fav", 173800),
        (5, 11, 101, "pv", 173800), (-6, 11, 101, "buy", 173800),
    ])


def test_java_trim_and_blank(spark):
    df = spark.createDataFrame([("\t 7,1,2,pv,3\x0b ",), ("\t\x01 ",), ("",)], "value string")
    assert rows(clean_text(df), "user_id", "ts") == [(7, 3)]


def test_leading_zero_and_sign_canonical(spark):
    df = spark.createDataFrame([("007,+8,-9,cart,0010",)], "value string")
    assert rows(clean_text(df), "user_id", "item_id", "category_id", "ts") == [(7, 8, -9, 10)]


def test_rejects(spark):
    bad = ["1,2,3,pv,1e3", "1,2,3,Pv,1", "1,2,3,pv,", " ,2,3,pv,1", "1;2;3;pv;1",
           "user_id 1 2 pv 3", "timestamp,1,2,pv,3", "1,2,3,pv,99999999999999999999"]
    df = spark.createDataFrame([(x,) for x in bad], "value string")
    assert clean_text(df).count() == 0


def test_cutoff(worked_clean):
    assert cutoff_ts(worked_clean).collect()[0]["max_ts"] == 173800


def test_raw_features(worked_clean):
    got = rows(raw_features(worked_clean), "user_id", "f1", "f2", "f3")
    assert got == sorted([(1, 1.0, 3.0, 9.0), (2, 2.0, 2.0, 7.0), (3, 0.0, 1.0, 2.0),
                          (5, 0.0, 1.0, 1.0), (-6, 0.0, 1.0, 4.0)])


def test_bounds(worked_clean):
    b = feature_bounds(worked_clean).collect()[0].asDict()
    assert b == dict(f1_min=0.0, f1_max=2.0, f2_min=1.0, f2_max=3.0, f3_min=1.0, f3_max=9.0)


def test_scaled_features(worked_clean):
    got = {r["user_id"]: (r["f1"], r["f2"], r["f3"]) for r in user_features(worked_clean).collect()}
    assert got == {1: (0.5, 1.0, 1.0), 2: (1.0, 0.5, 0.75), 3: (0.0, 0.0, 0.125),
                   5: (0.0, 0.0, 0.0), -6: (0.0, 0.0, 0.375)}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([("1,1,1,pv,5",), ("2,1,1,pv,5",)], "value string")
    got = rows(user_features(clean_text(df)), "f1", "f2", "f3")
    assert got == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]


def test_negative_time_clamps(spark):
    df = spark.createDataFrame([("1,1,1,pv,-50",), ("2,1,1,pv,86400",)], "value string")
    got = {r["user_id"]: r["f1"] for r in raw_features(clean_text(df)).collect()}
    assert got == {1: 1.0, 2: 0.0}


def test_duplicates_count_twice(spark):
    df = spark.createDataFrame([("1,1,1,buy,5",), ("1,1,1,buy,5",)], "value string")
    r = raw_features(clean_text(df)).collect()[0]
    assert (r["f2"], r["f3"]) == (2.0, 8.0)


def test_empty_log_gives_empty_features(spark):
    df = spark.createDataFrame([("junk",)], "value string")
    assert user_features(clean_text(df)).count() == 0


def test_order_independence(worked_clean):
    a = rows(user_features(worked_clean), "user_id", "f1", "f2", "f3")
    b = rows(user_features(worked_clean.repartition(5).sortWithinPartitions("ts")),
             "user_id", "f1", "f2", "f3")
    assert a == b
