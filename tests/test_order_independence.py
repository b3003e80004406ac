
import random

import pytest

from cartograph.operators import cooccur as co
from cartograph.operators import index as ix
from cartograph.operators import personal_rank as prk
from cartograph.operators.clean import clean_typed


@pytest.fixture(scope="module")
def logs(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(60), rnd.randrange(80), 0, rnd.choice(["pv", "cart", "fav", "buy"]),
             rnd.randrange(10 ** 6)) for _ in range(1500)]
    schema = "user_id long, item_id long, category_id long, behavior_type string, ts long"
    a = clean_typed(spark.createDataFrame(rows, schema))
    rnd.shuffle(rows)
    b = clean_typed(spark.createDataFrame(rows, schema).repartition(7))
    return a, b


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_index(logs):
    a, b = logs
    assert _set(ix.inverted_index(a)) == _set(ix.inverted_index(b))


def test_pairs(logs):
    a, b = logs
    assert _set(co.top_pairs(a, n=50)) == _set(co.top_pairs(b, n=50))


def test_rank(logs):
    a, b = logs
    ra = {(r["rank"], r["item_id"]): r["score"] for r in prk.recommend(a, 3).collect()}
    rb = {(r["rank"], r["item_id"]): r["score"] for r in prk.recommend(b, 3).collect()}
    assert ra.keys() == rb.keys()
    for k, v in ra.items():
        assert rb[k] == pytest.approx(v, rel=1e-12)
