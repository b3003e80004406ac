import pytest

from cartograph.operators import kmeans as km
from cartograph.operators.features import user_features


@pytest.fixture(scope="module")
def feats(worked_clean):
    return user_features(worked_clean)


def test_worked_step(feats):
    start = [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)]
    lab = {r["user_id"]: r["cluster_id"] for r in km.labels(feats, start).collect()}
    assert lab == {1: 1, 2: 1, 3: 0, 5: 0, -6: 0}
    new, shift, sizes = km.lloyd_step(feats, start)
    assert new[0] == pytest.approx((0.0, 0.0, 0.5 / 3))
    assert new[1] == pytest.approx((0.75, 0.75, 0.875))
    assert shift == pytest.approx(0.5 / 3 + 0.375)
    assert sizes == [3, 2]
    again, shift2, _ = km.lloyd_step(feats, new)
    assert shift2 == 0.0 and again == new


def test_fit_stops_and_keeps_old_centres(spark, feats, monkeypatch):
    monkeypatch.setattr(km, "init_centers", lambda *a, **k: [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)])
    model = km.fit(feats, 2)
    assert model.converged and model.iterations == 2
    assert model.centers[1] == pytest.approx((0.75, 0.75, 0.875))


def test_fewer_users_than_k(feats):
    with pytest.raises(ValueError):
        km.init_centers(feats, 6)
    with pytest.raises(ValueError):
        km.init_centers(feats, 0)


def test_init_is_repeatable_and_distinct_rows(feats):
    a = km.init_centers(feats, 3)
    b = km.init_centers(feats.repartition(3), 3)
    assert a == b and len(a) == 3


def test_equal_centres_lowest_index_wins(feats):
    c = [(0.5, 0.5, 0.5), (0.5, 0.5, 0.5), (2.0, 2.0, 2.0)]
    assert {r["cluster_id"] for r in km.labels(feats, c).collect()} == {0}
    new, _, sizes = km.lloyd_step(feats, c)
    assert sizes == [5, 0, 0] and new[1] == c[1] and new[2] == c[2]


def test_cost_never_grows(feats):
    centres = km.init_centers(feats, 2)

    def cost(cs):
        pts = [(r["f1"], r["f2"], r["f3"]) for r in feats.collect()]
        return sum(min(sum((p - q) ** 2 for p, q in zip(pt, c)) for c in cs) for pt in pts)

    prev = cost(centres)
    for _ in range(4):
        centres, _, _ = km.lloyd_step(feats, centres)
        now = cost(centres)
        assert now <= prev + 1e-12
        prev = now


def test_center_lines(spark):
    df = km.centers_frame(spark, [(0.03125, 1.0, 0.5), (0.12345, 0.0, 1.0 / 3)])
    assert [r["value"] for r in km.center_lines(df).collect()] == [
        "0\t0.0313,1.0000,0.5000", "1\t0.1235,0.0000,0.3333"]
