import itertools
import random

from cartograph.operators import cooccur as co
from cartograph.operators import index as ix
from cartograph.operators.clean import clean_typed


def test_inverted_index_worked(worked_clean):
    got = {r["item_id"]: r["users"] for r in ix.inverted_index(worked_clean).collect()}
    assert got == {9: [1, 2, 3], 10: [1, 2]}


def test_index_lines(worked_clean):
    lines = sorted(r["value"] for r in ix.index_lines(ix.inverted_index(worked_clean)).collect())
    assert lines == ["10\t1,2", "9\t1,2,3"]


def test_hot_item_is_split_and_lossless(spark):
    rows = [(u, 1, 1, "buy", 1) for u in range(1000)] + [(5, 2, 1, "cart", 1)]
    log = clean_typed(spark.createDataFrame(rows, "user_id long, item_id long, category_id long, "
                                                  "behavior_type string, ts long"))
    idx = ix.inverted_index(log, width=100).collect()
    hot = [r for r in idx if r["item_id"] == 1]
    assert len(hot) == 10
    assert all(len(r["users"]) == 100 for r in hot)
    assert sorted(u for r in hot for u in r["users"]) == list(range(1000))
    assert all(r["users"] == sorted(r["users"]) for r in hot)


def test_index_is_transpose_of_edges(worked_clean):
    edges = {(r["item_id"], r["user_id"]) for r in ix.deep_edges(worked_clean).collect()}
    idx = {(r["item_id"], u) for r in ix.inverted_index(worked_clean).collect() for u in r["users"]}
    assert edges == idx


def test_pairs_worked(worked_clean):
    got = [(r["item_a"], r["item_b"], r["cnt"]) for r in co.pair_counts(worked_clean).collect()]
    assert got == [("10", "9", 1)]


def test_single_item_basket_has_no_pair(spark):
    log = clean_typed(spark.createDataFrame([(1, 5, 1, "buy", 1), (1, 5, 1, "buy", 2)],
                                            "user_id long, item_id long, category_id long, "
                                            "behavior_type string, ts long"))
    assert co.pair_counts(log).count() == 0


def _brute(baskets):
    out = {}
    for items in baskets.values():
        for a, b in itertools.combinations(sorted({str(i) for i in items}), 2):
            out[(a, b)] = out.get((a, b), 0) + 1
    return out


def test_hot_basket_blocks_match_brute_force(spark):
    rnd = random.Random(3)
    baskets = {u: [rnd.randrange(60) for _ in range(rnd.choice([1, 3, 8]))] for u in range(40)}
    baskets[99] = list(range(200))           # one hot basket
    rows = [(u, i, 0, "buy", 1) for u, items in baskets.items() for i in items]
    rows += [(u, i, 0, "pv", 1) for u, i in [(1, 500), (2, 501)]]
    log = clean_typed(spark.createDataFrame(rows, "user_id long, item_id long, category_id long, "
                                                  "behavior_type string, ts long"))
    want = _brute(baskets)
    for block in (7, 2_000):
        got = {(r["item_a"], r["item_b"]): r["cnt"]
               for r in co.pair_counts(log, block_size=block).collect()}
        assert got == want


def test_pair_count_bounded_by_item_buyers(worked_clean):
    buyers = {}
    for r in co.buy_baskets(worked_clean).collect():
        buyers[r["item"]] = buyers.get(r["item"], 0) + 1
    for r in co.pair_counts(worked_clean).collect():
        assert r["cnt"] <= min(buyers[r["item_a"]], buyers[r["item_b"]])


def test_top_pairs_total_order(spark):
    rows = [(u, i, 0, "buy", 1) for u in range(3) for i in (1, 2, 3)]
    log = clean_typed(spark.createDataFrame(rows, "user_id long, item_id long, category_id long, "
                                                  "behavior_type string, ts long"))
    top = [(r["rank"], r["item_a"], r["item_b"], r["cnt"])
           for r in co.top_pairs(log, n=2).orderBy("rank").collect()]
    assert top == [(1, "1", "2", 3), (2, "1", "3", 3)]
    lines = [r["value"] for r in co.pair_lines(co.top_pairs(log, n=2)).collect()]
    assert lines == ["1,2\t3", "1,3\t3"]


def test_pruned_top_pairs_equal_unpruned(spark):
    rnd = random.Random(11)
    rows = []
    for u in range(300):
        k = rnd.choice([1, 2, 4, 12])
        for _ in range(k):
            rows.append((u, int(rnd.paretovariate(1.2)) % 400, 0, "buy", 1))
    log = clean_typed(spark.createDataFrame(rows, "user_id long, item_id long, category_id long, "
                                                  "behavior_type string, ts long"))
    every = sorted(((-r["cnt"], r["item_a"], r["item_b"]) for r in co.pair_counts(log).collect()))
    for n in (5, 40, 100000):
        got = [(-r["cnt"], r["item_a"], r["item_b"]) for r in co.top_pairs(log, n=n).orderBy("rank").collect()]
        assert got == every[:n]
    assert co.count_lower_bound(co.buy_baskets(log), 5) >= 2


def test_lists_of_a_basket_are_bounded_and_meet_once(spark):
    rows = [(1, i) for i in range(1000)] + [(2, 5), (2, 6), (3, 7)]
    frame = spark.createDataFrame(rows, "user_id long, item long")
    lists = co.basket_lists(frame, block_size=50).collect()
    assert max(max(len(r["xs"]), len(r["ys"])) for r in lists) < 100
    hot = [r for r in lists if r["user_id"] == 1]
    assert sorted((r["lo"], r["hi"]) for r in hot) == [(a, b) for a in range(20) for b in range(a, 20)]
    assert all(not r["ys"] for r in lists if r["lo"] == r["hi"])
    assert sorted(i for r in hot if r["lo"] == r["hi"] for i in r["xs"]) == list(range(1000))
    pairs = [tuple(r) for r in co.item_pairs(frame, block_size=50).collect()]
    assert len(pairs) == 1000 * 999 // 2 + 1 and len(set(pairs)) == len(pairs) - 1    # (5, 6) is in two baskets
    assert all(a < b for a, b in pairs)


def test_pairs_are_counted_by_ids_in_the_stage_that_makes_them(spark, worked_clean):
    plan = co.pair_counts(worked_clean)._jdf.queryExecution().sparkPlan().toString()
    assert "keys=[item_a#" in plan and "Join" not in plan.split("Generate")[0]
    ids = spark.createDataFrame([(u, i, "buy", 1) for u in (1, 2) for i in (9, 10, 100)],
                                "user_id long, item_id long, behavior_type string, ts long")
    got = sorted(tuple(r) for r in co.pair_counts(ids).collect())
    assert got == [("10", "100", 2), ("10", "9", 2), ("100", "9", 2)]  # the order of texts


def test_no_purchase_gives_no_pair(worked_clean):
    assert co.pair_counts(worked_clean.where("false")).count() == 0
    assert co.top_pairs(worked_clean.where("false")).count() == 0
