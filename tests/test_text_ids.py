"""Text ids of items and users: dictionary, ranking, k-means, command line."""
import random

import pytest
from pyspark.sql import functions as F

from cartograph.operators import kmeans as km
from cartograph.operators import node_ids
from cartograph.operators import personal_rank as prk
from cartograph.scratch import Scratch, left_over
from cartograph.sources import readers


def write(spark, tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def java_split(text, sep):
    parts = text.split(sep)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return [] if parts == [""] and text else parts


def test_index_fields_follow_the_line_rules(spark, tmp_path):
    lines = ["item 1\tu-1, 2 ,x", "7\ta,,b,,", "7\ta", "no users", "none\t", "commas\t,,", "empty\t\tmore", "\tu-1", "  ",
             "é日\t😀", "a\tb\tc", "lead\t,z"]
    want = []
    for line in lines:
        parts = java_split(line, "\t")
        if not line.strip() or len(parts) < 2:
            continue
        want += [(parts[0].strip(), u.strip()) for u in java_split(parts[1], ",")]
    got = [tuple(r) for r in readers.read_index_fields(spark, write(spark, tmp_path, "index", lines)).collect()]
    assert sorted(got) == sorted(want)
    assert ("7", "") in got and ("empty", "") in got and ("", "u-1") in got and ("lead", "") in got
    assert got.count(("7", "a")) == 2


def test_numeric_index_reader_fails_on_other_tokens(spark, tmp_path):
    for bad in ("x\t1,2", "1\t2,y"):
        with pytest.raises(Exception, match="not a numeric id"):
            readers.read_index_text(spark, write(spark, tmp_path, f"bad{len(bad)}{bad[0]}", [bad])).collect()


@pytest.mark.parametrize("parts", [1, 7])
def test_dictionary_is_dense_and_ordered(spark, parts):
    rng = random.Random(parts)
    texts = ["".join(rng.choices("aB é日1", k=rng.randrange(0, 4))) for _ in range(2000)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        with Scratch(spark) as scratch:
            got = {r["text"]: r["id"] for r in node_ids.dictionary(df, scratch).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = sorted({t for t in texts if t is not None}, key=lambda t: t.encode())
    assert got == {t: i for i, t in enumerate(want)}
    with Scratch(spark) as scratch:
        assert node_ids.dictionary(df.where("t = 'none of them'"), scratch).count() == 0


def brute(edges, target, seen, n=10, rounds=30, alpha=0.85):
    nbr = {}
    for i, u in edges:
        nbr.setdefault(("I", i), []).append(("U", u))
        nbr.setdefault(("U", u), []).append(("I", i))
    pr = {x: 1.0 if x == ("U", target) else 0.0 for x in nbr}
    for _ in range(rounds):
        new = {("U", target): 1 - alpha}
        for x, ns in nbr.items():
            for y in ns:
                new[y] = new.get(y, 0.0) + alpha * pr.get(x, 0.0) / len(ns)
        pr = new
    items = [(i, pr.get(("I", i), 0.0)) for i in {i for i, _ in edges} - seen]
    return sorted(items, key=lambda x: (-float(f"{x[1]:.11e}"), x[0].encode()))[:n]


def graph_lines(seed=4):
    rng = random.Random(seed)
    users = [f"u{i}" for i in range(15)] + [str(i) for i in range(10)] + ["ü 7", ""]
    items = [f"it {i}" for i in range(12)] + [str(i) for i in range(8)]
    edges = [(i, u) for i in items for u in rng.sample(users, rng.randrange(1, 9))]
    edges += [("hot", u) for u in users] + [("hot", "u3")] * 5                # repeated edges weigh more
    return edges


@pytest.mark.parametrize("target", ["u3", "7", "ü 7", "nobody"])
def test_ranking_equals_brute_force(spark, tmp_path, target):
    edges = graph_lines()
    lines = [f"{i}\t{u},x" if u == "" else f"{i}\t{u}" for i, u in edges]      # an empty user is no last field
    edges += [(i, "x") for i, u in edges if u == ""]
    log = [f"{target},it 1,0,pv,1", f"{target}, it 2 ,0,buy,1", f"{target}0,it 3,0,buy,1", f"{target},not in the graph,0,buy,1"]
    read = readers.read_index_fields(spark, write(spark, tmp_path, "index", lines))
    seen = prk.seen_items_text(spark.read.text(write(spark, tmp_path, "log", log)), target)
    before = left_over(spark)
    got = prk.recommend_text(read, seen, target, max_fanout=4)
    want = brute(edges, target, {"it 1", "it 2"})
    assert [(r["rank"], r["item_id"]) for r in got.orderBy("rank").collect()] == [(k + 1, i) for k, (i, _) in enumerate(want)]
    assert [r["score"] for r in got.orderBy("rank").collect()] == pytest.approx([s for _, s in want], abs=1e-12)
    assert left_over(spark) == before
    line = prk.recommendation_line(got, target).first()["value"]
    assert line.startswith(f"{target}\t{want[0][0]}:{want[0][1]:.3f}")


def test_log_line_without_item_fails(spark, tmp_path):
    lines = spark.read.text(write(spark, tmp_path, "log", ["t,,", "other,1"]))
    with pytest.raises(Exception, match="no item in clean log line"):
        prk.seen_items_text(lines, "t").collect()
    assert prk.seen_items_text(lines, "nobody").count() == 0


def test_kmeans_text_user_ids(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"user-{i}" if i % 3 else str(i), *[round(rng.random(), 4) for _ in range(3)]) for i in range(80)]
    path = write(spark, tmp_path, "features", [f" {u} ,{a},{b},{c}" for u, a, b, c in rows] + ["", "ü,0.5,0.5,0.5,more"])
    feats = readers.read_feature_fields(spark, path)
    assert sorted(map(tuple, feats.collect())) == sorted([*rows, ("ü", 0.5, 0.5, 0.5)])
    before = left_over(spark)
    model = km.fit(feats, 4)
    assert left_over(spark) == before
    numeric = feats.withColumn("user_id", F.col("user_id").cast("string"))
    assert km.init_centers(numeric, 4) == km.init_centers(feats, 4)
    labels = {r["user_id"]: r["cluster_id"] for r in km.labels(feats, model.centers).collect()}
    for u, *x in rows:
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) ** 0.5 for c in model.centers]
        assert labels[u] == far.index(min(far))
    assert "user-1," + str(labels["user-1"]) in [r["value"] for r in km.label_lines(km.labels(feats, model.centers)).collect()]
    for bad in ("u,0.1,0.2", "u,0.1,x,0.3"):
        with pytest.raises(Exception, match="malformed feature line"):
            readers.read_feature_fields(spark, write(spark, tmp_path, f"bad{len(bad)}", [bad])).collect()


def test_command_line_with_text_ids(spark, tmp_path):
    from cartograph import cli
    index = write(spark, tmp_path, "index", ["A\tx,y", "B\ty,z", "C\tz"])
    log = write(spark, tmp_path, "log", ["x,A,0,buy,1"])
    line = cli.personal_rank_job(spark, index, log, "x", str(tmp_path / "out"))
    assert line.split("\t")[0] == "x" and [p.split(":")[0] for p in line.split("\t")[1].split(",")] == ["B", "C"]
    feats = write(spark, tmp_path, "features", ["x,0,0,0", "y,1,1,1", "z,1,1,0.9"])
    cli.kmeans_job(spark, feats, str(tmp_path / "clusters"), 2)
    got = dict(r["value"].split(",") for r in spark.read.text(str(tmp_path / "clusters/user_cluster_labels")).collect())
    assert set(got) == {"x", "y", "z"} and got["y"] == got["z"] != got["x"]
