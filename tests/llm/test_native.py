"""Quality rules and sharding, against brute force; both plans have no Python."""
import math
import re
import zlib
from collections import Counter

from cartograph.llm import quality, sharding

from .conftest import SF, edge_texts


def base_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if many[g] > 1:
            inside.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(inside))


def check_quality(rows, texts):
    for r, text in zip(rows, texts, strict=True):
        want = base_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_op5_base_rules_and_clean_documents(spark, documents):
    df = quality.op5_quality_rules(spark, SF)
    rows = df.orderBy("doc_id").collect()
    check_quality(rows, [t for _, t in sorted(documents)])
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(good[r.doc_id], r.kept) for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(kept for q, kept in judged if q == 1) >= 0.97 * sum(q for q, _ in judged)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_edges(spark, edges, nothing):
    counts = quality.features(edges).cache()
    rows = {}
    for r in quality.judged(counts).collect():
        rows.setdefault((r.doc_id is None, r.doc_id or 0), []).append(r)
    for i, t in edge_texts():
        check_quality([rows[(i is None, i or 0)].pop()], [t])
    assert quality.judged(quality.features(nothing)).count() == 0
    assert quality.features(spark.createDataFrame([(1, "x")], "doc_id long, text string")).first().lang == ""


def test_distance_is_jensen_shannon(spark):
    p, q = [3, 0, 5, 2], [1, 4, 4, 1]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda u, v: sum(x * math.log2(x / y) for x, y in zip(u, v) if x)
    m = [(x + y) / 2 for x, y in zip(a, b)]
    want = math.sqrt((kl(a, m) + kl(b, m)) / 2)
    df = spark.createDataFrame([(p, q), (p, p), ([0] * 4, q), (p, None)], "p array<long>, q array<long>")
    got = [r[0] for r in df.select(quality.js_distance("p", "q")).collect()]
    assert abs(got[0] - want) < 1e-12 and got[1:] == [0.0, 0.0, 0.0]


def check_slots(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return slots


def test_op9_law_and_slots(spark, documents):
    df = sharding.op9_kd_sharding(spark, SF)
    rows = df.collect()
    sizes = {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert set(sizes) == set(range(16)) and {r.law for r in rows} == {"bytes"}
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    check_slots(rows)
    want = sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in documents)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_sharding_edges(spark, edges, nothing):
    for n in (1, 3, 7):
        rows = sharding.kd_shards(edges, shards=n).collect()
        assert len(rows) == len(edge_texts()) and {r.shard for r in rows} <= set(range(n))
        check_slots(rows)
    assert sharding.kd_shards(nothing, shards=4).count() == 0
    assert {r.shard for r in sharding.kd_shards(edges, target_bytes=1 << 40).collect()} == {0}


def test_one_document_with_all_rows_is_divided(spark):
    frame = spark.range(4000).selectExpr("7 AS doc_id", "'same text' AS text", "'s' AS source", "'en' AS lang")
    rows = sharding.kd_shards(frame, shards=4).groupBy("shard").count().collect()
    assert len(rows) == 4 and max(r["count"] for r in rows) < 1200


def split_by_definition(rows, leaves):
    """Shards in order: rows (doc_id, size, tie, at) divided at the weighted median of their widest dimension."""
    if leaves == 1:
        return [{r[0] for r in rows}]
    widths = [max(r[3][i] for r in rows) - min(r[3][i] for r in rows) for i in range(4)]
    dim = widths.index(max(widths))
    weights = Counter()
    for r in rows:
        weights[r[3][dim], r[2]] += r[1]
    target, before = sum(weights.values()) * (leaves // 2) / leaves, 0
    for key in sorted(weights):
        if before + weights[key] >= target:
            left = target - before >= weights[key] / 2
            break
        before += weights[key]
    low = [r for r in rows if ((r[3][dim], r[2]) <= key if left else (r[3][dim], r[2]) < key)]
    high = [r for r in rows if not ((r[3][dim], r[2]) <= key if left else (r[3][dim], r[2]) < key)]
    return split_by_definition(low, leaves // 2) + split_by_definition(high, leaves - leaves // 2)


def test_splits_are_weighted_medians_of_the_widest_dimension(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.size, r.tie, r["at"]) for r in sharding.narrow(docs).collect()]
    for n in (5, 16):
        got = {}
        for r in sharding.kd_shards(docs, shards=n).collect():
            got.setdefault(r.shard, set()).add(r.doc_id)
        assert [got[i] for i in range(n)] == split_by_definition(rows, n)
