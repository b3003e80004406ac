"""The n-gram join and repeated passages, against brute force."""
import random
import re
import time
from itertools import combinations
from math import comb

import numpy as np
import pytest

from cartograph.llm import ngram_join, substrings
from cartograph.llm.components import components

from .conftest import SF, edge_texts


def grams(text, k=5):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_classes(rows):
    """doc -> (class, links) by comparing all pairs of different texts."""
    sets = {t: grams(t) for t in {t or "" for _, t in rows}}
    links, root = dict.fromkeys(sets, 0), {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 5 * both >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        r = find(t or "")
        ids = [x for x in (least.get(r), i) if x is not None]
        least[r] = min(ids) if ids else None
    return sorted(((i, least[find(t or "")], links[t or ""]) for i, t in rows), key=str)


def near_copies(n, length=120, seed=3):
    """A group of copies of one text with a few words changed, and texts of their own."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(length)] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out + [" ".join(f"o{rng.randrange(10**6)}" for _ in range(80)) for _ in range(30)]


def classes(df):
    return sorted(((r.doc_id, r["__class_id"], r["__n_links"]) for r in ngram_join.classed(df).collect()), key=str)


def test_op10_equals_brute_force(spark, documents):
    got = sorted((tuple(r) for r in ngram_join.op10_ngram_jaccard_join(spark, SF).collect()), key=str)
    assert got == brute_classes(documents)


@pytest.mark.parametrize("block", [1024, 16])
def test_large_groups_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = near_copies(150)
    rows = list(enumerate([*texts, texts[0], texts[3], texts[3]]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(df) == brute_classes(rows)


def test_join_edges(spark, edges, nothing):
    assert classes(edges) == brute_classes(edge_texts())
    kept = ngram_join.keep_one(edges)
    assert kept.columns == edges.columns
    assert len(kept.collect()) == len({c for _, c, _ in brute_classes(edge_texts())})
    assert classes(nothing) == [] and ngram_join.keep_one(nothing).count() == 0


def test_pruning_bound_is_the_posterior():
    t, n = 0.8, 128
    x = (np.arange(200_000) + 0.5) / 200_000
    for n, least in zip(range(16, 129, 16), ngram_join.least_matches(), strict=True):
        density = lambda m: np.exp(m * np.log(x) + (n - m) * np.log1p(-x))
        tail = lambda m: density(m)[x >= t].sum() / density(m).sum()
        assert tail(least) >= 0.9e-6 and (least == 0 or tail(least - 1) < 1.1e-6)


def test_components(spark):
    rng = random.Random(1)
    edge = [(i, i + 1) for i in range(0, 90)] + [(200, rng.randrange(201, 260)) for _ in range(80)] + [(500, 499)]
    got = dict(map(tuple, components(spark.createDataFrame(edge, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(1, 91)) and got[500] == 499
    assert all(got[b] == 200 for a, b in edge if a == 200)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_windows(v, least):
    out = set()

    def node(lo, hi):
        if hi - lo + 1 >= least:
            c = lo + min(range(hi - lo + 1), key=lambda i: (v[lo + i] >> 32, i))
            out.add((lo, c, hi))
            node(lo, c - 1)
            node(c + 1, hi)
    node(0, len(v) - 1)
    return out


def test_compact_windows_are_the_tree():
    rng = np.random.default_rng(2)
    for sizes in ([0, 5, 40, 0, 41, 200], [39], [40], [300], []):
        off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        v = rng.integers(0, 1 << 63, int(off[-1])).astype(np.uint64)
        v[rng.random(len(v)) < 0.3] = 5 << 32
        row, lo, c, hi = substrings.compact_windows(v, off, 40)
        for i in range(len(sizes)):
            got = {tuple(map(int, x)) for x in zip(lo[row == i], c[row == i], hi[row == i])}
            assert got == brute_windows(v[off[i]:off[i + 1]].tolist(), 40)


def exact_repeats(rows, k=50):
    where = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        for j in range(len(w) - k + 1):
            where.setdefault(tuple(w[j:j + k]), set()).add(i)
    return {i for s in where.values() if len(s) > 1 for i in s}


def check_rows(rows, texts):
    words = {i: re.findall("[^\x20\x09-\x0D]+", t or "") for i, t in texts}
    for r in rows:
        a = words[r.doc_id][r.start_word:r.end_word]
        b = words[r.match_doc_id][r.match_start_word:r.match_end_word]
        x, y = grams(" ".join(a)), grams(" ".join(b))
        assert min(len(a), len(b)) >= 50 and len(x & y) * 5 >= 4 * len(x | y)
        assert abs(len(x & y) / len(x | y) - r.similarity) < 1e-9


def test_op7_finds_all_exact_repeats(spark, documents):
    rows = substrings.op7_substring_dedup(spark, SF).collect()
    check_rows(rows, documents)
    assert exact_repeats(documents) <= {r.doc_id for r in rows}


def test_planted_passages(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**5)}"
    passage = [word() for _ in range(60)]
    texts = []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(40, 200))]
        if i < 40:
            at = rng.randrange(len(w))
            w[at:at] = passage
        texts.append((i, " ".join(w)))
    texts += [(100, " ".join([word() for _ in range(20)] + passage[:30] + ["changed"] + passage[31:]))]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    rows = substrings.repeated_passages(df).collect()
    check_rows(rows, texts)
    assert set(range(40)) <= {r.doc_id for r in rows} <= set(range(40)) | {100}
    exact = [r for r in rows if r.doc_id < 40 and r.match_doc_id < 40]
    assert all(r.end_word - r.start_word >= 60 for r in exact)


def brute_passage(x, y, least=46):
    """Whether any two ranges of at least 46 distinct shingles have a similarity of 0.8 or more."""
    n, m = len(x), len(y)
    at = {v: j for j, v in enumerate(y)}
    grid = np.zeros((n + 1, m + 1), np.int32)
    for i, v in enumerate(x):
        if v in at:
            grid[i + 1, at[v] + 1] = 1
    grid = grid.cumsum(0).cumsum(1)
    for s in range(n - least + 1):
        for e in range(s + least, n + 1):
            row = grid[e] - grid[s]
            shared = row[None, :] - row[:, None]
            u, v = np.indices(shared.shape)
            total = (e - s) + (v - u) - shared
            if ((v - u >= least) & (shared * 5 >= total * 4)).any():
                return True
    return False


@pytest.mark.parametrize("length, edits", [(60, [30]), (80, [40]), (100, [33, 66]), (200, [40, 80, 120, 160])])
def test_edited_passages_of_the_reviewer(length, edits):
    x = np.arange(length, dtype=np.uint64)
    y = x.copy()
    y[edits] += np.uint64(10**6)
    a, b = ([hash(tuple(z[i:i + 5].tolist())) & (2**63 - 1) for i in range(length - 4)] for z in (x, y))
    (found,) = substrings.passages(np.array(a, np.uint64), np.array(b, np.uint64), [[0, len(a) - 1, 0, len(b) - 1]])
    assert found[:4] == (0, length, 0, length) and found[4] >= 0.8


def test_edited_passages_against_brute_force():
    rng = random.Random(5)
    cases = [(n, [i]) for n in (50, 54, 60) for i in range(n)]
    cases += [(n, rng.sample(range(n), k)) for n in (52, 60, 70) for k in (2, 3, 4) for _ in range(8)]
    kinds = {True: 0, False: 0}
    for n, edits in cases:
        passage = [rng.randrange(10**9) for _ in range(n)]
        around = [[rng.randrange(10**9) for _ in range(rng.randrange(8))] for _ in range(4)]
        other = []
        for i, w in enumerate(passage):
            kind = rng.randrange(3) if i in edits else 3
            other += {0: [rng.randrange(10**9)], 1: [], 2: [w, rng.randrange(10**9)], 3: [w]}[kind]
        a, b = around[0] + passage + around[1], around[2] + other + around[3]
        x, y = (np.array([hash(tuple(z[i:i + 5])) & (2**63 - 1) for i in range(len(z) - 4)], np.uint64) for z in (a, b))
        if min(len(x), len(y)) < 46:
            continue
        found = substrings.passages(x, y, [[0, len(x) - 1, 0, len(y) - 1]])
        want = brute_passage(x.tolist(), y.tolist())
        kinds[want] += 1
        assert bool(found) == want, (n, edits)
        for s, e, u, v, j in found:
            p, q = set(x[s:e - 4].tolist()), set(y[u:v - 4].tolist())
            assert min(e - s, v - u) >= 50 and j == len(p & q) / len(p | q) >= 0.8
    assert min(kinds.values()) > 5


def test_changed_word_in_a_planted_passage(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**5)}"
    passage = [word() for _ in range(60)]
    texts = [(i, " ".join([word() for _ in range(40)] + passage)) for i in range(10)]
    texts += [(100, " ".join([word() for _ in range(20)] + passage[:30] + ["changed"] + passage[31:]))]
    rows = substrings.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
    check_rows(rows, texts)
    assert {r.doc_id for r in rows} == set(range(10)) | {100}


def test_recall_of_the_functions():
    def missed(p):
        n, least = substrings.FUNCTIONS, substrings.ENOUGH
        return sum(comb(n, k) * p**k * (1 - p)**(n - k) for k in range(least))
    assert missed(0.8) <= 0.2**4 and missed(30 / 56) <= (26 / 56)**4  # four functions, one of them enough


def test_strangers_between_windows():
    anchors = [[0, 10, 0, 60, 10, 0, 60], [1, 20, 0, 60, 300, 280, 340], [2, 30, 0, 60, 30, 0, 60]]
    assert substrings.joined_windows(np.array(anchors)) == [(0, 60, 0, 60)]


def test_repeats_with_a_common_sentence(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    some = lambda n: [word() for _ in range(n)]
    hot = some(30)
    texts = [(i, some(30) + hot + some(30)) for i in range(200)]
    for k in range(60):
        passage = some(10) + hot + some(20)
        texts += [(1000 + k, some(20) + passage + some(20)), (2000 + k, some(20) + passage + some(20))]
    texts = [(i, " ".join(w)) for i, w in texts]
    rng.shuffle(texts)
    rows = substrings.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(8)).collect()
    check_rows(rows, texts)
    assert {(r.doc_id, r.match_doc_id) for r in rows if r.doc_id < r.match_doc_id} >= {(1000 + k, 2000 + k) for k in range(60)}


def test_near_copies_with_a_common_sentence(spark):
    """One changed word in a passage around a sentence that many strangers have."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    some = lambda n: [word() for _ in range(n)]
    hot = some(40)
    texts = [(i, some(30) + hot + some(30)) for i in range(300)]
    for k in range(100):
        passage = some(10) + hot + some(10)
        changed = passage[:30] + [word()] + passage[31:]
        texts += [(1000 + k, some(20) + passage + some(20)), (2000 + k, some(20) + changed + some(20))]
    texts = [(i, " ".join(w)) for i, w in texts]
    rng.shuffle(texts)
    rows = substrings.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    check_rows(rows, texts)
    assert {(r.doc_id, r.match_doc_id) for r in rows} >= {(1000 + k, 2000 + k) for k in range(100)}


def test_cuts_leave_no_shuffle_files(spark):
    """Whatever is cut later must not lie on disk beside what it was made of."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in map(str, disk.getAllFiles().mkString("\n").split("\n")) if "/shuffle_" in x}
    before = shuffled()
    df = spark.range(20_000).selectExpr("id", "xxhash64(id) AS k").repartition(4, "k")
    out = substrings._cut(df.mapInArrow(lambda batches: batches, "id long, k long"))
    end = time.time() + 10
    while not shuffled() <= before and time.time() < end:  # removed in the background
        time.sleep(0.2)
    assert shuffled() <= before and out.count() == 20_000


def test_lines_of_single_shingles_from_several_tasks(spark):
    """Two shingles on one line are a candidate wherever their links were made."""
    anchor = lambda c, d: np.array([substrings.SINGLE, c, c - 45, c + 46, c + d, c + d - 45, c + d + 46], "<i4").tobytes()
    links = [(1, 2, anchor(100, 7)), (1, 2, anchor(130, 7)), (3, 4, anchor(100, 7)), (3, 4, anchor(130, 8)), (5, 6, anchor(100, 7))]
    rows = substrings.candidate_ranges(spark.createDataFrame(links, "nid long, hub long, anchors binary")).collect()
    assert [(r.nid, r.hub, np.frombuffer(r.ranges, "<i4").tolist()) for r in rows] == [(1, 2, [55, 176, 62, 183])]


@pytest.mark.parametrize("words", [40, 400, 10**9])
def test_ranges_are_tried_on_their_words(spark, words):
    """The words around a range decide as the whole texts do, also where texts repeat words."""
    rng = random.Random(words)
    rows, want = [], {}
    for k in range(40):
        some = lambda n: [f"w{rng.randrange(words)}" for _ in range(n)]
        shared = some(rng.randrange(50, 90))
        other = [w if rng.randrange(60) else "x" for w in shared]
        at, to = rng.randrange(0, 200), rng.randrange(0, 200)
        a, b = (some(n) + z + some(rng.randrange(0, 200)) for n, z in ((at, shared), (to, other)))
        ranges = [[at + 9, at + 40, to + 9, to + 40], [at, at + len(shared) - 5, to, to + len(shared) - 5]]
        x, y = (dict(substrings.common.shingled(substrings.pa.array([" ".join(z)]), 5))[0] for z in (a, b))
        want[k] = [r for r in ranges if substrings.passages(x, y, [r])]
        rows.append((k, " ".join(a), " ".join(b), bytearray(np.array(ranges, "<i4").tobytes())))
    texts = [(i, i, bytearray(substrings.zlib.compress(t.encode()))) for k, a, b, _ in rows for i, t in ((k, a), (100 + k, b))]
    body = spark.createDataFrame(texts, "nid long, doc_id long, body binary")
    pairs = spark.createDataFrame([(k, 100 + k, r) for k, _, _, r in rows], substrings.RANGES)
    got = {r.nid: np.frombuffer(r.ranges, "<i4").reshape(-1, 4).tolist() for r in substrings.tried(pairs, body).collect()}
    assert got == {k: r for k, r in want.items() if r} and got


def random_texts(rng, words):
    """Shingles of two texts that may share passages, with edits, repeats and moved parts."""
    some = lambda n: [rng.randrange(words) for _ in range(n)]
    shared = some(rng.randrange(30, 110))
    other = [w if rng.randrange(25) else -rng.randrange(1, 10**9) for w in shared]
    if rng.random() < 0.3:
        other = other[40:] + other[:40]
    a, b = (some(rng.randrange(120)) + z + some(rng.randrange(120)) for z in (shared, other))
    return [np.array([hash(tuple(z[i:i + 5])) & (2**63 - 1) for i in range(len(z) - 4)], np.uint64) for z in (a, b)]


@pytest.mark.parametrize("words", [4, 30, 10**9])
def test_ranges_with_a_passage_are_possible(words):
    """Bits of the shingles rule out no range that has a passage, and most that have none."""
    rng = random.Random(words)
    cases = [random_texts(rng, words) for _ in range(150)]
    cases = [(x, y) for x, y in cases if min(len(x), len(y)) >= 46]
    ranges = [[0, len(x) - 1, 0, len(y) - 1] for x, y in cases]
    ranges = [r if rng.random() < 0.5 else [a := rng.randrange(r[1]), rng.randrange(a, r[1] + 1), b := rng.randrange(r[3]),
                                            rng.randrange(b, r[3] + 1)] for r in ranges]
    sides = []
    for k, texts in enumerate(zip(*cases, strict=True)):
        size = np.array([len(t) for t in texts])
        base = np.cumsum(size) - size
        low, high = np.array(ranges)[:, 2 * k], np.array(ranges)[:, 2 * k + 1] + 1
        wide = np.maximum(low - 46, 0), np.minimum(high + 46, size)
        bits = (np.concatenate(texts) & np.uint64(0xFFFFFF)).astype(np.uint32)
        sides.append((bits, *(np.stack([base + p, q - p], 1) for p, q in ((low, high), wide))))
    (x, xrun, xwide), (y, yrun, ywide) = sides
    got = set(substrings.possible(x, y, xrun, yrun, xwide, ywide).tolist())
    want = {i for i, ((a, b), r) in enumerate(zip(cases, ranges, strict=True)) if substrings.passages(a, b, [r])}
    assert want and want <= got and (words < 10**9 or len(got) < len(cases) * 2 / 3)


def test_search_does_not_step_through_every_end(monkeypatch):
    """A long near copy with a repeated sentence takes few steps for its number of edits."""
    rng = random.Random(1)
    x = [rng.randrange(10**9) for _ in range(3000)]
    x[2000:2020] = x[100:120]
    y = [w if rng.randrange(30) else rng.randrange(10**9) for w in x]
    a, b = (np.array([hash(tuple(z[i:i + 5])) & (2**63 - 1) for i in range(len(z) - 4)], np.uint64) for z in (x, y))
    steps = []
    real = substrings.heapq.heappush
    monkeypatch.setattr(substrings.heapq, "heappush", lambda *z: (steps.append(1), real(*z)))
    found = substrings.passages(a, b, [[0, len(a) - 1, 0, len(b) - 1]])
    assert len(found) == 12 and len(steps) < 1000  # 2307 when it stepped through every end


def test_equal_values_side_by_side():
    rng = np.random.default_rng(4)
    for most in (5, 1000, 1 << 62):
        v = rng.integers(0, most, 700)
        order = substrings.grouped(v)
        assert sorted(order.tolist()) == list(range(700))
        runs = np.count_nonzero(np.diff(v[order])) + 1
        assert runs == len(np.unique(v)) and (np.diff(order)[v[order[1:]] == v[order[:-1]]] > 0).all()
        row = np.sort(rng.integers(0, 4, 700))
        last, want = {}, []
        for i, key in enumerate(zip(row.tolist(), v.tolist(), strict=True)):
            want.append(last.get(key, -1))
            last[key] = i
        assert substrings.earlier_in_rows(v.astype(np.uint64), row).tolist() == want


def test_pairs_go_on_in_the_next_batch(spark):
    """The links of a pair are read together, however many batches they fill."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        anchor = lambda f, c: np.array([f, c, c - 20, c + 60, c + 7, c - 13, c + 67], "<i4").tobytes()
        links = [(n, 0, anchor(f, 100 + n)) for n, many in ((1, 1), (2, 8), (3, 2), (4, 20), (5, 1)) for f in [0, 1] * many]
        rows = substrings.candidate_ranges(spark.createDataFrame(links, "nid long, hub long, anchors binary")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.nid, r.hub): np.frombuffer(r.ranges, "<i4").tolist() for r in rows} == {
        (n, 0): [80 + n, 160 + n, 87 + n, 167 + n] for n in range(1, 6)}
    assert len(rows) == 5


def test_passage_edges(spark, edges, nothing):
    rows = substrings.repeated_passages(edges).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in rows} == {(7, 0, 30000), (8, 0, 30000)}
    assert substrings.repeated_passages(nothing).count() == 0
