"""Secrets, decontamination and the helpers they share, against brute force."""
import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartograph.llm import common, decontaminate, secrets

from .conftest import SF, edge_texts

ASSIGN = re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                    "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def check_secrets(rows, texts):
    for r, text in zip(rows, texts, strict=True):
        spans = base_spans(text)
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == i for x in spans) for i in range(3)]


def test_op6_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = secrets.op6_secret_scans(spark, folder).orderBy("doc_id").collect()
    check_secrets(rows, [texts[i] for i in sorted(texts)])
    assert any(r.spans for r in rows)


def test_rules_keep_failing_matches_consumed():
    rules = secrets.compile_rules()
    kinds = [secrets.KINDS[s["kind"]] for s in secrets.find_spans("secret: token: abcdefgh", rules)]
    assert kinds == []
    text = "ToKeN='abcdefgh12' AKIAABCDEFGH123456 " + "ab12" * 8 + " ſecret=abcdefgh"
    assert [secrets.KINDS[s["kind"]] for s in secrets.find_spans(text, rules)] == ["assign", "access", "hex"]


def test_ledger_scans_each_blob_and_version_once(spark):
    path = common.scratch(spark, "test-ledger")
    frame = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "AKIA" + "B" * 20), (None, None)],
                                  "path string, content string")
    first = {r.path: r for r in secrets.scan_versions(frame, path).collect()}
    assert len(first["c"].spans) == 1 and not first["a"].spans and first[None].spans == []
    assert secrets.read_ledger(spark, path).count() == 3
    more = frame.union(spark.createDataFrame([("d", "x"), ("e", "new")], frame.schema))
    assert secrets.scan_versions(more, path).count() == 6
    assert secrets.read_ledger(spark, path).count() == 4
    secrets.scan_versions(frame, path, secrets.RULES[:3]).count()
    assert secrets.read_ledger(spark, path).count() == 7


def test_redaction(spark, edges, nothing):
    key = "x AKIA" + "C" * 16 + " y"
    frame = edges.limit(0).unionByName(spark.createDataFrame([(1, key), (2, "clean"), (3, None)],
                                                             "doc_id long, text string"), allowMissingColumns=True)
    out = {r.doc_id: r for r in secrets.redact(frame, common.scratch(spark, "l")).collect()}
    assert out[1].text == "x [SECRET:access] y" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "clean" and out[2].n_chars is None and out[3].text is None
    assert secrets.redact(edges, common.scratch(spark, "l")).count() == len(edge_texts())
    assert secrets.redact(nothing, common.scratch(spark, "l")).count() == 0


def plain_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    words, hit, own = plain_words(text), set(), set()
    for item, t in items:
        w = plain_words(t)
        k = min(10, len(w))
        grams = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(words) - k + 1):
            if grams and tuple(words[i:i + k]) in grams:
                hit.update(range(i, i + k))
                own.add(str(item))
    return len(words), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()


def test_op8_equals_brute_force(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = decontaminate.op8_benchmark_decontamination(spark, SF).orderBy("doc_id").collect()
    for r, (_, text) in zip(rows, sorted(documents), strict=True):
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == brute_hits(text, items)
        assert r.contaminated == (r.n_hit > 0)
    assert any(r.contaminated for r in rows)


def test_hits_are_mapped_to_the_original_text(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    for r in decontaminate.scan(docs, items).collect():
        hits = r["__hits"]
        inside = [plain_words(r.text[x.start:x.end]) for x in hits["chars"]]
        words = plain_words(r.text)
        assert inside == [words[x.start:x.end] for x in hits["words"]]


def test_decontamination_edges_and_blocks(spark, edges, nothing, monkeypatch):
    items = [(1, "one"), (2, "One, two THREE"), (3, None), (4, " .. "), (None, "one"), (1, "日本語")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((brute_hits(t, [x for x in items if x[0]])[:3] for _, t in edge_texts()))
    for size in (decontaminate.BLOCK_CHARS, 1):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        found = decontaminate.scan(edges, benchmark)
        assert set(edges.columns) < set(found.columns)
        got = sorted((r["__n_words"], sum(x.end - x.start for x in r["__hits"]["words"]), len(r["__hits"]["items"]))
                     for r in found.collect())
        assert got == want
    assert decontaminate.drop_contaminated(nothing, benchmark).count() == 0
    assert decontaminate.drop_contaminated(edges, benchmark.limit(0)).count() == len(edge_texts())


def test_pieces_have_the_windows_of_the_item():
    rng = np.random.default_rng(4)
    for n in (0, 1, 9, 10, 11, 30, 200):
        words = [b"w%d" % x for x in rng.integers(0, 1000, n)]
        for most in (1, 200, 1 << 20):
            cut = decontaminate.pieces(words, most)
            parts = [decontaminate.windows(decontaminate.normal_words(p)) for p, _ in cut]
            assert set().union(*parts) == decontaminate.windows(words)
            assert all(sum(map(len, p)) <= c and (c <= most or len(p) == 1) for p, (_, c) in zip(parts, cut, strict=True))
            assert most < 1 << 20 or len(cut) == min(n, 1)


def test_blocks_are_bounded_and_scanned_one_after_another(spark, documents, monkeypatch):
    """A benchmark of several blocks, one item longer than a block, gives the rows of one automaton."""
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items.append(("long", " ".join(t for _, t in documents[:3])))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    total = decontaminate.blocks(benchmark)[0].agg(F.sum("cost")).first()[0]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", total // 3)
    monkeypatch.setattr(decontaminate, "PART_BLOCKS", 2)
    dealt, numbers = decontaminate.blocks(benchmark)
    sums = dealt.groupBy("part", "block").agg(F.sum("cost").alias("c")).collect()
    assert 3 <= len(numbers) == len(sums) and max(r.c for r in sums) <= total // 3 * 9 / 8
    found = {r.doc_id: r for r in decontaminate.scan(docs, benchmark).collect()}
    assert len(found) == len(documents)
    for i, text in documents:
        hits = found[i]["__hits"]
        n_hit = sum(x.end - x.start for x in hits["words"])
        digest = hashlib.sha256(",".join(hits["items"]).encode()).hexdigest()
        assert (found[i]["__n_words"], n_hit, len(hits["items"]), digest) == brute_hits(text, items)
        assert [plain_words(text[x.start:x.end]) for x in hits["chars"]] == \
            [plain_words(text)[x.start:x.end] for x in hits["words"]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t日", max_size=40)), max_size=8))
def test_word_hashes_are_those_of_the_words(texts):
    words = [re.findall("[^\x20\x09-\x0D]+", t or "") for t in texts]
    data, off = common.utf8(pa.array(texts, pa.string()))
    h, woff = common.word_hashes(data, off, common.SPACE_WORDS)
    assert np.diff(woff).tolist() == list(map(len, words))
    flat = [w for x in words for w in x]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))
    s, soff = common.shingle_hashes(h, woff, 3)
    grams = [[tuple(x[i:i + 3]) for i in range(max(1, len(x) - 2))] if x else [] for x in words]
    assert np.diff(soff).tolist() == list(map(len, grams))
    flat = [g for x in grams for g in x]
    assert len(set(zip(flat, s.tolist()))) == len(set(flat)) == len(set(s.tolist()))
