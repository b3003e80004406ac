"""Source divergence, against a plain count in Python."""
import random
import re
from collections import Counter

import pytest

from cartograph.llm import divergence

from .conftest import SF

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, digest int, term string, n int, value string"


def plain(rows):
    """Rows of (lang, source, part, item, value, rank) from rows of (text, lang, source)."""
    docs, count, groups = Counter(), Counter(), {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        docs.update((lang, t) for t in terms)
        for t, n in terms.items():
            count[lang, source, t] += n
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= 10]
        v = len(kept)
        total = {s: sum(count[lang, s, t] for t in kept) for s in sources}

        def share(n, all_):
            return 1 + 10**9 * (n + 2) // (all_ + 2 * v)
        p = {s: {t: share(count[lang, s, t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(count[lang, s, t] for s in sources), sum(total.values())) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, value, r + 1) for r, (i, value) in enumerate(found[:most])]
    return sorted(out)


def frame(spark, rows):
    """With columns whose names clash with the operator's own."""
    return spark.createDataFrame([(1, *r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(5)


def texts(seed=3, docs=200, sources=7):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ab", "É", "日本", "Zo", "ß") for b in ("x", "Y", "é", "q", "tt", "uU")]
    rows = [(rng.choice((" ", "-", "1", "\n")).join(rng.choices(words, k=rng.randrange(1, 30))),
             rng.choice(["en", "en", "fr", None, ""]), rng.choice([f"s{i}" for i in range(sources)] + [None]))
            for _ in range(docs)]
    rows += [(None, "en", "only nulls"), ("", "de", "a"), ("  12 !", "de", "b"), ("one", "alone", "z")]
    rows += [("copy Of one text", "en", "hot")] * 80                          # a large group of copies
    return rows


def test_op13_equals_plain_count(spark):
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = divergence.op13_source_divergence(spark, SF)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_edges_and_digests_with_several_terms(spark, bits):
    rows = texts()
    got = divergence.audit(frame(spark, rows), bits).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_blocks_of_sources(spark):
    rows = texts(seed=9, sources=11)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows), width=3).collect())) == plain(rows)


def test_long_texts_and_full_tasks(spark, monkeypatch):
    rows = texts(seed=4)
    rows.append(("Long " * 500 + "x" * 700 + " end.of it", "en", "s1"))
    monkeypatch.setattr(divergence, "CHUNK", 64)
    monkeypatch.setattr(divergence, "HELD", 20)
    held, out = divergence.Terms(64), []
    import numpy as np
    import pyarrow as pa
    from cartograph.llm import common
    for text, lang, source in rows:
        data, off = common.utf8(pa.array([text or ""]))
        held.add(data, off, np.array([held.number(lang or "", source or "")]))
        if held.full:
            out += [r for b in held.rows() for r in b.to_pylist()]
    out += [r for b in held.rows() for r in b.to_pylist()]
    n, docs, term = Counter(), Counter(), {}
    for r in out:
        if r["digest"] is not None:
            assert term.setdefault(r["digest"], r["term"]) == r["term"]
            docs[r["lang"], r["digest"]] += r["docs"]
            for source, k in zip(r["sources"], r["ns"]):
                n[r["lang"], source, r["digest"]] += k
    want_n, want_docs = Counter(), Counter()
    for text, lang, source in rows:
        own = Counter(TERM.findall((text or "").translate(LOWER)))
        want_n.update({(lang or "", source or "", t): k for t, k in own.items()})
        want_docs.update((lang or "", t) for t in own)
    assert {(x, y, term[d]): k for (x, y, d), k in n.items()} == want_n
    assert {(x, term[d]): k for (x, d), k in docs.items()} == want_docs


def test_many_ties_and_nothing(spark):
    rows = [(" ".join(f"t{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(5)), "en", s)
            for s in ["a"] * 12 + ["b"]] + [("other " * 3, "en", "b")] * 10
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == plain(rows)
    assert divergence.audit(frame(spark, rows).where("doc_id < 0")).count() == 0
