"""Packing and token counts, against the tokenizer library."""
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartograph.llm import packing, token_counts

from .conftest import SF, edge_texts

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def expected_pieces(rows):
    tokenizer, out = Tokenizer.from_file(WORD), []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], "<u4").tobytes()
            out.append((doc, k, at, len(part) // 4, zlib.crc32(part)))
    return out


def check_places(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def order(x):
    return [(-1 if v is None else v) for v in x]


def test_op1_pieces_and_places(spark, documents):
    rows = packing.op1_best_fit_packing(spark, SF).collect()
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == sorted(expected_pieces(documents))
    assert check_places(rows) <= -(-sum(r.length for r in rows) // 2048) * 1.03 + 1


def test_packing_edges(spark, edges, nothing):
    rows = packing.pack(edges, WORD).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=order)
    assert got == sorted(expected_pieces(edge_texts()), key=order)
    check_places(rows)
    assert packing.pack(nothing, WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=12))
def test_plan_places_every_piece_once(counts):
    runs, sequences = packing.plan(counts, 64)
    used, fill = set(), {}
    for length, rank, n, first, offset in runs.tolist():
        for i in range(n):
            assert (length, rank + i) not in used
            used.add((length, rank + i))
            fill.setdefault(first + i, []).append((offset, length))
    assert len(used) == sum(counts.values()) and len(fill) == sequences
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    lower = max(-(-sum(k * n for k, n in counts.items()) // 64), sum(n for k, n in counts.items() if k > 32))
    assert sequences <= 1.7 * lower + 1


def test_plan_uses_configurations():
    """Best fit alone opens with the largest pieces; thirds and halves need planned configurations."""
    runs, sequences = packing.plan({1024: 1000, 683: 1000, 341: 1000})
    assert sequences == 1000


def test_plan_size_does_not_follow_the_corpus():
    rng = np.random.default_rng(5)
    base = {int(k): int(n) for k, n in zip(range(1, 2049), rng.integers(1, 9, 2048))}
    small, large = packing.plan(base)[0], packing.plan({k: 1000 * n for k, n in base.items()})[0]
    assert len(large) < 20 * 2048 and len(small) < 20 * 2048


def expected_counts(rows):
    tokenizer = Tokenizer.from_file(BYTE)
    return [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]


def test_op4_equals_library(spark, documents):
    rows = token_counts.op4_token_counts(spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == sorted(expected_counts(documents))
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_token_counts_edges(spark, edges, nothing):
    want = sorted(expected_counts(edge_texts()), key=order)
    for size in (token_counts.BLOCK_BYTES, 1):
        got = sorted(map(tuple, token_counts.token_counts(edges, BYTE, size).collect()), key=order)
        assert got == want
    assert token_counts.token_counts(nothing, BYTE).count() == 0


PARTS = list("ab Z9'sdtreºµß²¼é\x85\xa0\x1c\x1f\n\t!-") + ["日", "\u0301", "<|endoftext|>"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_splits_are_those_of_the_library(text):
    byte, word = token_counts.tokenizer(BYTE), packing.word_ids(WORD)
    parts = token_counts.Splitter(BYTE)(text)
    assert "".join(parts) == text
    assert sum(len(byte.encode(p, add_special_tokens=False).ids) for p in parts) \
        == len(byte.encode(text, add_special_tokens=False).ids)
    want = word.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(word([text])), "<u4").tolist() == want
