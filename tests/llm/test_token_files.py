"""Files of packed token ids: exact round trips against the tokenizer library."""
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartograph.llm import common, token_files

from .conftest import SF, edge_texts

WORD = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    """doc_id, start, n_tokens, crc in ascending doc_id order, nulls first; equal ids have equal texts here."""
    tokenizer, out, at = Tokenizer.from_file(WORD), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def by_start(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_op12_equals_library(spark, documents):
    got = token_files.op12_bit_packed_ids(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert by_start(got.collect()) == expected(documents)


def test_edges(spark, edges, nothing):
    for size, block in ((token_files.FILE_BYTES, token_files.BLOCK_IDS), (1, 8), (4000, 64)):
        folder = common.scratch(spark, "files")
        index = token_files.write(edges, WORD, folder, file_bytes=size, block_ids=block)
        assert by_start(token_files.read(spark, folder).collect()) == expected(edge_texts())
        assert size > 4000 or index.count() >= 4
    folder = common.scratch(spark, "files")
    assert token_files.write(nothing, WORD, folder).count() == 0
    assert token_files.read(spark, folder).count() == 0


def test_one_id_for_many_rows_is_split(spark):
    """A third of the rows share one doc_id, another third have none."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    folder = common.scratch(spark, "files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        index = token_files.write(docs, WORD, folder, file_bytes=2000).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = by_start(token_files.read(spark, folder).collect())
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    ends = [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]
    assert len({r.part for r in index}) > 4 and max(r.documents for r in index) < 200


@pytest.mark.parametrize("width", [1, 3, 8, 13, 15, 16, 17, 20, 31, 32])
def test_bits_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1003).astype(np.uint32)
    data = token_files.pack_bits(ids, width)
    assert len(data) == -(-1003 * width // 8)
    assert (token_files.unpack_bits(data, 1003, width) == ids).all()
    ends = np.sort(rng.integers(0, 1004, 20)).tolist() + [1003]
    docs = [None if i % 5 == 0 else i for i in range(21)]
    whole = token_files.to_bytes(9, docs, ends, ids, width, 64)
    file = token_files.TokenFile(io.BytesIO(whole))
    assert file.doc_ids == docs and file.file == 9 and file.end == len(whole)
    for a, b in [(0, 1003), (0, 0), (63, 65), (64, 128), (1000, 1003), (500, 501)]:
        assert (file.read(a, b) == ids[a:b]).all()
    for i, (a, b) in enumerate(zip([0, *ends], ends)):
        assert (file.document(i) == ids[a:b]).all()
    got = [(d, s, n, c) for d, s, n, c in file.digests()]
    assert got == [(d, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes())) for d, a, b in zip(docs, [0, *ends], ends)]


def test_random_access_reads_only_its_blocks():
    ids = np.arange(100_000, dtype=np.uint32) % 49408

    class Source(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            Source.taken += n
            return super().read(n)
    file = token_files.TokenFile(Source(token_files.to_bytes(1, [1], [len(ids)], ids, 16, 1024)))
    Source.taken = 0
    assert (file.read(50_000, 50_010) == ids[50_000:50_010]).all()
    assert Source.taken == 2048


def test_damage_is_told():
    whole = token_files.to_bytes(1, [1], [100], np.arange(100, dtype=np.uint32), 16)
    with pytest.raises(ValueError):
        token_files.TokenFile(io.BytesIO(b"x" * 200))
    with pytest.raises(ValueError):
        token_files.TokenFile(io.BytesIO(whole[:-2])).read(0, 100)
    with pytest.raises(IndexError):
        token_files.TokenFile(io.BytesIO(whole)).read(0, 101)


def test_width_is_the_least():
    assert [token_files.width_of(v) for v in (1, 2, 3, 256, 257, 32000, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 15, 16, 16, 17]
