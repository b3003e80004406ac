"""Token counts without token ids.

Texts are split into pre-tokens by the vocabulary's own rule. A block of documents keeps its
distinct pre-tokens and, per document, how often each occurs. The pre-tokens of all blocks are
dealt by their value, so that each distinct one is tokenized once; the piece counts go back to
the blocks and are joined to the frequencies, and a document's sum is its token count. A
pre-token is one row per block at most, so a common one is no hot key.

Defined cases: a null or empty text has no bytes and no tokens; a special token's string in a
text is one token, as the library has it by default; copies and repeated rows are counted one by
one; a text longer than a block is a block of its own; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LIMIT = 1024
#: Bytes of text of a block; a worker holds the distinct pre-tokens of one.
BLOCK_BYTES = 32 << 20

_L, _N, _S = "a-zA-Zªµºß-öø-ÿÀ-ÖØ-Þ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
#: The byte-level split for texts of Latin-1 characters.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_OTHER = re.compile("[^\x00-\xff]")


@functools.lru_cache(maxsize=1)
def tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class Splitter:
    """Pre-tokens of a text; a special token's string is one."""

    def __init__(self, path: str):
        self.rule = tokenizer(path).pre_tokenizer
        special = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def _plain(self, text: str) -> list[str]:
        if _OTHER.search(text):
            return [text[s:e] for _, (s, e) in self.rule.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def __call__(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self._plain(part)
        return out


class Numbers(dict):
    """Numbers words from 0 as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def pack_counts(ids: np.ndarray, ends: list[int]) -> bytes:
    """Frequencies of each document's words: pairs per document, word numbers as differences, counts."""
    doc = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
    key, n = np.unique(doc << 32 | ids, return_counts=True)
    pairs = np.bincount(key >> 32, minlength=len(ends))
    word = (key & 0xFFFFFFFF).astype(np.int32)
    step = np.diff(word, prepend=np.int32(0))
    return zlib.compress(b"".join(x.astype("<i4").tobytes() for x in (pairs, step, n)), 1)


def unpack_counts(packed: bytes, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document numbers, word numbers and counts."""
    x = np.frombuffer(zlib.decompress(packed), "<i4")
    pairs, rest = x[:documents], x[documents:]
    return np.repeat(np.arange(documents), pairs), np.cumsum(rest[:len(rest) // 2]), rest[len(rest) // 2:]


BLOCK = "block long, docs array<long>, sizes array<long>, packed binary, words array<string>"


def blocks(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents, their sizes, their frequencies and the distinct pre-tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, block = Splitter(path), TaskContext.get().partitionId() << 32
        docs, sizes, ends, parts, words = [], [], [], [], Numbers()

        def done() -> pa.RecordBatch:
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            row = [[block], [docs], [sizes], [pack_counts(ids, ends)], [list(words)]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types, strict=True)],
                                              ["block", "docs", "sizes", "packed", "words"])
        size = total = 0
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                n = len(text.encode())
                if docs and size + n > block_bytes:
                    yield done()
                    block += 1
                    docs, sizes, ends, parts, words = [], [], [], [], Numbers()
                    size = total = 0
                ids = list(map(words.__getitem__, split(text)))
                total += len(ids)
                size += n
                docs.append(doc)
                sizes.append(n)
                ends.append(total)
                parts.append(np.array(ids, np.int64))
        if docs:
            yield done()
    return common.with_id_kept(docs).mapInArrow(run, BLOCK)


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """(block, at): a pre-token's place in its block and its pieces, in one number.

    words(block, place, word) are dealt by word; a task counts the pieces of each of its words once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in batches:
            column = b.column("word").to_pylist()
            new = list(set(column) - known.keys())
            for i in range(0, len(new), 2000):
                part = new[i:i + 2000]
                found = tokenizer(path).encode_batch_fast(part, add_special_tokens=False)
                known.update(zip(part, map(len, found), strict=True))
            n = np.fromiter(map(known.__getitem__, column), np.int64, len(column))
            at = b.column("place").to_numpy().astype(np.int64) << 32 | n
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(at)], ["block", "at"])
    return words.repartition("word").mapInArrow(run, "block long, at long")


def token_counts(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of docs."""
    spark = docs.sparkSession
    folder = common.scratch(spark, "pre-tokens")
    blocks(docs, path, block_bytes).write.option("compression", "zstd").parquet(folder)
    table = spark.read.schema(BLOCK).parquet(folder)
    words = table.select("block", F.posexplode("words").alias("place", "word"))
    counts = piece_counts(words, path).groupBy("block").agg(F.collect_list("at").alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                docs, at = b.column("docs")[r].values, b.column("counts")[r].values
                at = at.to_numpy() if at is not None else np.zeros(0, np.int64)
                pieces = np.zeros(len(at), np.int64)
                pieces[at >> 32] = at & 0xFFFFFFFF
                doc, word, n = unpack_counts(b.column("packed")[r].as_py(), len(docs))
                tokens = np.bincount(doc, weights=pieces[word] * n, minlength=len(docs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([docs, b.column("sizes")[r].values, pa.array(tokens)],
                                                 ["doc_id", "n_bytes", "n_tokens"])
    # one row per block on both sides
    joined = table.select("block", "docs", "sizes", "packed").join(counts, "block", "left")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """One row per document: bytes, tokens, and whether there are more than 1024."""
    import public_tokenizers
    common.prepare(spark)
    found = token_counts(common.read(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > LIMIT)
