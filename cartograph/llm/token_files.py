"""Token ids in files of fixed-width bit packing.

A file holds whole documents in ascending order of doc_id (nulls first; equal ids in the order of
the input's rows):

    header      8 bytes of magic, then ten little-endian 64-bit integers (``FIELDS``)
    documents   doc_id as 64-bit integers, one byte each that is 1 for a null id, and the end of each
                document, counted in ids from the file's first
    blocks      the byte at which each block of ``block_ids`` ids begins, counted from the first
                block; one more for the end
    ids         each in the least number of bits that the vocabulary needs; every block begins at a byte

so that the bytes of an id follow from its number: any range of ids is read by a seek and unpacked
by numpy without a loop over ids.

Writing. Documents are range-partitioned and sorted by (doc_id, row), so a doc_id that many rows
share is split among tasks; the bounds come from a sample of the keys, before any text is encoded. A
task encodes its rows and cuts them into files of about ``file_bytes``. Files go to the shared folder under the name of the task's attempt; the rows
that the task returns name them, so files of lost attempts are never read. The index table has one
row per file with its first id in the whole data set, from the sums of the files before it.

Reading goes through Spark's reader of binary files, one file at a time in a task.

Defined cases: a null or empty text has the end id alone; repeated rows and equal ids are written one by
one; a text longer than a file is a file of its own; an empty table gives no file and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import common
from .word_ids import word_ids

END_ID = 1
FILE_BYTES, BLOCK_IDS = 32 << 20, 1 << 16
MAGIC = b"IDBITS1\0"
FIELDS = ("file", "width", "documents", "ids", "block_ids", "blocks", "documents_at", "blocks_at", "ids_at", "end")
_HEADER = len(MAGIC) + 8 * len(FIELDS)
#: Ids that are unpacked at once.
PASS_IDS = 1 << 20


def width_of(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids below 2 ** width, the first one in the lowest bits."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = ids.astype("<u4")[:, None] >> np.arange(width, dtype=np.uint32) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes | memoryview, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    room = bytearray(len(data) + 8)
    room[:len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", room, strides=(1,))
    bit = np.arange(n, dtype=np.int64) * width
    return (eight[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.uint32)


def to_bytes(file: int, docs: list[int | None], ends: list[int], ids: np.ndarray, width: int,
             block_ids: int = BLOCK_IDS) -> bytes:
    """A whole file. block_ids is a multiple of 8, so that full blocks end with a byte."""
    blocks = [pack_bits(ids[i:i + block_ids], width) for i in range(0, len(ids), block_ids)]
    at = np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)]).astype("<i8")
    table = np.array([0 if d is None else d for d in docs], "<i8").tobytes() \
        + bytes(d is None for d in docs) + np.array(ends, "<i8").tobytes()
    blocks_at = _HEADER + len(table)
    ids_at = blocks_at + 8 * len(at)
    head = [file, width, len(docs), len(ids), block_ids, len(blocks), _HEADER, blocks_at, ids_at, ids_at + int(at[-1])]
    return b"".join([MAGIC, np.array(head, "<i8").tobytes(), table, at.tobytes(), *blocks])


class TokenFile:
    """Random access to a file, or to anything with seek and read."""

    def __init__(self, source):
        self.source = source
        head = self._bytes(0, _HEADER)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token ids")
        self.__dict__.update(zip(FIELDS, np.frombuffer(head, "<i8", offset=len(MAGIC)).tolist(), strict=True))
        table, n = self._bytes(self.documents_at, 17 * self.documents), self.documents
        null = np.frombuffer(table, np.uint8, n, 8 * n)
        self.doc_ids = [None if z else d for d, z in zip(np.frombuffer(table, "<i8", n).tolist(), null.tolist(), strict=True)]
        self.ends = np.frombuffer(table, "<i8", n, 9 * n)
        self.block_offsets = np.frombuffer(self._bytes(self.blocks_at, 8 * (self.blocks + 1)), "<i8")

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        found = self.source.read(n)
        if len(found) != n:
            raise ValueError("a file of token ids is cut off")
        return found

    def read(self, first: int, stop: int) -> np.ndarray:
        """The ids from first to stop - 1 of the file; only their blocks are read."""
        if not 0 <= first <= stop <= self.ids:
            raise IndexError(f"ids {first} to {stop} of {self.ids}")
        if first == stop:
            return np.zeros(0, np.uint32)
        a, b = first // self.block_ids, (stop - 1) // self.block_ids
        data = self._bytes(self.ids_at + int(self.block_offsets[a]), int(self.block_offsets[b + 1] - self.block_offsets[a]))
        skip = first - a * self.block_ids
        return unpack_bits(data, min(self.ids, (b + 1) * self.block_ids) - a * self.block_ids, self.width)[skip:skip + stop - first]

    def document(self, i: int) -> np.ndarray:
        """The ids of the file's i-th document."""
        return self.read(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))

    def digests(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, start in the file, ids and CRC-32 of every document, from passes of PASS_IDS ids."""
        crc = start = at = 0
        ids, base = np.zeros(0, "<u4"), 0
        for doc, end in zip(self.doc_ids, self.ends.tolist(), strict=True):
            while at < end:
                if at == base + len(ids):
                    base = at
                    ids = self.read(base, min(self.ids, base + PASS_IDS)).astype("<u4")
                stop = min(end, base + len(ids))
                crc = zlib.crc32(ids[at - base:stop - base].tobytes(), crc)
                at = stop
            yield doc, start, end - start, crc
            crc, start = 0, end


# --- Spark ------------------------------------------------------------------------------------

def store(uri: str):
    """The file system and the path of a folder; a worker reaches every place that pyarrow knows."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


FILES = "file long, part int, place int, name string, documents long, ids long"


def write(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES,
          block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes the files below ``folder`` and returns their index: file, part, place, name, documents, ids, first_id."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        encode, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        width, kind = width_of(encode.size), "<u2" if encode.size <= 1 << 16 else "<u4"
        fs, root = store(f"{folder}/data")
        docs, ends, parts, rows, total = [], [], [], [], 0

        def done() -> None:
            file = task.taskAttemptId() << 24 | len(rows)
            name = f"tokens-{task.partitionId():06d}-{len(rows):06d}-{file:x}.bin"
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(to_bytes(file, docs, ends, np.concatenate(parts), width, block_ids))
            rows.append((file, task.partitionId(), len(rows), name, len(docs), total))
        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist()), strict=True):
                ids = np.frombuffer(ids + end, "<u4").astype(kind)
                n = len(ids)
                if docs and 17 * len(docs) + (total + n) * width // 8 > file_bytes:
                    done()
                    docs, ends, parts, total = [], [], [], 0
                total += n
                docs.append(doc)
                ends.append(total)
                parts.append(ids)
        if docs:
            done()
        if rows:
            types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)],
                                             [x.split()[0] for x in FILES.split(", ")])
    fs, root = store(f"{folder}/data")
    fs.create_dir(root)
    rows = common.with_id_kept(docs).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")
    files = common.cut(ordered.mapInArrow(run, FILES))
    # sums of whole parts first: one row per task of the write; then within each part
    parts = files.groupBy("part").agg(F.sum("ids").alias("all"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("all").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("ids").over(before.partitionBy("part").orderBy("place")), F.lit(0))
    index = files.withColumn("inner", inner).join(base, "part") \
        .select(*files.columns, (F.col("base") + F.col("inner")).alias("first_id"))
    index.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files that the index names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                file = TokenFile(io.BytesIO(content.as_buffer()))
                rows = list(file.digests())
                columns = [pa.array([file.file] * len(rows), pa.int64())]
                columns += [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "at", "n_tokens", "ids_crc32"])
    data = spark.read.format("binaryFile").load(f"{folder}/data").select("content")
    index = spark.read.parquet(f"{folder}/index").select("file", "first_id")
    found = data.mapInArrow(run, "file long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(index, "file").select("doc_id", (F.col("first_id") + F.col("at")).alias("start"),
                                            "n_tokens", "ids_crc32")


def op12_bit_packed_ids(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """One row per document, read back from files with the ids of all documents."""
    import public_tokenizers
    common.prepare(spark)
    with Scratch(spark, "token-files") as scratch:
        write(common.read(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"), scratch.folder)
        return common.cut(read(spark, scratch.folder))  # four numbers a document; the files go
