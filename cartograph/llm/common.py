"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows and bytes of one Arrow batch; a worker holds a few batches at a time.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
#: Bytes of text that one vectorised pass takes (a longer text is a pass of its own).
CHUNK_BYTES = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder of the session, bounded Arrow batches, and this package's place for the
    Python workers of a local run (on a cluster it comes with --py-files)."""
    ensure_checkpoint_dir(spark)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """mapInArrow with a per-batch function that ``make`` builds once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for b in batches:
            if b.num_rows:
                step = step or make()
                yield step(b)
    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it where df has such a column (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def set_aside(df: DataFrame, *own: str) -> DataFrame:
    """df with the columns that are named like one of `own` renamed; ``toDF`` with df's columns undoes it."""
    names = list(df.columns)
    for i, c in enumerate(names):
        if c.lower() in own:
            new = "_" + c
            while new.lower() in own or new.lower() in {x.lower() for x in names}:
                new = "_" + new
            names[i] = new
    return df.toDF(*names)


def with_id_kept(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and text alone (null text: empty), whatever other columns there are."""
    return df.select(F.col("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a string column without nulls."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()[:3]
    off = np.frombuffer(off, np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one longer row."""
    n, at = len(off) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield at, end
        at = end


#: A byte of a word in `[^\x20\x09-\x0D]+`; all these separators are single bytes in UTF-8.
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[9, 10, 11, 12, 13, 32]] = False

_U = np.uint64
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.int64).astype(_U) | _U(1)
_ODD, _INV = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) <= n:
        for k, base in enumerate((_ODD, _INV)):
            p = np.full(n + 1, base, _U)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=_U)
    return _POW[0], _POW[1]


def word_hashes(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the rows, in order, and the n + 1 word offsets of the rows."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(len(off), np.int64)
    inside = np.take(is_word, data)
    edge = np.empty(n + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    first = off[:-1][off[:-1] < n]
    start = edge[:-1] & inside
    start[first] |= inside[first]
    stop = edge[1:] & inside
    last = off[1:][off[1:] > 0] - 1
    stop[last] |= inside[last]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = _powers(n)
    total = np.empty(n + 1, _U)
    total[0] = 0
    each = np.take(_BYTE, data, mode="clip")  # several times as fast as _BYTE[data]
    each *= up[:n]
    np.cumsum(each, out=total[1:])
    h = mix((np.take(total, e) - np.take(total, s)) * np.take(down, s) + (e - s).astype(_U))
    return h, np.searchsorted(s, off)


def shingle_hashes(h: np.ndarray, woff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of the rows, in order, and their offsets.

    A row of 1 to k - 1 words has one shingle, of all its words; a row without words has none.
    """
    words = np.diff(woff)
    counts = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    soff = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(woff[:-1] - soff[:-1], counts) + np.arange(soff[-1])
    odd = mix(np.arange(1, k + 1, dtype=_U) * _ODD) | _U(1)
    padded = np.concatenate([h, np.zeros(k, _U)])
    size = np.repeat(np.minimum(words, k), counts)
    every = padded[:len(h) + 1] * odd[0]  # k words from each place on, whichever row they are of
    for j in range(1, k):
        every += padded[j:j + len(h) + 1] * odd[j]
    out = np.take(every, at) + size.astype(_U)
    short = np.flatnonzero(size < k)
    if len(short):
        out[short] = size[short]
        for j in range(k):
            out[short] += np.where(size[short] > j, padded[at[short] + j], _U(0)) * odd[j]
    return mix(out), soff


def shingled(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingle hashes in text order of every row."""
    data, off = utf8(column)
    for a, b in chunks(off):
        h, woff = word_hashes(data[off[a]:off[b]], off[a:b + 1] - off[a], SPACE_WORDS)
        s, soff = shingle_hashes(h, woff, k)
        for i, (x, y) in enumerate(pairwise(soff.tolist())):
            yield a + i, s[x:y]
