"""Packing of token pieces into sequences by a linear grouping scheme.

Lengths are whole numbers up to the sequence length, so a histogram of at most that many counts
describes the whole corpus; the plan is made from it alone:

1. the large lengths, in descending order, form groups of equal cardinality, and every length of
   a group is rounded up to the group's largest;
2. for these few sizes, the configurations of a sequence and their numbers are optimised (linear
   program by column generation, with a knapsack for the pricing);
3. the groups' actual pieces are substituted, which leaves a little more room;
4. what is left of the large ones, and all small ones, go where they fit best.

The plan is a list of runs: `n` pieces of one length, from a rank on, go to `n` consecutive
sequences at one offset. Its size depends on the sequence length, not on the corpus. Ranks among
equal lengths are counted per block of rows and summed over blocks, so that a length that a third
of all pieces have needs no task of its own.

Defined cases: a null or empty text is one token, the separator; copies and repeated rows are
packed one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .word_ids import word_ids

SEQUENCE, SEPARATOR = 2048, 0
PRICINGS = 400
#: Groups of large pieces, and the part of a sequence up to which pieces are small. A plan is made
#: for each pair, and the one with the fewest sequences is taken.
VARIANTS = [(160, 2), (160, 3), (160, 4), (40, 8)]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, within long"


def pieces(docs: DataFrame, path: str, capacity: int = SEQUENCE) -> DataFrame:
    """The documents' pieces, with their rank among equal lengths of the same block of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block = word_ids(path), TaskContext.get().partitionId() << 32
        end = np.array([SEPARATOR], "<u4").tobytes()
        for b in batches:
            rows, seen = [], {}
            texts = b.column("text").to_pylist()
            for doc, ids in zip(b.column("doc_id").to_pylist(), encode(texts), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(part), block, seen.get(n, 0)))
                    seen[n] = seen.get(n, 0) + 1
            block += 1
            if rows:
                types = [pa.int64(), pa.int32()] + [pa.int64()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)],
                                                 [x.split()[0] for x in PIECES.split(", ")])
    return common.with_id_kept(docs).mapInArrow(run, PIECES)


# --- the plan ---------------------------------------------------------------------------------

def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """(rounded size, [[length, first rank, pieces], ...]) of groups of equal cardinality.

    Groups that round to the same size are one.
    """
    total = sum(counts.values())
    share, room, out = max(1, -(-total // groups)), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not room:
                room = share
                if not out or out[-1][0] != length:
                    out.append((length, []))
            n = min(room, left)
            out[-1][1].append([length, rank, n])
            rank, left, room = rank + n, left - n, room - n
    return out


def best_configuration(sizes: list[int], worth: np.ndarray, capacity: int) -> np.ndarray:
    """Numbers of each size that fit the capacity and are worth most."""
    value, steps = np.zeros(capacity + 1), []
    for i, size in enumerate(sizes):
        for _ in range(capacity // size):
            more = value[:-size] + worth[i]
            better = more > value[size:] + 1e-12
            if not better.any():
                break
            value[size:][better] = more[better]
            steps.append((i, better))
    out, at = np.zeros(len(sizes)), capacity
    for i, better in reversed(steps):
        if at >= sizes[i] and better[at - sizes[i]]:
            out[i] += 1
            at -= sizes[i]
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, np.ndarray]]:
    """(sequences, numbers of each size) of a basic solution of the configuration program, rounded down."""
    m, b = len(sizes), np.array(demand, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(PRICINGS):
        worth = np.linalg.solve(basis.T, np.ones(m))
        column = best_configuration(sizes, worth, capacity)
        if worth @ column <= 1 + 1e-7:
            break
        x, d = np.linalg.solve(basis, b), np.linalg.solve(basis, column)
        ratio = np.where(d > 1e-9, np.maximum(x, 0) / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    x = np.linalg.solve(basis, b)
    out, left = [], b.copy()
    for j in np.argsort(-x):
        use = basis[:, j] > 0
        n = int(min(np.floor(x[j] + 1e-9), np.min(left[use] // basis[use, j])))
        if n > 0:
            left -= n * basis[:, j]
            out.append((n, basis[:, j].astype(int)))
    return out


def take(stream: list[list[int]], n: int) -> list[tuple[int, int, int]]:
    """The next n pieces of a group as (length, first rank, pieces)."""
    out = []
    while n:
        length, rank, there = stream[0]
        used = min(n, there)
        out.append((length, rank, used))
        stream[0] = [length, rank + used, there - used]
        if used == there:
            stream.pop(0)
        n -= used
    return out


def plan(counts: dict[int, int], capacity: int = SEQUENCE) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, pieces, first sequence, offset) and the number of sequences."""
    return min((plan_for(counts, capacity, *v) for v in VARIANTS), key=lambda p: p[1])


def plan_for(counts: dict[int, int], capacity: int, groups: int, small: int) -> tuple[np.ndarray, int]:
    """A plan with that many groups of the pieces longer than the capacity divided by small."""
    runs: list[tuple[int, int, int, int, int]] = []
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free tokens: (sequence, number)
    free: list[int] = []  # the amounts of free tokens that some sequence has, in order
    sequences = 0

    def leave(amount: int, first: int, n: int) -> None:
        if amount and n:
            if not room[amount]:
                insort(free, amount)
            room[amount].append((first, n))

    large = {k: n for k, n in counts.items() if k > capacity // small and n}
    rest = {k: [[k, 0, n]] for k, n in counts.items() if k <= capacity // small and n}
    if large:
        rounded = grouped(large, groups)
        sizes, streams = [s for s, _ in rounded], [list(map(list, g)) for _, g in rounded]
        demand = [sum(n for *_, n in g) for g in streams]
        for n, numbers in configurations(sizes, demand, capacity):
            slots = [take(streams[i], n) for i in range(len(sizes)) for _ in range(numbers[i])]
            cuts = sorted({0}.union(*[np.cumsum([c for *_, c in s]).tolist() for s in slots]))
            at = [[0, 0] for _ in slots]  # segment of each slot, and pieces used of it
            for a, b in zip(cuts, cuts[1:], strict=False):
                offset = 0
                for s, p in zip(slots, at, strict=True):
                    length, rank, there = s[p[0]]
                    runs.append((length, rank + p[1], b - a, sequences + a, offset))
                    offset += length
                    p[1] += b - a
                    if p[1] == there:
                        p[:] = [p[0] + 1, 0]
                leave(capacity - offset, sequences + a, b - a)
            sequences += n
        for s in streams:
            for length, rank, n in s:
                rest.setdefault(length, []).append([length, rank, n])
    for length in sorted(rest, reverse=True):
        for _, rank, left in rest[length]:
            while left:
                k = bisect_left(free, length)
                if k == len(free):  # nothing fits: new sequences of this length alone
                    each = capacity // length
                    n = max(1, left // each)
                    for j in range(min(each, left)):
                        runs.append((length, rank, n, sequences, j * length))
                        rank, left = rank + n, left - n
                    leave(capacity - min(each, j + 1) * length, sequences, n)
                    sequences += n
                    continue
                amount = free[k]
                first, there = room[amount].pop()
                if not room[amount]:
                    free.pop(k)
                n = min(left, there)
                runs.append((length, rank, n, first, capacity - amount))
                rank, left = rank + n, left - n
                leave(amount - length, first, n)
                leave(amount, first + n, there - n)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), sequences


def pack(docs: DataFrame, path: str, capacity: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs."""
    cut = common.cut(pieces(docs, path, capacity))
    blocks = common.cut(cut.groupBy("block", "length").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(counts, capacity)  # at most `capacity` counts
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["block", "length"]) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("within")).alias("rank"))

    def make():
        key = runs[:, 0] << 48 | runs[:, 1]

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            rank = b.column("rank").to_numpy()
            at = np.searchsorted(key, b.column("length").to_numpy() << 48 | rank, "right") - 1
            sequence = runs[at, 3] + rank - runs[at, 1]
            return pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(runs[at, 4])],
                                              [*b.schema.names[:5], "sequence_id", "offset"])
        return step
    return common.map_arrow(ranked, make, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                          "sequence_id long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """One row per piece of all documents, packed into sequences of at most 2048 tokens."""
    import public_tokenizers
    common.prepare(spark)
    return pack(common.read(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))
