"""Benchmark decontamination with one Aho-Corasick automaton.

Test questions and answers are normalised to lower-case words; every window of ten consecutive
words of an item (the whole item when it is shorter) is a pattern of the automaton. A document
is normalised the same way and scanned once; the words inside any match are hit, and their
offsets in the original text are given.

The benchmark is the stated query set. Its items are cut into pieces that overlap by nine words, and
the pieces are dealt into blocks of at most ``BLOCK_CHARS`` pattern characters by running sums; both are
written to the shared folder, so the driver and a worker hold one block at any benchmark size. A
benchmark of one block is scanned for in one pass. A larger one takes a pass for a block, one after
another: a pass writes the matches alone, and the texts meet the matches of all passes at the end.

Defined cases: a null text has no words and no hits; an item without words has no window; a null
item_id is left out; a window of several items counts for each; items with equal item_id count
once; repeated rows are all returned; other columns are ignored.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WINDOW = 10
#: Pattern characters of one automaton: about 40 bytes of memory each.
BLOCK_CHARS = 4 << 20
#: Blocks whose pieces are put in order by one task, about.
PART_BLOCKS = 16

_WORD = bytes([c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
               for c in range(256)])
_ORIGINAL = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
HITS = "struct<words:array<struct<start:int,end:int>>,chars:array<struct<start:int,end:int>>,items:array<string>>"
_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def normal_words(text: str | None) -> list[bytes]:
    """Lower-case words as UTF-8; the characters outside words are all single bytes."""
    return text.encode().translate(_WORD).split() if text else []


def windows(words: list[bytes]) -> set[bytes]:
    """Patterns of an item, with a space on either side."""
    last = max(1, len(words) - WINDOW + 1)
    return {b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(last)} if words else set()


@functools.lru_cache(maxsize=1)
def automaton(items: tuple[tuple[str, str], ...]):
    """Automaton over the windows of (item_id, text) pairs; a worker keeps the last one.

    Bytes are taken as Latin-1 characters, so positions count bytes of the normalised text.
    """
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(normal_words(text)):
            owners.setdefault(w, set()).add(item)
    found = ahocorasick.Automaton()
    for w, own in owners.items():
        found.add_word(w.decode("latin-1"), (w.count(b" ") - 1, tuple(own)))
    if owners:
        found.make_automaton()
    return found if owners else None


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges as disjoint ones in order; touching ranges become one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def matches(words: list[bytes], found) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges inside occurrences of windows, and the items they belong to."""
    ranges, items, gaps = [], set(), None
    if words and found is not None:
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        for end, (n, own) in found.iter(line):
            if gaps is None:
                gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            stop = int(np.searchsorted(gaps, end))
            ranges.append((stop - n, stop))
            items.update(own)
    return merged(ranges), items


def _scan(items: tuple[tuple[str, str], ...]):
    def make():
        found = automaton(items)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            n_words, out = [], []
            for text, before in zip(b.column("__text").to_pylist(), b.column("__hits").to_pylist(), strict=True):
                words = normal_words(text)
                ranges, own = matches(words, found)
                if before:
                    ranges = merged(ranges + [(r["start"], r["end"]) for r in before["words"]])
                    own |= set(before["items"])
                chars = []
                if ranges:
                    at = [m.span() for m in _ORIGINAL.finditer(text)]
                    chars = [(at[s][0], at[e - 1][1]) for s, e in ranges]
                n_words.append(len(words))
                out.append({"words": [{"start": s, "end": e} for s, e in ranges],
                            "chars": [{"start": s, "end": e} for s, e in chars], "items": sorted(own)})
            hits = pa.struct([("words", _RANGES), ("chars", _RANGES), ("items", pa.list_(pa.string()))])
            b = b.set_column(b.schema.get_field_index("__hits"), "__hits", pa.array(out, hits))
            return b.set_column(b.schema.get_field_index("__n_words"), "__n_words", pa.array(n_words, pa.int64()))
        return step
    return make


def pieces(words: list[bytes], most: int) -> list[tuple[str, int]]:
    """An item's words in pieces whose windows are the item's windows, and each piece's pattern
    characters: at most ``most``, or one window."""
    out: list[tuple[str, int]] = []
    first = cost = 0
    last = max(1, len(words) - WINDOW + 1) if words else 0
    width = sum(map(len, words[:WINDOW])) + min(WINDOW, len(words)) + 1
    for i in range(last):
        if i > first and cost + width > most:
            out.append((b" ".join(words[first:i + WINDOW - 1]).decode(), cost))
            first, cost = i, 0
        cost += width
        if i + WINDOW < len(words):
            width += len(words[i + WINDOW]) - len(words[i])
    if last:
        out.append((b" ".join(words[first:]).decode(), cost))
    return out


def _cut_items(most: int):
    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = [(item, piece, cost) for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                    for piece, cost in pieces(normal_words(text), most)]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            types = pa.string(), pa.string(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                              ["item", "piece", "cost"])
        return step
    return make


def blocks(benchmark: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Pieces of the items (item, piece, cost, part, block) and the (part, block) there are.

    A part is a hash class of about PART_BLOCKS blocks of pieces; its pieces are put in order and the running
    sum of their costs gives the block, so no block has more than BLOCK_CHARS and a piece.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL") \
        .select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    most = max(1, BLOCK_CHARS // 8)
    cut = common.cut(common.map_arrow(items, _cut_items(most), "item string, piece string, cost long").distinct())
    total = cut.agg(F.sum("cost")).first()[0] or 0
    if total <= BLOCK_CHARS:
        return cut.select("*", F.lit(0).alias("part"), F.lit(0).cast("long").alias("block")), [(0, 0)]
    part = F.pmod(F.xxhash64("item", "piece"), F.lit(-(-total // (PART_BLOCKS * BLOCK_CHARS)))).cast("int")
    ahead = Window.partitionBy("part").orderBy("item", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("cost").over(ahead), F.lit(0))
    dealt = common.cut(cut.withColumn("part", part).withColumn("block", F.floor(before / F.lit(BLOCK_CHARS))))
    return dealt, [tuple(r) for r in dealt.select("part", "block").distinct().orderBy("part", "block").collect()]


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs with __n_words and __hits (word ranges, code point ranges, item ids).

    Runs jobs over the benchmark, and with more than one block over docs, while it builds the plan.
    """
    rows = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))) \
        .withColumn("__n_words", F.lit(0).cast("long"))
    dealt, numbers = blocks(benchmark)

    def through(df: DataFrame, number: tuple[int, int] | None) -> DataFrame:
        items = () if number is None else tuple(
            (r["item"], r["piece"]) for r in dealt.where(F.col("part") == number[0])
            .where(F.col("block") == number[1]).select("item", "piece").orderBy("item", "piece").collect())  # one block
        return common.map_arrow(df, _scan(items), df.schema)

    if len(numbers) == 1:
        return through(rows.withColumn("__hits", F.lit(None).cast(HITS)), numbers[0]).drop("__text")
    # A pass reads the texts alone and writes the rows with matches; the row number is a written one.
    rows = common.cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    texts = rows.select("__row", "__text", "__n_words").withColumn("__hits", F.lit(None).cast(HITS))
    passes = [common.cut(through(texts, n).where(F.size("__hits.words") > 0)
                         .select("__row", F.col("__hits.words").alias("w"), F.col("__hits.items").alias("i")))
              for n in numbers]
    found = functools.reduce(DataFrame.unionAll, passes).groupBy("__row").agg(F.struct(
        F.flatten(F.collect_list("w")).alias("words"), F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("chars"),
        F.array_distinct(F.flatten(F.collect_list("i"))).alias("items")).alias("__hits"))
    met = rows.join(found, "__row", "left").select(*rows.columns, F.col("__hits").cast(HITS).alias("__hits"))
    return through(met, None).drop("__text", "__row")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: words, hit words, items and their digest."""
    common.prepare(spark)
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, common.read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("__hits.words", F.lit(0).cast("long"), lambda a, r: a + (r["end"] - r["start"]))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("__hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__hits.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a window of the benchmark."""
    rows = common.set_aside(docs, "__text", "__n_words", "__hits", "__row")
    return scan(rows, benchmark).where(F.size("__hits.words") == 0).select(*rows.columns).toDF(*docs.columns)
