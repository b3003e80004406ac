"""Source divergence audit: how far the term shares of a source are from those of other sources.

Late string materialisation. Texts are read once; a task counts its terms by a 64-bit digest and
writes a row for each (lang, digest), partly summed, with the term beside it in a column of its own.
The shuffle by (lang, digest) takes the digest and the counts only; the terms that too few documents
hold end there. The strings of the remaining digests alone are then read (a sieve of one bit per
value of the digests' last bits keeps out the others) and reduced to their least and greatest: where
these differ, several terms share the digest, and those digests are counted again by string. Kept
outputs get their strings by a join at the end.

All arithmetic is on whole numbers. For each source, p depends on a term's count alone, so a term
that a source lacks has the source's base value. Part `pair` adds f over all kept terms: rows go by
digest to slots, where a task holds the terms of one batch as a dense block of terms by sources (the
missing ones at their base) and adds f for all pairs of sources into one matrix; languages with many
sources are cut into blocks of ``SOURCES`` that meet in groups of their own. What a task returns is
one sum per pair, not a row per term. Part `term` ranks within salts first, then within the group,
by value with ties; the strings decide among equal values.

Defined cases: null text, lang and source are empty strings; repeated rows count as often as they come;
a group without terms has pairs with the other sources and no terms; an empty table gives an empty
result; a text longer than ``CHUNK`` is counted in parts, cut at separators; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import delete_path
from . import common

LEAST_DOCS, TOP, UNIT = 10, 10, 1_000_000_000
#: Bytes of text counted at once, and distinct (group, digest) rows and strings that a task holds.
CHUNK, HELD = 2 << 20, 400_000
#: Sources of a block, and salts of a group's ranking.
SOURCES, SALTS = 256, 32
#: Digests with several terms up to this number are broadcast for the second count; more are joined by shuffle.
FEW = 100_000
#: 64-bit words of the sieve of kept digests (1 MB at any size of the corpus).
SIEVE = 1 << 17

#: Bytes of a term; every byte of a character beyond ASCII is one, so bytes decide as characters do.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[65:91] = TERM_BYTES[97:123] = TERM_BYTES[128:] = True
_TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CAPITALS = {i: i + 32 for i in range(65, 91)}

#: One row per term of a lang in a part of the texts: documents, and occurrences by source.
COUNTS = "lang string, digest long, docs long, sources array<string>, ns array<long>, term string"
_FIELDS = pa.schema([("lang", pa.string()), ("digest", pa.int64()), ("docs", pa.int64()),
                     ("sources", pa.list_(pa.string())), ("ns", pa.list_(pa.int64())), ("term", pa.string())])


# --- counting terms in a task -----------------------------------------------------------------

def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every term of the rows."""
    inside = np.concatenate([TERM_BYTES[data], [False]])
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    row = off[:-1][off[:-1] < len(data)]
    begin[row] = inside[row]
    s = np.flatnonzero(begin)
    stop = np.flatnonzero(~inside)
    e = stop[np.searchsorted(stop, s)]
    return s, np.minimum(e, off[np.searchsorted(off, s, "right")]) - s


def differing(data: np.ndarray, s: np.ndarray, n: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Numbers of the terms that are not equal, byte for byte, to the term ``first`` gives for them."""
    other = n != n[first]
    same = np.flatnonzero(~other)
    length = n[same]
    ends = np.cumsum(length)
    step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length, length)
    unlike = data[np.repeat(s[same], length) + step] != data[np.repeat(s[first[same]], length) + step]
    if unlike.any():
        other[np.repeat(same, length)[unlike]] = True
    return np.flatnonzero(other)


def summed(key: list[np.ndarray], *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys (of several columns) and the sums of the values."""
    order = np.lexsort(key[::-1])
    key = [k[order] for k in key]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
    at = np.flatnonzero(new)
    return (*[k[at] for k in key], *[np.add.reduceat(v[order], at) if len(at) else v for v in values])


def cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a long text of about CHUNK bytes that cut no term."""
    at = 0
    while at < len(data):
        stop = min(at + CHUNK, len(data))
        if stop < len(data) and TERM_BYTES[data[stop - 1]] and TERM_BYTES[data[stop]]:
            back, ahead = np.flatnonzero(~TERM_BYTES[data[at:stop]]), np.flatnonzero(~TERM_BYTES[data[stop:]])
            stop = at + int(back[-1]) + 1 if len(back) else stop + int(ahead[0]) if len(ahead) else len(data)
        yield at, stop
        at = stop


class Terms:
    """Counts of a task's terms by (group, digest), and their strings."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.groups: dict[tuple[str, str], int] = {}
        self.seen: set[int] = set()
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.waiting, self.many = 0, False
        self.strings: dict[int, bytes] = {}
        self.more: set[tuple[int, bytes]] = set()

    def chunk(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, digest, n) of every row's distinct terms; notes new strings."""
        data = _LOWER[data]
        h, woff = common.word_hashes(data, off, TERM_BYTES)
        h &= self.mask
        if not len(h):
            return np.zeros(0, np.int64), h, np.zeros(0, np.int64)
        s, n = spans(data, off)
        found, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        text = data.tobytes()
        at, end = s[first].tolist(), (s[first] + n[first]).tolist()
        for d, a, b in zip(found.tolist(), at, end, strict=True):
            term = text[a:b]
            if self.strings.setdefault(d, term) != term:
                self.more.add((d, term))
        for i in differing(data, s, n, first[inverse]).tolist():
            self.more.add((int(h[i]), text[s[i]:s[i] + n[i]]))
        row = np.repeat(np.arange(len(off) - 1), np.diff(woff))
        key, count = np.unique(row * len(found) + inverse, return_counts=True)
        return key // len(found), found[key % len(found)], count

    def add(self, data: np.ndarray, off: np.ndarray, group: np.ndarray) -> None:
        """Counts the terms of some rows; a single row may be longer than a chunk."""
        if len(off) == 2 and off[1] > CHUNK:
            parts = [self.chunk(data[x:y], np.array([0, y - x]))[1:] for x, y in cuts(data)]
            digest, n = summed([np.concatenate([p[0] for p in parts])], np.concatenate([p[1] for p in parts]))
            row = np.zeros(len(digest), np.int64)
        else:
            row, digest, n = self.chunk(data, off)
        self.parts.append((group[row], digest, n, np.ones(len(row), np.int64)))
        self.waiting += len(row)
        if self.waiting > 4 * HELD:
            self.parts = [self._summed()]
            self.waiting = len(self.parts[0][0])
            self.many = self.waiting > HELD

    def _summed(self) -> tuple[np.ndarray, ...]:
        g, d, n, docs = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        return summed([g, d], n, docs)

    @property
    def full(self) -> bool:
        return self.many or len(self.strings) + len(self.more) > HELD

    def number(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What is held: a row for each (lang, digest), more terms of a digest, and each new group."""
        names = list(self.groups)
        new = [g for g in range(len(names)) if g not in self.seen]
        self.seen.update(new)
        if new:
            yield batch(len(new), lang=[names[g][0] for g in new], sources=[[names[g][1]] for g in new])
        if self.parts:
            g, d, n, docs = self._summed()
            langs = sorted({lang for lang, _ in names})
            lang = np.array([langs.index(x) for x, _ in names])[g]
            order = np.lexsort((g, d, lang))
            g, d, n, docs, lang = (x[order] for x in (g, d, n, docs, lang))
            at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (lang[1:] != lang[:-1])]) if len(d) else [])
            edge = pa.array(np.append(at, len(d)), pa.int32())
            digest, place = np.unique(d[at], return_inverse=True)
            told = pa.array([self.strings[x] for x in digest.tolist()], pa.binary()).cast(pa.string())
            yield from cut_batch(batch(
                len(at), lang=pa.array(langs, pa.string()).take(pa.array(lang[at])), digest=d[at].view(np.int64),
                docs=np.add.reduceat(docs, at) if len(at) else docs,
                sources=pa.ListArray.from_arrays(edge, pa.array([x for _, x in names], pa.string()).take(pa.array(g))),
                ns=pa.ListArray.from_arrays(edge, pa.array(n)), term=told.take(pa.array(place))))
        if self.more:
            digest, term = zip(*self.more, strict=True)
            yield batch(len(term), digest=np.array(digest, np.uint64).view(np.int64), term=[t.decode() for t in term])
        self.clear()


def batch(rows: int, **columns) -> pa.RecordBatch:
    """Rows of COUNTS; columns that are not given are null."""
    return pa.RecordBatch.from_arrays(
        [pa.nulls(rows, f.type) if (c := columns.get(f.name)) is None else c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for f in _FIELDS], schema=_FIELDS)


def cut_batch(b: pa.RecordBatch, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def counted(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Rows of COUNTS: partly summed counts with their term, more terms of a digest (no lang), and groups (no digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Terms(bits)
        for b in batches:
            data, off = common.utf8(b.column("text"))
            group = np.array([held.number(x, y) for x, y in zip(b.column("lang").to_pylist(),
                                                                b.column("source").to_pylist(), strict=True)], np.int64)
            for x, y in common.chunks(off, CHUNK):
                held.add(data[off[x]:off[y]], off[x:y + 1] - off[x], group[x:y])
                if held.full:
                    yield from held.rows()
        yield from held.rows()
    return plain(docs).mapInArrow(run, COUNTS)


def counted_strings(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Rows of COUNTS with the term beside its digest: counts by string, for digests with several terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << bits) - 1)
        for b in batches:
            found: dict[tuple[str, str], Counter] = {}
            docs = Counter()
            for lang, source, text in zip(*[b.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
                for t, n in Counter(_TERM.findall(text.translate(_CAPITALS))).items():
                    found.setdefault((lang, t), Counter())[source] += n
                    docs[lang, t] += 1
            if found:
                lang, term = zip(*found, strict=True)
                data, off = common.utf8(pa.array(term, pa.string()))
                h = common.word_hashes(data, off, TERM_BYTES)[0] & mask
                yield from cut_batch(batch(
                    len(term), lang=lang, digest=h.view(np.int64), docs=[docs[k] for k in found],
                    sources=[list(c) for c in found.values()], ns=[list(c.values()) for c in found.values()], term=term))
    return plain(docs).mapInArrow(run, COUNTS)


# --- kept terms and groups --------------------------------------------------------------------

_TERM_KEY = ["lang", "digest", "tie"]


def kept_terms(counts: DataFrame) -> DataFrame:
    """lang, source, digest, tie, n, lang_n, one of the terms in LEAST_DOCS documents of the lang.

    One shuffle by (lang, digest); ``one`` is 1 on one row of each term of a lang.
    """
    term = Window.partitionBy(*_TERM_KEY)
    one = F.row_number().over(term.orderBy("source")) == 1
    held = counts.repartition("lang", "digest").withColumn("docs", F.sum("docs").over(term)).where(F.col("docs") >= LEAST_DOCS)
    each = held.select(*_TERM_KEY, F.inline(F.arrays_zip("sources", "ns")).alias("source", "n"))
    return each.groupBy(*_TERM_KEY, "source").agg(F.sum("n").alias("n")) \
        .select("*", F.sum("n").over(term).alias("lang_n"), one.cast("long").alias("one"))


def sieve(digests: DataFrame) -> DataFrame:
    """One row ``sieve``: a bit for each of the 64 * SIEVE values of the digests' last bits that occurs."""
    spark = digests.sparkSession
    bits = np.zeros(SIEVE, np.int64)
    word = F.pmod(F.shiftright("digest", 6), F.lit(SIEVE)).cast("int")
    set_ = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("digest").bitwiseAND(63).cast("int"))
    for r in digests.select(word.alias("word"), set_.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        bits[r.word] = r.bits  # at most SIEVE rows
    return spark.createDataFrame([(bits.tolist(),)], "sieve array<long>")


def in_sieve(digest: str) -> Column:
    word = F.get("sieve", F.pmod(F.shiftright(digest, 6), F.lit(SIEVE)).cast("int"))
    return F.getbit(word, F.col(digest).bitwiseAND(63).cast("int")) == 1


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT (count + 2) / (total + 2 terms)), exactly; 1 where there are no terms."""
    over = total.cast("decimal(20,0)") + 2 * terms.cast("decimal(20,0)")
    product = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.when(over > 0, 1 + F.call_function("div", product, over)).otherwise(F.lit(1).cast("long"))


def groups(all_groups: DataFrame, kept: DataFrame, width: int) -> DataFrame:
    """Every occurring group: lang, source, place (of the source in its lang), total, terms, lang_total, base,
    and the blocks of its lang's sources."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("one").alias("ones"))
    lang = Window.partitionBy("lang")
    return all_groups.join(own, ["lang", "source"], "left") \
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("ones", F.lit(0)).alias("ones")) \
        .select("lang", "source", "total", (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
                F.sum("ones").over(lang).alias("terms"), F.sum("total").over(lang).alias("lang_total"),
                F.ceil(F.count("*").over(lang) / width).cast("int").alias("blocks")) \
        .withColumn("base", share(F.lit(0), F.col("total"), F.col("terms")))


def separated(docs: DataFrame, counts: DataFrame, strings: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Kept terms, each with a key of its own, and the strings (digest, least) of their digests."""
    kept = common.cut(kept_terms(counts))
    digests = kept.where("one = 1").select("digest").distinct()
    # most strings belong to rare terms; the sieve keeps them out of the join's shuffle
    likely = strings.crossJoin(F.broadcast(sieve(digests))).where(in_sieve("digest")).drop("sieve")
    names = likely.join(digests, "digest", "left_semi") \
        .groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("greatest"))
    names = common.cut(names)
    several = names.where(F.col("least") != F.col("greatest")).select("digest")
    n = several.count()
    if n:
        several = F.broadcast(several) if n <= FEW else several
        again = counted_strings(docs, bits).join(several, "digest", "left_semi").withColumnRenamed("term", "tie")
        rest = counts.join(several, "digest", "left_anti")
        kept = common.cut(kept_terms(rest.unionByName(again)))
    return kept, names.select("digest", "least")


# --- the two parts ----------------------------------------------------------------------------

PAIRS = "lang string, x int, y int, value long, seen long"


def pair_sums(kept: DataFrame, group: DataFrame, slots: int, width: int = SOURCES) -> DataFrame:
    """lang, x, y, value, seen: sums of f for places x < y of a lang's sources, over the ``seen`` kept terms
    that a source of their blocks has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, left = None, None  # the group of the rows at hand; rows of a term that may go on
        base: dict[int, int] = {}
        total, seen = np.zeros((0, 0), np.int64), 0

        def add(place: np.ndarray, term: np.ndarray, p: np.ndarray) -> None:
            nonlocal seen
            seen += int(term[-1]) + 1
            own = np.array(sorted(base), np.int64)
            block = np.tile(np.array([base[i] for i in own.tolist()], np.int64), (int(term[-1]) + 1, 1))
            block[term, np.searchsorted(own, place)] = p
            a, b = key[1], key[2]
            for i, x in enumerate(own.tolist()):
                if x // width != a:
                    break
                others = slice(i + 1, None) if a == b else slice(int(np.searchsorted(own, b * width)), None)
                one, rest = block[:, i:i + 1], block[:, others]
                total[i, others] += ((one - rest) ** 2 // (one + rest)).sum(axis=0)

        def done() -> Iterator[pa.RecordBatch]:
            if key is None:
                return
            own = np.array(sorted(base), np.int64)
            x, y = np.triu_indices(len(own), 1)
            if key[1] != key[2]:
                across = (own[x] // width == key[1]) & (own[y] // width == key[2])
                x, y = x[across], y[across]
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * len(x)), pa.array(own[x], pa.int32()), pa.array(own[y], pa.int32()),
                     pa.array(total[x, y]), pa.array([seen] * len(x), pa.int64())], ["lang", "x", "y", "value", "seen"])

        for batch in batches:
            if left is not None:
                batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
                left = None
            n = batch.num_rows
            if not n:
                continue
            lang = batch.column("lang").dictionary_encode()
            ids = [lang.indices.to_numpy(), *[batch.column(c).to_numpy() for c in ("a", "b")]]
            place, p = batch.column("place").to_numpy(), batch.column("p").to_numpy()
            head = batch.column("digest").is_null().to_numpy(zero_copy_only=False)
            digest = batch.column("digest").fill_null(0).to_numpy()
            tie = batch.column("tie").fill_null("").dictionary_encode().indices.to_numpy()
            new_group = np.ones(n, bool)
            new_group[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in ids])
            new_term = new_group | head
            new_term[1:] |= (digest[1:] != digest[:-1]) | (tie[1:] != tie[:-1])
            new_term[1:] |= head[:-1]
            edge = [*np.flatnonzero(new_group).tolist(), n]
            for s, e in zip(edge, edge[1:], strict=False):
                told = (lang.dictionary[int(ids[0][s])].as_py(), int(ids[1][s]), int(ids[2][s]))
                if told != key:
                    yield from done()
                    key, base, seen = told, {}, 0
                bases = np.flatnonzero(head[s:e])
                if len(bases):
                    base |= zip(place[s:e][bases].tolist(), p[s:e][bases].tolist(), strict=True)
                    total = np.zeros((len(base), len(base)), np.int64)
                at = s + len(bases)  # the bases come first
                if e == n and at < e:  # the last term may go on in the next batch
                    last = int(np.flatnonzero(new_term)[-1])
                    left = batch.slice(last)
                    e = max(at, last)
                if at < e:
                    add(place[at:e], np.cumsum(new_term[at:e]) - 1, p[at:e])
        if left is not None:
            add(left.column("place").to_numpy(), np.zeros(left.num_rows, np.int64), left.column("p").to_numpy())
        yield from done()

    block = F.floor(F.col("place") / width).cast("int")
    meets = F.explode(F.concat(
        F.transform(F.sequence(block, F.col("blocks") - 1), lambda b: F.struct(block.alias("a"), b.alias("b"))),
        F.transform(F.filter(F.sequence(F.lit(0), block), lambda a: a < block),
                    lambda a: F.struct(a.alias("a"), block.alias("b")))))
    columns = ["slot", "lang", "m.a", "m.b", "digest", "tie", F.col("place").cast("int").alias("place"), "p"]
    terms = kept.withColumn("slot", F.pmod(F.xxhash64("digest", "tie"), F.lit(slots)).cast("int")) \
        .withColumn("m", meets).select(*columns)
    heads = group.withColumn("m", meets).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))) \
        .withColumn("digest", F.lit(None).cast("long")).withColumn("tie", F.lit(None).cast("string")) \
        .withColumn("p", F.col("base")).select(*columns)
    rows = terms.unionByName(heads).repartition("slot") \
        .sortWithinPartitions("lang", "a", "b", F.col("digest").asc_nulls_first(), "tie", "place").drop("slot")
    # a slot's bases repeat where a task has several slots
    return rows.mapInArrow(run, PAIRS).groupBy("lang", "x", "y") \
        .agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def audit(docs: DataFrame, bits: int = 64, width: int = SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank of every group of docs."""
    spark = docs.sparkSession
    folder = common.scratch(spark, "term-counts")
    counted(docs, bits).write.option("compression", "zstd").parquet(folder)
    table = spark.read.schema(COUNTS).parquet(folder)
    strings = table.where(F.col("term").isNotNull()).select("digest", "term")
    counts = table.where(F.col("lang").isNotNull() & F.col("digest").isNotNull()) \
        .select("lang", "digest", "docs", "sources", "ns", F.lit(None).cast("string").alias("tie"))
    kept, names = separated(docs, counts, strings, bits)
    every = table.where(F.col("lang").isNotNull() & F.col("digest").isNull()).select("lang", F.col("sources")[0].alias("source")).distinct()
    group = common.cut(groups(every, kept, width))
    # a group's totals meet its rows by salt, so that a hot source is not one key of the join
    salt = F.pmod("digest", F.lit(SALTS)).cast("int")
    salted = group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    full = kept.withColumn("salt", salt).join(salted, ["lang", "source", "salt"]) \
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("terms"))) \
        .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
    full = common.cut(full.select("lang", "source", "salt", "digest", "tie", "place", "blocks", "p", "q"))
    delete_path(spark, folder)  # what follows reads the checkpoints

    f = F.expr("(p - q) * (p - q) DIV (p + q)")
    by_value = F.col("value").desc()
    terms = full.where("p > q").select("lang", "source", "salt", "digest", "tie", f.alias("value"))
    for keys in (["lang", "source", "salt"], ["lang", "source"]):
        terms = terms.withColumn("r", F.rank().over(Window.partitionBy(*keys).orderBy(by_value))).where(F.col("r") <= TOP)
    order = Window.partitionBy("lang", "source").orderBy(by_value, "item")
    terms = terms.join(names, "digest").withColumn("item", F.coalesce("tie", "least")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)

    slots = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = pair_sums(full.select("lang", "digest", "tie", "place", "blocks", "p"), group, slots, width)
    both = sums.select("lang", F.inline(F.array(
        F.struct(F.col("x").alias("one"), F.col("y").alias("other"), "value", "seen"),
        F.struct(F.col("y").alias("one"), F.col("x").alias("other"), "value", "seen"))))
    one = group.select("lang", F.col("place").alias("one"), "source", F.col("base").alias("p"))
    other = group.select("lang", F.col("place").alias("other"), F.col("source").alias("item"), F.col("base").alias("q"), "terms")
    # the terms that neither block has are at the base of both sources
    pairs = both.join(one, ["lang", "one"]).join(other, ["lang", "other"]) \
        .withColumn("value", F.col("value") + (F.col("terms") - F.col("seen")) * f) \
        .withColumn("rank", F.row_number().over(order))

    def out(df: DataFrame, part: str) -> DataFrame:
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return out(pairs, "pair").unionByName(out(terms, "term"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every (lang, source) group of all documents from its lang's other sources, and its terms."""
    common.prepare(spark)
    return audit(common.read(spark, sf_dir, "documents"))
