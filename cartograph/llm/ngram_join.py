"""Similarity join on word 5-grams with Bayesian pruning of candidates.

Equal texts are one node. A node has ``HASHES`` MinHash values; nodes with the same values in a
band are a bucket, and buckets with the same members are kept once. In a bucket, pairs compare
their values chunk by chunk; a pair whose posterior probability of a Jaccard similarity of 0.8
or more falls below ``TOLERANCE`` is dropped, and a pair is followed in the first band it shares
only. What is left is verified on the whole 5-gram sets. Large buckets are cut into blocks, and
every two blocks meet in a group of their own; pairs stay inside the tasks, which return links
per node and a spanning forest.

With 32 bands of 4 values a pair of similarity 0.8 shares no band with a probability below 1e-7.

Defined cases: a null text is empty; a text without words has no links; one of 1 to 4 words has
one shingle, all its words; equal texts have the same class and number of links; repeated rows
are all returned; a class's id is its least doc_id (null if it has none); other columns are
ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE = 5
#: Jaccard similarity of a link as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, BAND = 32, 4
HASHES, CHUNK, TOLERANCE = BANDS * BAND, 16, 1e-6
#: Members of a block of a bucket.
BLOCK = 1024

_SEED = np.random.Generator(np.random.PCG64(20240310))
_MUL = _SEED.integers(1, 1 << 63, HASHES, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEED.integers(0, 1 << 63, HASHES, np.int64).astype(np.uint64)


@functools.cache
def least_matches() -> list[int]:
    """Matches that a pair needs after each chunk to stay, for a uniform prior of the similarity.

    After m matches of n the posterior is Beta(m + 1, n - m + 1); its tail from t on is the
    probability of at most m successes in n + 1 trials of probability t.
    """
    t, out = NUMERATOR / DENOMINATOR, []
    for n in range(CHUNK, HASHES + 1, CHUNK):
        tail = m = 0
        while True:
            tail += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if tail >= TOLERANCE:
                break
            m += 1
        out.append(m)
    return out


def minhash(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """MinHash values (rows x HASHES) of shingles; rows must not be empty."""
    out = np.empty((len(off) - 1, HASHES), np.uint32)
    starts = off[:-1]
    for k in range(HASHES):
        h = ((data * _MUL[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, copy (128-bit hash of the text), values and band keys; null values without words."""
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("copy", F.unhex(F.md5("text")))

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            data, off = common.utf8(b.column("text"))
            values: list[bytes | None] = []
            keys: list[np.ndarray | None] = []
            for x, y in common.chunks(off):
                h, woff = common.word_hashes(data[off[x]:off[y]], off[x:y + 1] - off[x], common.SPACE_WORDS)
                s, soff = common.shingle_hashes(h, woff, SHINGLE)
                some = np.flatnonzero(np.diff(soff))
                v: list[bytes | None] = [None] * (y - x)
                k: list[np.ndarray | None] = [None] * (y - x)
                if len(some):
                    sig = minhash(s, np.append(soff[some], soff[-1]))
                    band = np.zeros((len(some), BANDS), np.uint64)
                    for j in range(BAND):
                        band = common.mix(band ^ sig[:, j::BAND].astype(np.uint64)) + np.uint64(j)
                    for at, i in enumerate(some):
                        v[i], k[i] = sig[at].tobytes(), band[at].view(np.int64)
                values += v
                keys += k
            return pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("copy"), pa.array(values, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "copy", "sig", "bands"])
        return step
    return common.map_arrow(df, make, "doc_id long, copy binary, sig binary, bands array<long>")


def nodes(docs: DataFrame) -> DataFrame:
    """One row per distinct text: node, copy, rep (its least doc_id), sig, bands."""
    grouped = signatures(docs).groupBy("copy").agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    return common.cut(grouped.withColumn("node", F.monotonically_increasing_id()))


def buckets(node: DataFrame) -> DataFrame:
    """(band, key, i, j, x, node): members of the pair of blocks i, j of a bucket; x is their block."""
    rows = node.where("bands IS NOT NULL").select("node", F.posexplode("bands").alias("band", "key"))
    members = rows.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min("node").alias("least"),
        F.expr("bit_xor(xxhash64(node))").alias("s"), F.expr("bit_xor(xxhash64(node, 1))").alias("t")).where("n > 1")
    kept = members.groupBy("n", "least", "s", "t").agg(F.min(F.struct("band", "key")).alias("first")) \
        .select("first.band", "first.key", "n")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.join(kept, ["band", "key"]).withColumn("blocks", blocks) \
        .withColumn("x", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda y: F.struct(F.least("x", y).alias("i"), F.greatest("x", y).alias("j")))
    return rows.select("band", "key", "x", "node", F.explode(meets).alias("m")) \
        .select("band", "key", "m.i", "m.j", "x", "node")


GROUP = ["band", "key", "i", "j"]


def by_group(step: Callable[[tuple, dict[str, list]], list[tuple]], names: list[str],
             out: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Calls step(group, columns) for every run of rows with one GROUP; a task holds one group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, rows = None, {c: [] for c in names}, []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), out, strict=True)], schema=out)
        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in GROUP]))
            columns = {c: b.column(c).to_pylist() for c in names}
            at = 0
            for i, key in enumerate([*keys, None]):
                if i and key == keys[i - 1] or not i and key == group:
                    continue
                for c in names:
                    held[c] += columns[c][at:i]
                at = i
                if key is not None:
                    if group is not None:
                        rows += step(group, held)
                    group, held = key, {c: [] for c in names}
            if len(rows) >= 5000:
                yield flush()
                rows = []
        if group is not None:
            rows += step(group, held)
        if rows:
            yield flush()
    return run


def candidates(group: tuple, columns: dict[str, list]) -> list[tuple]:
    """Members with the partners they are to be verified with; a member of a pair may have none."""
    band, _, i, j = group
    node, x = np.array(columns["node"]), np.array(columns["x"])
    order = np.argsort(node)
    node, x = node[order], x[order]
    sig = np.frombuffer(b"".join(columns["sig"]), np.uint32).reshape(-1, HASHES)[order]
    partners: dict[int, list[int]] = {}
    for a in range(len(node) - 1):
        b = np.arange(a + 1, len(node)) if i == j else np.flatnonzero(x[a + 1:] != x[a]) + a + 1
        match = np.zeros(len(b), np.int64)
        for at, least in zip(range(0, HASHES, CHUNK), least_matches(), strict=True):
            match += (sig[b, at:at + CHUNK] == sig[a, at:at + CHUNK]).sum(1)
            alive = match >= least
            if not alive.all():
                b, match = b[alive], match[alive]
            if not len(b):
                break
        if len(b) and band:
            same = (sig[b, :band * BAND] == sig[a, :band * BAND]).reshape(len(b), band, BAND).all(2).any(1)
            b = b[~same]
        if len(b):
            partners.setdefault(a, []).extend(node[b].tolist())
            for c in b.tolist():
                partners.setdefault(c, [])
    return [(*group, int(node[a]), p) for a, p in partners.items()]


def verified(group: tuple, columns: dict[str, list]) -> list[tuple]:
    """(node, links, root): exact links of the members in this group, and their spanning forest."""
    sets = {n: np.frombuffer(s, np.uint64) for n, s in zip(columns["node"], columns["grams"], strict=True)}
    links = dict.fromkeys(sets, 0)
    root = {n: n for n in sets}

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n
    for a, partners in zip(columns["node"], columns["partners"], strict=True):
        x = sets[a]
        for b in partners:
            y = sets[b]
            total = len(x) + len(y)
            if min(len(x), len(y)) * DENOMINATOR < max(len(x), len(y)) * NUMERATOR:
                continue
            both = np.concatenate([x, y])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            if shared * DENOMINATOR >= (total - shared) * NUMERATOR:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return [(n, k, find(n)) for n, k in links.items() if k]


def grams(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, grams): the sorted distinct shingle hashes of the texts of wanted(node, copy, rep)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("rep"), text.alias("text")).withColumn("copy", F.unhex(F.md5("text")))
    rows = rows.join(wanted, (rows["copy"] == wanted["copy"]) & rows["rep"].eqNullSafe(wanted["rep"])) \
        .select("node", "text")

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(s).tobytes() for _, s in common.shingled(b.column("text"), SHINGLE)]
            return pa.RecordBatch.from_arrays([b.column("node"), pa.array(found, pa.binary())], ["node", "grams"])
        return step
    return common.map_arrow(rows, make, "node long, grams binary").dropDuplicates(["node"])


def links(docs: DataFrame, node: DataFrame) -> DataFrame:
    """(node, links, root) per group of the exact links between different texts."""
    ids, names = pa.int64(), [pa.field(c, t) for c, t in zip(GROUP, [pa.int32(), pa.int64(), pa.int32(), pa.int32()],
                                                               strict=True)]
    schema = "band int, key long, i int, j int, node long, partners array<long>"
    found = buckets(node).join(node.select("node", "sig"), "node").repartition(*GROUP).sortWithinPartitions(*GROUP) \
        .mapInArrow(by_group(candidates, ["node", "x", "sig"],
                             pa.schema([*names, pa.field("node", ids), pa.field("partners", pa.list_(ids))])), schema)
    found = common.cut(found)
    wanted = node.join(found.select("node").distinct(), "node", "left_semi").select("node", "copy", "rep")
    full = found.join(grams(docs, wanted), "node").repartition(*GROUP).sortWithinPartitions(*GROUP)
    out = pa.schema([pa.field("node", ids), pa.field("links", ids), pa.field("root", ids)])
    return common.cut(full.mapInArrow(by_group(verified, ["node", "partners", "grams"], out),
                                      "node long, links long, root long"))


def rooted(docs: DataFrame) -> DataFrame:
    """(copy, rep, n_links, root) of every different text; root is the least node of its class."""
    node = nodes(docs)
    found = links(docs, node)
    number = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    root = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))) \
        .select(F.col("a").alias("node"), F.col("b").alias("root"))
    return node.select("node", "copy", "rep").join(number, "node", "left").join(root, "node", "left").select(
        "copy", "rep", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "node").alias("root"))


def join_classes(docs: DataFrame) -> DataFrame:
    """(copy, class_id, n_links): the class and the number of linked other texts of every text."""
    full = rooted(docs)
    least = full.groupBy("root").agg(F.min("rep").alias("class_id"))
    return full.join(least, "root").select("copy", "class_id", "n_links")


def classed(docs: DataFrame) -> DataFrame:
    """The rows of docs with __class_id and __n_links."""
    by = join_classes(docs).toDF("__copy", "__class_id", "__n_links")
    copy = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return docs.withColumn("__copy", copy).join(by, "__copy").drop("__copy")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class's id and the number of different texts it is linked to."""
    common.prepare(spark)
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return classed(docs).select("doc_id", F.col("__class_id").alias("class_id"), F.col("__n_links").alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every class: the one with the least doc_id. The texts are shuffled once."""
    none = F.lit(-(1 << 63))
    best = rooted(docs).groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "copy")).alias("best")) \
        .select(F.coalesce("best.rep", none).alias("__id"), F.col("best.copy").alias("__copy"))
    copy = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    named = common.set_aside(docs, "__id", "__copy")
    rows = named.withColumn("__id", F.coalesce("doc_id", none)).withColumn("__copy", copy)
    return rows.join(best, ["__id", "__copy"], "left_semi").dropDuplicates(["__id", "__copy"]) \
        .select(*named.columns).toDF(*docs.columns)
