"""Near-duplicate passages by compact windows.

The sequence of a text's 5-word shingles has, for every hash function, a Cartesian tree of the
shingles' hash values. A node c whose subtree is the range l..r is the minimum of every
subsequence that lies in l..r and holds c: one compact window (l, c, r) stands for all of them.
Only nodes with subtrees of at least 50 words are made. Texts that share a window's value share
a MinHash of those subsequences. All windows are dealt by value; the members of a value are
linked to one of them and to their neighbours, first within a batch of rows, then over all batches, so that a passage
that a third of all texts have leaves one row per batch. The windows that a pair of texts shares
are joined by overlapping intervals, and where those of enough hash functions overlap, the longest
ranges whose whole shingle sets are similar enough are the passages.

The first member of a value and the neighbour may be strangers that have only the one shingle of
it. So where a value has more members than these links join in all pairs, the members are also
dealt by single shingles so near to it that a passage can hold both (of each four neighbours the one of
least hash), and by runs of 45 words there. Texts that share a passage around a common sentence
share shingles that the sentence does not have, most often with nobody else; two of these on one
line are a candidate, and any eight neighbours hold two. Members of a run
repeat a passage by the run alone. Of the runs in each 50 words the one of least hash is taken, which is
the same one in all texts that repeat the 50 words.

A passage has at least 50 words and a Jaccard similarity of 0.8 or more to its match. One that
is repeated word by word shares the values of all hash functions.

Defined cases: a null text is empty; texts of under 50 words have no passages; copies are
passages of their whole length; rows that repeat a doc_id with the same text are one text;
passages repeated only inside one text are not reported; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHINGLE, PASSAGE = 5, 50
#: Shingles of the shortest passage.
LEAST = PASSAGE - SHINGLE + 1
NUMERATOR, DENOMINATOR = 4, 5
#: Shingles from the first to the last match of the shortest passage.
CORE = -(-LEAST * NUMERATOR // DENOMINATOR)
FUNCTIONS, ENOUGH = 7, 2
#: Shingles of a run that makes a passage of whatever is around it (41 of at most 51 shingles).
GRAM = -(-2 * LEAST * NUMERATOR // (NUMERATOR + DENOMINATOR))
#: The numbers that blocks, single shingles and lines of these have in the place of a function's, and
#: the bit of a crowded window.
BLOCK, SINGLE, LINE, CROWDED = 8, 9, 10, 16
#: One of so many neighbouring single shingles, that of least hash, is dealt.
SPARSE = 4
#: Rows of blocks and shingles that are reduced together.
PLACED_ROWS = 1 << 20

_U = np.uint64
_SEED = np.random.Generator(np.random.PCG64(20240417))
_MUL = _SEED.integers(1, 1 << 63, FUNCTIONS, np.int64).astype(_U) * _U(2) + _U(1)


def compact_windows(values: np.ndarray, off: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(row, l, c, r) of the Cartesian tree nodes with subtrees of at least `least` values, per row.

    A node has such a subtree exactly if it is the (leftmost) minimum of some `least` neighbouring
    values; these minima are found for all rows together, and as all ancestors of a node are among
    them, a subtree ends before the next smaller one of them on either side.
    """
    n = len(values)
    if n < least:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    packed = (values >> _U(32) << _U(32)) | np.arange(n, dtype=_U)
    low, width = packed, 1
    while 2 * width <= least:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < least:
        low = np.minimum(low[:len(low) - (least - width)], low[least - width:])
    at = (low & _U(0xFFFFFFFF)).astype(np.int64)  # the minimum of the values from each place on
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    at = at[row[:len(at)] == row[least - 1:]]
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at = at[np.r_[True, at[1:] != at[:-1]]]  # they are in order
    rows = row[at]
    left, right = _smaller(packed[at], rows, -1), _smaller(packed[at], rows, 1)
    base, place = off[rows], np.r_[at, -1]
    return (rows, np.where(left < 0, 0, place[left] + 1 - base), at - base,
            np.where(right < 0, off[rows + 1] - 1, place[right] - 1) - base)


def _smaller(value: np.ndarray, row: np.ndarray, step: int) -> np.ndarray:
    """The next place before (step -1) or after (1) each value with a smaller one in its row, or -1.

    All between a place and where it points are greater; it goes on from a greater one to where that
    points, which doubles the way.
    """
    n = len(value)
    value = np.r_[value, _U(0)]
    to = np.arange(n + 1) + step
    to[n] = -1
    row = np.r_[row, -1]
    to[:n][row[to[:n]] != row[:n]] = -1
    on = np.arange(n)
    while len(on):
        on = on[value[to[on]] > value[on]]  # at -1 the value is 0
        to[on] = to[to[on]]
    return to[:n]


ANCHOR = 7  # function, then c, l, r of the text and of its match
#: The windows of a batch for one part of the values, or (with nid) a link and its anchors.
PLACED = "part int, nid long, hub long, data binary"


def _packed(key: np.ndarray, nid: np.ndarray, where: np.ndarray) -> bytes:
    """Windows in one value, column by column; f, c, l and r by bytes of equal weight, for the shuffle's
    compression."""
    places = np.ascontiguousarray(where.T, "<i4").view(np.uint8).reshape(4, len(key), 4)
    return key.tobytes() + nid.tobytes() + places.transpose(0, 2, 1).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 32
    places = np.frombuffer(data, np.uint8, offset=16 * n).reshape(4, 4, n).transpose(0, 2, 1)
    return (np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int64, n, 8 * n),
            np.ascontiguousarray(places).view("<i4").reshape(4, n).T.astype(np.int64))


def _parts(df: DataFrame) -> int:
    """Parts that window values are dealt in."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _edges(nid: np.ndarray, hub: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """One (nid, hub, anchors) per pair."""
    if not len(nid):
        return
    order = np.lexsort((anchors[:, 1], anchors[:, 1] - anchors[:, 4], anchors[:, 0], hub, nid))
    nid, hub, anchors = nid[order], hub[order], anchors[order].astype("<i4")
    # blocks one after another on a line are one, and single shingles with nothing else in between
    f, step = anchors[1:, 0], np.diff(anchors, axis=0)
    follows = (f >= BLOCK) & (nid[1:] == nid[:-1]) & (hub[1:] == hub[:-1]) & (step[:, 0] == 0) \
        & (step[:, 1] > 0) & (step[:, 1] == step[:, 4]) & (step[:, 1] < np.where(f == BLOCK, LEAST - GRAM + 2, LEAST))
    head, tail = np.r_[True, ~follows], np.r_[~follows, True]
    anchors[np.ix_(head, [3, 6])] = anchors[np.ix_(tail, [3, 6])]
    anchors[head & ~tail & (anchors[:, 0] == SINGLE), 0] = LINE
    nid, hub, anchors = nid[head], hub[head], anchors[head]
    new = np.flatnonzero(np.r_[True, (nid[1:] != nid[:-1]) | (hub[1:] != hub[:-1])])
    for a, b in zip(new, [*new[1:], len(nid)], strict=True):
        yield int(nid[a]), int(hub[a]), anchors[a:b].tobytes()


def grouped(values: np.ndarray) -> np.ndarray:
    """The places of values of 64 bits with equal ones side by side, in order.

    The place is sorted in the lowest bits of the value, which is faster than a sort of places; should values differ
    in these alone, places are sorted.
    """
    values = values.view(_U)
    low = _U(len(values).bit_length())
    packed = np.sort(values >> low << low | np.arange(len(values), dtype=_U))
    order = (packed & ((_U(1) << low) - _U(1))).astype(np.int64)
    packed >>= low
    if ((packed[1:] == packed[:-1]) & (values[order[1:]] != values[order[:-1]])).any():
        return np.argsort(values, kind="stable")
    return order


def _crowds(key: np.ndarray, nid: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the values that have several, in the order of value, nid and place, whether each is the first of its
    value, and the first row of every value."""
    order = grouped(key)
    same = key[order[1:]] == key[order[:-1]]
    many = np.zeros(len(key) + 1, bool)
    many[1:-1] = same
    at = np.flatnonzero(many[:-1] | many[1:])
    rows = order[at]
    rows = rows[np.lexsort((c[rows], nid[rows], key.view(_U)[rows]))]
    order[at] = rows
    return rows, ~many[at], order[~many[:-1]]


def _stars(rows: np.ndarray, first: np.ndarray, nid: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of every value's members to its first one and to the one before.

    where has f, c, l, r. Rows are taken in the order of nid. The second link finds a match for a
    member that shares a value, but no whole passage, with the first.
    """
    nid, where = nid[rows], where[rows]
    row = np.arange(len(rows))
    head = np.maximum.accumulate(np.where(first, row, 0))
    before = np.where(first, row, row - 1)
    before = np.where(nid[before] == nid[head], row, before)
    row, to = np.r_[row, row], np.r_[head, before]
    differ = nid[row] != nid[to]
    row, to = row[differ], to[differ]
    return nid[row], nid[to], np.concatenate([where[row], where[to, 1:]], 1)


def placed_windows(docs: DataFrame) -> DataFrame:
    """Windows of the first text of each batch that has them, and links (nid, hub, anchors) of the
    batch's other texts to it."""
    parts = _parts(docs)

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        nid = b.column("nid").to_numpy()
        data, off = common.utf8(b.column("text"))
        found, copies, seen = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 4), np.int64))], [], {}
        for x, y in common.chunks(off):
            h, woff = common.word_hashes(data[off[x]:off[y]], off[x:y + 1] - off[x], common.SPACE_WORDS)
            s, soff = common.shingle_hashes(h, woff, SHINGLE)
            once = np.ones(y - x, bool)
            for i in range(x, y):
                n = int(soff[i - x + 1] - soff[i - x])
                text = data[off[i]:off[i + 1]].tobytes() if n >= LEAST else b""
                head = seen.setdefault(text, i)
                if text and head != i:
                    once[i - x] = False
                    if nid[i] != nid[head]:
                        copies += [(nid[i], nid[head], [f, 0, 0, n - 1, 0, 0, n - 1]) for f in range(ENOUGH)]
            for f in range(FUNCTIONS):
                value = common.mix(s * _MUL[f])
                row, left, c, right = compact_windows(value, soff)
                use = once[row]
                row, left, c, right = row[use], left[use], c[use], right[use]
                key = common.mix(value[soff[row] + c] + _U(f)).view(np.int64)
                found.append((key, x + row, np.stack([np.full(len(row), f), c, left, right], 1)))
        return _reduced(*map(np.concatenate, zip(*found, strict=True)), nid, copies, True, parts)
    return common.map_arrow(docs.select("nid", "text"), lambda: step, PLACED)


def _hot(nid: np.ndarray, c: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Places of crowded windows, as links of a text to itself."""
    if not len(nid):
        return []
    order = np.lexsort((c, nid))
    nid, c = nid[order], c[order].astype("<i4")
    new = np.flatnonzero(np.r_[True, nid[1:] != nid[:-1]])
    return [(int(nid[a]), int(nid[a]), c[a:b].tobytes()) for a, b in zip(new, [*new[1:], len(nid)], strict=True)]


def _reduced(key: np.ndarray, text: np.ndarray, where: np.ndarray, nid: np.ndarray, copies: list, crowds: bool,
             parts: int) -> pa.RecordBatch:
    """The first row of each value in a batch of texts (numbers in nid), and links of the others to it.

    With crowds, the windows of values with several rows are marked, and their places are told.
    """
    who = nid[text]
    rows, head, first = _crowds(key, who, where[:, 1])
    a, hub, anchors = _stars(rows, head, who, where)
    links = list(_edges(np.r_[a, np.array([z[0] for z in copies], np.int64)],
                        np.r_[hub, np.array([z[1] for z in copies], np.int64)],
                        np.concatenate([anchors, np.array([z[2] for z in copies], np.int64).reshape(-1, ANCHOR)])))
    part = key.view(_U) % _U(parts)
    place = part[first] * _U(len(nid)) + text[first].astype(_U)
    low = _U(len(first).bit_length())
    first = first[(np.sort(place << low | np.arange(len(first), dtype=_U)) & ((_U(1) << low) - _U(1))).astype(np.int64)]
    w = where[first]
    if crowds:
        links += _hot(who[rows], where[rows, 1])
        w[:, 0] |= CROWDED * among(rows, len(key))[first]
    key, who, part = key[first], who[first], part[first].astype(np.int32)
    new = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(key) else []
    data = [_packed(key[a:b], who[a:b], w[a:b]) for a, b in zip(new, [*new[1:], len(key)], strict=True)]
    ids, none = np.array([z[0] for z in links], np.int64), [None] * len(data)
    columns = [pa.array(np.r_[part[new], ids % parts].astype(np.int32) if len(data) else (ids % parts).astype(np.int32)),
               pa.array([*none, *ids], pa.int64()), pa.array([*none, *(z[1] for z in links)], pa.int64()),
               pa.array(data + [z[2] for z in links], pa.binary())]  # links go anywhere
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in PLACED.split(", ")])


def _around(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Places under n that are in one of the ranges."""
    some = low < high
    edge = np.bincount(low[some], minlength=n + 1) - np.bincount(high[some], minlength=n + 1)
    return np.flatnonzero(np.cumsum(edge)[:n])


def earlier(values: np.ndarray) -> np.ndarray:
    """The place of each value's last equal before it, or -1."""
    order = grouped(common.mix(values.astype(_U)))
    same = values[order[1:]] == values[order[:-1]]
    out = np.full(len(values), -1)
    out[order[1:][same]] = order[:-1][same]
    return out


def _in(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    if not len(others):
        return np.zeros(len(values), bool)
    others = np.sort(others)
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def earlier_in_rows(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The place of each value's last equal before it in its row, or -1."""
    keys = values + row.astype(_U) * common._ODD  # equal values of a row have equal ones
    ordered = np.sort(keys)
    some = np.flatnonzero(_in(keys, ordered[1:][ordered[1:] == ordered[:-1]]))
    some = some[np.lexsort((values[some], row[some]))]
    equal = (values[some[1:]] == values[some[:-1]]) & (row[some[1:]] == row[some[:-1]])
    out = np.full(len(values), -1)
    out[some[1:][equal]] = some[:-1][equal]
    return out


def blocks(x: np.ndarray, off: np.ndarray, row: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, row, where): runs and some single shingles of texts around some places c of their rows.

    Of the runs in every block of 50 words around a place, the one of least hash. A run with a
    shingle twice may have too few different ones for a passage, so there whole blocks are taken, too.
    """
    n, of = len(x), np.repeat(np.arange(len(off) - 1), np.diff(off))
    first, end = off[row], off[row + 1]
    c = c + first
    at = _around(np.maximum(c - LEAST + 1, first), np.minimum(c, end - LEAST) + 1, n)
    up, down = common._powers(n)
    total = np.r_[_U(0), np.cumsum(x * up[:n], dtype=_U)]
    run = common.mix((total[GRAM:] - total[:-GRAM]) * down[:max(0, n - GRAM + 1)] + _U(BLOCK))
    least = among(at + run[at[:, None] + np.arange(LEAST - GRAM + 1)].argmin(1), n).nonzero()[0]
    again = at[np.maximum.accumulate(earlier_in_rows(x, of))[at + LEAST - 1] >= at]
    whole = common.mix((total[again + LEAST] - total[again]) * down[again] + _U(LEAST))
    near = _around(np.maximum(c - LEAST + 1, first), np.minimum(c + LEAST, end), n)
    single = common.mix(x + _U(SINGLE))
    start = np.arange(max(0, n - SPARSE + 1))
    start = start[of[start] == of[start + SPARSE - 1]]
    some = among(start + single[start[:, None] + np.arange(SPARSE)].argmin(1), n)
    near = near[some[near]]
    where = [np.stack([np.full(len(p), BLOCK), p, p, p + k - 1], 1) for p, k in ((least, GRAM), (again, LEAST))]
    first, end = off[of[near]], off[of[near] + 1]
    where.append(np.stack([np.full(len(near), SINGLE), near, np.maximum(near - LEAST + 1, first),
                           np.minimum(near + LEAST, end) - 1], 1))
    where, row = np.concatenate(where), of[np.concatenate([least, again, near])]
    where[:, 1:] -= off[row, None]
    return np.concatenate([run[least], whole, single[near]]).view(np.int64), row, where


def placed_blocks(hot: DataFrame) -> DataFrame:
    """Runs and shingles of the texts (nid, body, places) around the places, as windows."""
    parts = _parts(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, who = [], 0, np.zeros(0, np.int64)
        for b in batches:
            nid = b.column("nid").to_numpy()
            places = [np.unique(np.frombuffer(b"".join(x), "<i4")).astype(np.int64) for x in b.column("places").to_pylist()]
            data, off = common.utf8(pa.array(map(zlib.decompress, b.column("body").to_pylist()), pa.binary()))
            for x, y in common.chunks(off):
                h, woff = common.word_hashes(data[off[x]:off[y]], off[x:y + 1] - off[x], common.SPACE_WORDS)
                shingles, soff = common.shingle_hashes(h, woff, SHINGLE)
                row = np.repeat(np.arange(y - x), [len(p) for p in places[x:y]])
                key, row, where = blocks(shingles, soff, row, np.concatenate(places[x:y]))
                found.append((key, len(who) + x + row, where))
                size += len(key)
                if size >= PLACED_ROWS:
                    yield _reduced(*map(np.concatenate, zip(*found, strict=True)), np.r_[who, nid], [], False, parts)
                    found, size = [], 0
            who = np.r_[who, nid] if found else who[:0]
        if found:
            yield _reduced(*map(np.concatenate, zip(*found, strict=True)), who, [], False, parts)
    return hot.mapInArrow(run, PLACED)


def linked(placed: DataFrame) -> DataFrame:
    """(nid, hub, anchors): the links of every window value's members; a task holds its partition.

    Links of a text to itself have the places of its windows in crowds.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nid, where = [], [], []
        names = ["nid", "hub", "anchors"]
        for b in batches:
            link = b.column("nid").is_valid()
            some = b.filter(link)
            if some.num_rows:
                yield pa.RecordBatch.from_arrays([some.column(x) for x in ("nid", "hub", "data")], names)
            for data in b.column("data").filter(pa.compute.invert(link)).to_pylist():
                for out, x in zip((key, nid, where), _unpacked(data), strict=True):
                    out.append(x)
        if key:
            key, nid, where = map(np.concatenate, (key, nid, where))
            marked = where[:, 0] & CROWDED > 0
            where[:, 0] &= ~CROWDED
            rows, first, _ = _crowds(key, nid, where[:, 1])
            found = list(_edges(*_stars(rows, first, nid, where)))
            group = np.cumsum(first) - 1
            crowd = (np.bincount(group, marked[rows]) > 0) | (np.bincount(group) > 2)  # two are linked, of three one text may have two
            rows = rows[crowd[group] & (where[rows, 0] < BLOCK) & ~marked[rows]]
            found += _hot(nid[rows], where[rows, 1])
            for i in range(0, len(found), common.BATCH_ROWS):
                part = zip(*found[i:i + common.BATCH_ROWS])
                types = (pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], names)
    return placed.repartitionById(_parts(placed), "part").mapInArrow(run, "nid long, hub long, anchors binary")


def sums(values: np.ndarray) -> np.ndarray:
    """The sums of the values before each place."""
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def densest(match: np.ndarray) -> tuple[int, int, int]:
    """The range with the greatest sum of 1 per match and -t per other, and that sum, all times 5.

    With the shingles of a set A as matches it is A's best counterpart B: the sum is
    (1 + t) |A & B| - t |B|, and the Jaccard similarity is t or more if that is t |A| or more.
    """
    total = sums(np.where(match, DENOMINATOR, -NUMERATOR))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[:end + 1] == low[end])[0])
    return start, end, int(total[end] - low[end])


def joined_windows(anchors: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Ranges of a pair of texts where windows of enough hash functions overlap in both, or those of a
    run or a line of single shingles are."""
    anchors = anchors[np.lexsort((anchors[:, 4], anchors[:, 1]))]
    groups: list[tuple[int, int, int, int, int]] = []
    functions = (1 << anchors[:, 0]).tolist()
    for has, l1, r1, l2, r2 in zip(functions, *anchors[:, [2, 3, 5, 6]].T.tolist(), strict=True):
        apart, low, high, low2, high2 = [], l1, r1, l2, r2
        for g in groups:
            p, q, u, v, others = g
            if l1 <= q and r1 >= p and l2 <= v and r2 >= u:
                low, high = p if p < low else low, q if q > high else high
                low2, high2 = u if u < low2 else low2, v if v > high2 else high2
                has |= others
            else:
                apart.append(g)
        groups = [*apart, (low, high, low2, high2, has)]
    return list(dict.fromkeys(g[:4] for g in groups if g[4].bit_count() >= ENOUGH or g[4] & (1 << BLOCK | 1 << LINE)))


RANGES = "nid long, hub long, ranges binary"


def candidate_ranges(links: DataFrame) -> DataFrame:
    """(nid, hub, ranges): the interval join of every pair's windows; pairs without a range end here,
    before any text is moved."""
    def step(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        b = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        nid, hub = b.column("nid").to_numpy(), b.column("hub").to_numpy()
        data, off = common.utf8(b.column("anchors"))
        new = np.r_[True, (nid[1:] != nid[:-1]) | (hub[1:] != hub[:-1])]
        pair = np.repeat(np.cumsum(new) - 1, np.diff(off) // (4 * ANCHOR))
        nid, hub = nid[new], hub[new]
        which, ranges = [], []
        anchors = data.view("<i4").reshape(-1, ANCHOR).astype(np.int64)
        for i, _, part in _edges(pair, pair, anchors):  # lines of single shingles from all batches and tasks
            if len(part) == 4 * ANCHOR and part[0] not in (BLOCK, LINE):
                continue
            found = joined_windows(np.frombuffer(part, "<i4").reshape(-1, ANCHOR))
            if found:
                which.append(i)
                ranges.append(np.array(found, "<i4").tobytes())
        at = np.array(which, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nid[at]), pa.array(hub[at]), pa.array(ranges, pa.binary())],
                                          ["nid", "hub", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # with the last pair, which may go on in the next batch
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            nid, hub = b.column("nid").to_numpy(), b.column("hub").to_numpy()
            pair = int(nid[-1]), int(hub[-1])
            other = np.flatnonzero((nid != pair[0]) | (hub != pair[1]))
            start = int(other[-1]) + 1 if len(other) else 0
            if held and (start or pair != last):
                yield step([*held, b.slice(0, start)])
                held = []
            elif start:
                yield step([b.slice(0, start)])
            held.append(b.slice(start))
            last = pair
        if held:
            yield step(held)
    # sorted rows take less than lists that are collected
    return links.repartition("nid", "hub").sortWithinPartitions("nid", "hub").mapInArrow(run, RANGES)


def pieces(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Which of a's values (under n) are in b, the ranges of them that are neighbours in b too, the
    places in b of the last of each, and whether a value comes once in b."""
    count = np.bincount(b, minlength=n)
    at = np.zeros(n, np.int64)
    at[b] = np.arange(len(b))
    hits, once, at = count[a] > 0, count[a] == 1, at[a]
    jump = hits[1:] & hits[:-1] & once[1:] & once[:-1] & (np.diff(at) != 1)
    first, last = hits.copy(), hits.copy()
    first[1:] &= ~hits[:-1] | jump
    last[:-1] &= ~hits[1:] | jump
    return hits, first.nonzero()[0], last.nonzero()[0] + 1, at[last], bool(once[hits].all())


def spread(a: np.ndarray, b: np.ndarray, n: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least place in b of a value of each piece of a or of a later one, and the place after the greatest of each."""
    low, high = np.full(n, len(b)), np.zeros(n, np.int64)
    low[b[::-1]] = np.arange(len(b))[::-1]
    high[b] = np.arange(len(b)) + 1
    edges = np.c_[first, last].ravel()
    edges = edges[:-1] if edges[-1] == len(a) else edges
    low, high = np.minimum.reduceat(low[a], edges)[::2], np.maximum.reduceat(high[a], edges)[::2]
    return np.minimum.accumulate(low[::-1])[::-1], high


def among(values: np.ndarray, n: int) -> np.ndarray:
    """The set of some values under n, as flags."""
    out = np.zeros(n, bool)
    out[values] = True
    return out


def widened(lo: int, hi: int, n: int) -> list[tuple[int, int]]:
    """The range, or those of the shortest passage around it, in a text of n shingles."""
    more = LEAST - (hi - lo)
    if more <= 0:
        return [(lo, hi)]
    if n < LEAST:
        return []
    return list(dict.fromkeys((x, x + LEAST) for x in (min(lo, n - LEAST), max(0, lo - more))))


def similar(x: np.ndarray, y: np.ndarray, n: int, s: int, e: int, u: int,
            v: int) -> tuple[int, int, int, int, float] | None:
    """The ranges of both texts, at least as long as the shortest passage, if they are similar enough."""
    for s2, e2 in widened(s, e, len(x)):
        p = among(x[s2:e2], n)
        for u2, v2 in widened(u, v, len(y)):
            q = among(y[u2:v2], n)
            shared = np.count_nonzero(p & q)
            total = np.count_nonzero(p) + np.count_nonzero(q) - shared
            if shared * DENOMINATOR >= total * NUMERATOR:
                return s2, e2, u2, v2, float(shared / total)
    return None


def grown(x: np.ndarray, y: np.ndarray, s: int, e: int, u: int, v: int,
          j: float) -> tuple[int, int, int, int, float]:
    """The ranges with the equal shingles before and after them, which windows may have cut off."""
    k = min(s, u)
    differ = (x[s - k:s] != y[u - k:u]).nonzero()[0]
    before = k - 1 - int(differ[-1]) if len(differ) else k
    k = min(len(x) - e, len(y) - v)
    differ = (x[e:e + k] != y[v:v + k]).nonzero()[0]
    after = int(differ[0]) if len(differ) else k
    if not before and not after:
        return s, e, u, v, j
    n, x, y = numbered(x, y)
    return similar(x, y, n, s - before, e + after, u - before, v + after) or (s, e, u, v, j)


def search(x: np.ndarray, y: np.ndarray, n: int, l1: int, r1: int, l2: int, r2: int,
           taken: list[tuple[int, int]]) -> list[tuple[int, int, int, int, float]]:
    """The longest similar ranges of x[l1:r1] to y[l2:r2], one after another, apart from those taken.

    A range goes from the start of a piece to the end of a piece. Where the pieces are in order in
    both texts and no shingle comes twice, its counterpart has the same pieces; otherwise it is the
    best one in y, and the best sum of a range that fails bounds that of its parts. Where x repeats
    shingles, ranges count by their different ones: too many that y lacks, more than that bound, or
    just those of a range that failed cannot be similar (one that is widened is always tried).
    """
    a, b = x[l1:r1], y[l2:r2]
    hits, first, last, at, once = pieces(a, b, n)
    if not len(first):
        return []
    places = np.zeros(n, np.int64)
    places[a[::-1]] = np.arange(len(a))[::-1]
    new = places[a] == np.arange(len(a))
    distinct = bool(new.all())
    ordered = distinct and once and bool((np.diff(at) > 0).all())
    start, end = at - (last - first) + 1, at + 1  # of the pieces in b
    good = sums(hits)
    if ordered:  # a range has matches enough if it gains: from its start to its end this doesn't fall
        gain = [(NUMERATOR + DENOMINATOR) * good[p] - NUMERATOR * (p + q) for p, q in ((first, start), (last, end))]
    else:  # another shingle counts once
        bad = sums(~hits & new)
        gain = [good[p] - NUMERATOR * bad[p] for p in (first, last)]
    taken = [(s - l1, e - l1) for s, e in taken]
    long = np.searchsorted(last, first + CORE)  # the first piece that ends a range from here
    best = np.full(len(last) + 1, np.iinfo(np.int64).min)
    best[:-1] = np.maximum.accumulate(gain[1][::-1])[::-1]
    begin = (best[long] >= gain[0]).nonzero()[0]
    for p, q in taken:
        begin = begin[(first[begin] < p) | (first[begin] >= q)]
    if not len(begin):
        return []
    out: list[tuple[int, int, int, int, float]] = []
    failed: list[tuple[int, int, int]] = []
    heap: list[tuple[int, int, int, int]] = []
    if not distinct:
        prior = earlier(a)
        again = np.flatnonzero(prior >= 0)
        wide = y[max(l2 - LEAST, 0):r2 + LEAST]  # with all that a counterpart can be widened by
        hit = among(wide, n)[a]
        near, weight = sums(hit), np.where(earlier(wide) < 0, -NUMERATOR, 0)
        code, lost = common.mix(np.arange(n, dtype=_U) + _U(1)), set()
    if not ordered:
        side, lack = (b, -NUMERATOR) if distinct else (wide, weight)
        total = sums(np.where(among(a, n)[side], DENOMINATOR, lack))
        low, high = spread(a, side, n, first, last)

    def best_sum(i: int, below: int) -> np.ndarray:
        """The greatest sums that y has from any part for ranges from piece i to each one before `below`."""
        most = total[low[i]:]
        most = np.maximum.accumulate(most - np.minimum.accumulate(most))
        return most[np.maximum.accumulate(high[i:below])[long[i] - i:] - low[i]]

    def push(i: int, below: int, most: int | None = None) -> None:
        """The longest range from piece i that ends before piece `below` and has matches enough."""
        s = int(first[i])
        found = (gain[1][long[i]:below] >= gain[0][i]).nonzero()[0]
        size = length = last[long[i] + found] - s
        if distinct:
            fit = np.ones(len(found), bool) if ordered or not len(found) else length * NUMERATOR <= best_sum(i, below)[found]
            if most is not None:
                fit &= length * NUMERATOR <= most
            found = found[fit]
            size = length[fit]
        elif len(found):
            old = again[prior[again] >= s]  # not the first of their kind from s on
            ends = s + length
            size = length - np.searchsorted(old, ends)
            fit = (near[ends] - near[s] - np.searchsorted(old[hit[old]], ends)) * DENOMINATOR >= size * NUMERATOR
            fit &= size * NUMERATOR <= best_sum(i, below)[found]
            if most is not None:
                fit &= size * NUMERATOR <= most
            fit |= length < LEAST
            found, size = found[fit], size[fit]
        if len(found):
            j = int(long[i] + found[-1])
            heapq.heappush(heap, (int(s - last[j]), i, j, int(size[-1])))
    heap += zip((first[begin] - last[-1]).tolist(), begin.tolist(), [-1] * len(begin), [0] * len(begin), strict=True)  # in order
    while heap:
        _, i, j, size = heapq.heappop(heap)
        s, e = int(first[i]), int(last[j])
        counted = not distinct and e - s >= LEAST
        if any(p <= s < q for p, q in taken):
            continue
        until = min((p for p, _ in taken if p > s), default=e)
        if until < e or j < 0:  # with -1, it ends anywhere
            push(i, int(np.searchsorted(last, until, "right")))
            continue
        most = min((m for p, q, m in failed[-64:] if p <= s and e <= q), default=None) if distinct or counted else None
        if most is not None and size * NUMERATOR > most:
            push(i, j, most)
            continue
        if counted:
            here = a[s:e][prior[s:e] < s]
            these = int(code[here].sum())
            fewer = (size - 1) * NUMERATOR
            if these in lost:
                push(i, j, fewer)
                continue
            part = sums(np.where(among(here, n)[wide], DENOMINATOR, weight))
            bound = int((part - np.minimum.accumulate(part)).max())
            if size * NUMERATOR > bound:
                failed.append((s, e, bound))
                push(i, j, min(bound, fewer))
                continue
        most = None
        if ordered:
            tries = [(int(start[i]), int(end[j]))]
        else:
            match = among(a[s:e], n)[b]
            u, v, most = densest(match)
            where = np.flatnonzero(match)
            tries = [(u, v)] if distinct and once else dict.fromkeys([(u, v), (int(where[0]), int(where[-1]) + 1)])
            if distinct and (e - s) * NUMERATOR > most:
                tries = []
        for u, v in tries:
            found = similar(x, y, n, l1 + s, l1 + e, l2 + u, l2 + v)
            if found:
                out.append(found)
                taken.append((s, e))
                break
        else:
            if most is not None and distinct:
                failed.append((s, e, most))
                push(i, j, most)
            elif counted:
                lost.add(these)
                push(i, j, fewer)
            else:
                push(i, j)
    return out


def passages(x: np.ndarray, y: np.ndarray, ranges: list[list[int]]) -> list[tuple[int, int, int, int, float]]:
    """Verified passages of two shingle sequences, as word ranges and their similarity, in ranges
    (first and last shingle) of both."""
    return passages_of(x, y, ranges)[1]


def passages_of(x: np.ndarray, y: np.ndarray, ranges: list[list[int]]) -> tuple[list[int], list[tuple[int, int, int, int, float]]]:
    """The numbers of the ranges that have passages, and these.

    Each range is tried as a whole first, then in parts: those of x and, for what is left of y (it
    may repeat a passage), those of y.
    """
    z = np.array(ranges).reshape(-1, 4)
    at, to = (max(0, int(z[:, k].min(initial=0x7FFFFFFF)) - LEAST) for k in (0, 2))
    n, p, q = numbered(*(t[low:int(z[:, k].max(initial=0)) + 1 + LEAST] for t, low, k in ((x, at, 1), (y, to, 3))))  # with all they are widened by
    found = [[(s + at, e + at, u + to, v + to, j) for s, e, u, v, j in verified(p, q, n, l1 - at, r1 - at, l2 - to, r2 - to)]
             for l1, r1, l2, r2 in ranges]
    out = {grown(x, y, *f) for zs in found for f in zs}
    return ([i for i, zs in enumerate(found) if zs],
            sorted((s, e + SHINGLE - 1, u, v + SHINGLE - 1, j) for s, e, u, v, j in out))


def numbered(x: np.ndarray, y: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of different values of both, and both with these numbered."""
    values = np.concatenate([x, y])
    order = grouped(values)
    number = np.zeros(len(values), np.int64)
    number[order[1:]] = np.cumsum(values[order[1:]] != values[order[:-1]])
    return int(number[order[-1:]].sum()) + min(1, len(values)), number[:len(x)], number[len(x):]


def verified(x: np.ndarray, y: np.ndarray, n: int, l1: int, r1: int, l2: int,
             r2: int) -> list[tuple[int, int, int, int, float]]:
    """The similar ranges in x[l1:r1 + 1] and y[l2:r2 + 1]."""
    r1, r2 = r1 + 1, r2 + 1
    both = among(x[l1:r1], n) & among(y[l2:r2], n)
    p, q = both[x[l1:r1]].nonzero()[0], both[y[l2:r2]].nonzero()[0]
    if len(p) < 2 or p[-1] - p[0] + 1 < CORE and q[-1] - q[0] + 1 < CORE:
        return []
    whole = similar(x, y, n, l1 + int(p[0]), l1 + int(p[-1]) + 1, l2 + int(q[0]), l2 + int(q[-1]) + 1)
    if whole:
        return [whole]
    found = search(x, y, n, l1, r1, l2, r2, [])
    back = search(y, x, n, l2, r2, l1, r1, [z[2:4] for z in found])
    return found + [(s, e, u, v, j) for u, v, s, e, j in back]


#: Bytes of a shingle that are moved to find out which ranges can have a passage.
BYTES = 3
#: Shingles of ranges that are compared together, and places of the table that most strangers among them miss.
COMPARED, TABLE = 1 << 18, 1 << 21


def _runs(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the run and the place of all that runs from `low` on hold."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) + np.repeat(low - (np.cumsum(size) - size), size)


def _keys(which: np.ndarray, values: np.ndarray) -> np.ndarray:
    return which.astype(_U) << _U(32) | values


def _met(xof: np.ndarray, x: np.ndarray, yof: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of x's values are in y's run of the same number, and which of y's in x's."""
    xslot, yslot = ((z + of.astype(np.uint32) * np.uint32(0x9E3779B1)) & np.uint32(TABLE - 1) for z, of in ((x, xof), (y, yof)))
    ysome = np.flatnonzero(among(xslot, TABLE)[yslot])
    xsome = np.flatnonzero(among(yslot[ysome], TABLE)[xslot])
    left, right = _keys(xof[xsome], x[xsome]), _keys(yof[ysome], y[ysome])
    return among(xsome[_in(left, right)], len(x)), among(ysome[_in(right, left)], len(y))


def _spans(which: np.ndarray, hit: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per run, the number of hits and the places from the first to the last."""
    at = np.flatnonzero(hit)
    count = np.bincount(which[at], minlength=n)
    end = np.cumsum(count)
    some = count > 0
    span = np.zeros(n, np.int64)
    span[some] = at[end[some] - 1] - at[(end - count)[some]] + 1
    return count, span


def _dense(which: np.ndarray, hit: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether a run holds LEAST neighbours or more of which enough are hits for a similar range."""
    gain = np.where(hit, DENOMINATOR - NUMERATOR, -NUMERATOR)
    # sums before each place; where a run begins they fall so far that no run's least is an earlier one's
    total = np.cumsum(gain) - gain - which * (int(size.max()) * (DENOMINATOR + NUMERATOR) + 1)
    n = max(0, len(hit) - LEAST + 1)
    good = (total + gain)[LEAST - 1:] >= np.minimum.accumulate(total)[:n]
    return among(which[:n][good & (which[:n] == which[LEAST - 1:])], len(size))


def _twice(which: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Which runs have a value twice."""
    keys = np.sort(_keys(which, values))
    return among((keys[1:][keys[1:] == keys[:-1]] >> _U(32)).astype(np.int64), n)


def possible(x: np.ndarray, y: np.ndarray, xrun: np.ndarray, yrun: np.ndarray, xwide: np.ndarray,
             ywide: np.ndarray) -> np.ndarray:
    """Which pairs of ranges can have a passage, by some bits of their shingles: the runs (start and size in x
    and y) of the ranges and of these with what they can be widened by.

    As in `verified`, what both ranges have must reach over a passage's core. A passage has a part
    that is dense with what the other text has; where one of the texts has no shingle twice, its different
    ones are its places. Equal bits of different shingles can only let more pairs pass.
    """
    n = len(xrun)
    (xof, xat), (yof, yat) = (_runs(*z.T) for z in (xrun, yrun))
    hit, back = _met(xof, x[xat], yof, y[yat])
    count, span = _spans(xof, hit, n)
    some = np.flatnonzero((count > 1) & ((span >= CORE) | (_spans(yof, back, n)[1] >= CORE)))
    if not len(some):
        return some
    (xof, xat), (yof, yat) = (_runs(*z[some].T) for z in (xwide, ywide))
    x, y = x[xat], y[yat]
    hit, back = _met(xof, x, yof, y)
    fit = np.ones(len(some), bool)
    for of, z, found, size in ((xof, x, hit, xwide[some, 1]), (yof, y, back, ywide[some, 1])):
        dense = _dense(of, found, size)
        sparse = ~dense[of]
        fit &= dense | _twice(of[sparse], z[sparse], len(some))
    return some[fit]


def _ranges(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i4").reshape(-1, 4) for x in column.to_pylist()]


def _shingles(column: pa.Array) -> list[np.ndarray]:
    """Shingles of compressed texts; a text is in many neighbouring pairs."""
    bodies = column.to_pylist()
    once = dict.fromkeys(bodies)
    texts = common.shingled(pa.array(map(zlib.decompress, once), pa.binary()), SHINGLE)
    once = {body: x for body, (_, x) in zip(once, texts, strict=True)}
    return [once[body] for body in bodies]


def _sliced(b: pa.RecordBatch) -> pa.RecordBatch:
    """Bits of the shingles of the ranges and of what passages can be widened by."""
    first, part = [], []
    for x, r in zip(_shingles(b.column("body")), _ranges(b.column("ranges")), strict=True):
        first.append(max(0, int(r[:, 0].min()) - LEAST))
        some = x[first[-1]:int(r[:, 1].max()) + 1 + LEAST].astype("<u8")
        part.append(some.view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes())
    columns = [b.column("nid"), b.column("hub"), b.column("ranges"), pa.array(first, pa.int32()), pa.array(part, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["nid", "hub", "ranges", "first", "part"])


def _kept(b: pa.RecordBatch, ranges: list[np.ndarray]) -> pa.RecordBatch:
    """The pairs that have ranges left."""
    keep = [i for i, r in enumerate(ranges) if len(r)]
    left = pa.array([ranges[i].tobytes() for i in keep], pa.binary())
    return pa.RecordBatch.from_arrays([*b.select(["nid", "hub"]).take(pa.array(keep, pa.int64())).columns, left],
                                      ["nid", "hub", "ranges"])


def _possible(b: pa.RecordBatch) -> pa.RecordBatch:
    """The ranges that can have a passage."""
    ranges = _ranges(b.column("ranges"))
    data, off = common.utf8(b.column("part"))
    x = np.zeros((len(data) // BYTES, 4), np.uint8)
    x[:, :BYTES] = data.reshape(-1, BYTES)
    hubs = _shingles(b.column("hub_body"))
    y = (np.concatenate(hubs) & _U((1 << 8 * BYTES) - 1)).astype(np.uint32)
    row = np.repeat(np.arange(len(ranges)), [len(r) for r in ranges])
    every = np.concatenate(ranges).astype(np.int64)
    every[:, :2] -= b.column("first").to_numpy()[row, None]
    runs = []
    for (low, high), base in zip((every[:, :2].T, every[:, 2:].T), (off // BYTES, sums([len(z) for z in hubs])), strict=True):
        start, size = base[row], np.diff(base)[row]
        wide = np.maximum(low - LEAST, 0), np.minimum(high + 1 + LEAST, size)
        runs.append([np.stack([start + p, q - p], 1) for p, q in ((low, high + 1), wide)])
    (xrun, xwide), (yrun, ywide) = runs
    ok = np.zeros(len(every), bool)
    for i, j in common.chunks(sums(xwide[:, 1] + ywide[:, 1]), COMPARED):
        ok[i + possible(x.view("<u4").ravel(), y, *(z[i:j] for z in (xrun, yrun, xwide, ywide)))] = True
    end = np.cumsum([len(r) for r in ranges])
    return _kept(b, [r[ok[e - len(r):e]] for r, e in zip(ranges, end.tolist(), strict=True)])


FOUND = ("doc_id long, start_word int, end_word int, match_doc_id long, match_start_word int, "
         "match_end_word int, similarity double")


def _tried(b: pa.RecordBatch) -> pa.RecordBatch:
    """The ranges that have a passage, and the passages in both directions; pairs without one end here."""
    left, right = _shingles(b.column("body")), _shingles(b.column("hub_body"))
    ids, hubs = b.column("doc_id").to_pylist(), b.column("hub_id").to_pylist()
    kept, rows, count = [], [], []
    for i, ranges in enumerate(_ranges(b.column("ranges"))):
        having, found = passages_of(left[i], right[i], ranges.tolist())
        kept.append(ranges[having])
        if having:
            count.append(2 * len(found))
        for s, e, u, v, j in found:
            rows += [(ids[i], s, e, hubs[i], u, v, j), (hubs[i], u, v, ids[i], s, e, j)]
    fields = [x.split() for x in FOUND.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    columns = zip(*rows) if rows else [[]] * len(fields)
    values = pa.StructArray.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                        [name for name, _ in fields])
    out = _kept(b, kept)
    return pa.RecordBatch.from_arrays([*out.columns, pa.ListArray.from_arrays(sums(count).astype(np.int32), values)],
                                      [*out.schema.names, "found"])


def tried(pairs: DataFrame, body: DataFrame) -> DataFrame:
    """The pairs and ranges that have a passage, and the passages found. Bits of the ranges' shingles alone are moved first;
    whole texts are moved for the pairs that can have a passage by these."""
    hubs = body.select(F.col("nid").alias("hub"), F.col("doc_id").alias("hub_id"), F.col("body").alias("hub_body"))
    slices = common.map_arrow(pairs.join(body, "nid"), lambda: _sliced, RANGES + ", first int, part binary")
    pairs = common.map_arrow(slices.join(hubs, "hub"), lambda: _possible, RANGES)
    return common.map_arrow(pairs.join(body, "nid").join(hubs, "hub"), lambda: _tried,
                            RANGES + f", found array<struct<{FOUND.replace(' ', ': ').replace(',:', ',')}>>")


def bodies(texts: DataFrame) -> DataFrame:
    """(nid, doc_id, body): every different text once, compressed for the shuffles."""
    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        body = pa.array([zlib.compress(t.encode(), 1) for t in b.column("text").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([b.column("nid"), b.column("doc_id"), body], ["nid", "doc_id", "body"])
    return common.map_arrow(texts.select("nid", "doc_id", "text"), lambda: step, "nid long, doc_id long, body binary") \
        .groupBy("nid").agg(F.first("doc_id").alias("doc_id"), F.first("body").alias("body"))


#: Removes a query's shuffle files at its end.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; the shuffle files of what went before are removed with its end, not when
    the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    try:
        return common.cut(df.select("*"))  # planned anew, with the setting
    finally:
        if before is None:
            conf.unset(_CLEAN)
        else:
            conf.set(_CLEAN, before)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages of every text and their matches in another text, in both directions.

    The texts that repeat a passage are linked to one of them and to a neighbour, not in all pairs.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text")).withColumn("nid", F.xxhash64("doc_id", "text"))
    links = _cut(linked(placed_windows(texts)))
    crowds = links.where("nid = hub").groupBy("nid").agg(F.collect_list("anchors").alias("places"))
    blocks = linked(placed_blocks(bodies(texts).join(crowds, "nid").select("nid", "body", "places")))
    pairs = candidate_ranges(links.where("nid <> hub").unionByName(blocks))
    del blocks, crowds
    pairs = _cut(pairs)
    return tried(pairs, bodies(texts)).select(F.inline("found")).distinct()  # one shuffle of texts for all joins


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage of a document and its match in another document."""
    common.prepare(spark)
    return repeated_passages(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
