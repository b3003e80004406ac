"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer reads words and writes symbols with weights: insults (stems and whole words whose
weights, log odds, are learned from labels), threats (weight 1), targets, negations, reported speech,
ends of clauses and other words. Four pattern transducers read symbols and pass them on with marks: an
insult or threat is `negated` or `targeted` after a negation or a target among the ``NEAR`` words before
it, and `reported` after a report in its clause; a target is `addressed` after an insult or threat among
the ``CLOSE`` words before it. Their composition is one clause acceptor, whose state decides under which
marks a word's weight is added to its clause: "you are not an idiot", "you idiot are not" and "not idiot
you" take three different paths. Matched clauses give their totals by marks and the weight of their
strongest insult that is asserted, neither negated nor reported (a path's weight by maximum, not by sum).
These are the inputs of a logistic score that is fitted to the same labels, so the fit weighs the arcs.

An insult's weight depends on how often its stem occurs in the document, because a stem that is
also an ordinary one marks a toxic text only by its number. For the fit, a document's own
contribution is taken out of the weights it is scored with.

The fit uses a bounded sample of ``SAMPLE`` labelled documents, those with the least hash of the
doc_id, and brings at most that many rows of ``FEATURES`` numbers to the driver; scoring reads every
whole text. Labels, language, source and id are no inputs.

Defined cases: a null text is empty; an empty text has the score of no match; documents without
usable labels (or with one class only) get the unfitted weights; a null toxic label is not used;
a doc_id labelled twice is toxic if either row is; a doc_id with several rows counts once in the fit,
with its least text; repeated rows are scored one by one; other columns, of any name, are kept.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE = 12_000
#: Lengths of stems, numbers of occurrences with weights of their own, and entries kept.
STEMS, LEVELS, ENTRIES = range(3, 8), (1, 2, 4, 8), 20_000
LEAST_DOCUMENTS, LEAST_WEIGHT = 4, 1.5
#: Words whose symbols a worker keeps.
CACHE_WORDS = 500_000

# Function words of the grammar in four languages.
NEGATIONS = frozenset("not no never without nicht kein keine nie ohne ne pas jamais sans non nunca sin".split())
REPORTS = frozenset("""said says say told wrote called quoted according sagte sagt schrieb nannte laut dit disait
    déclaré selon dijo dice llamó según""".split())
TARGETS = frozenset("""you your yours they them their he she his her u du dich dir dein ihr euch sie tu toi te
    vous votre ils elles tú tu ti usted vosotros ellos ellas""".split())
THREATS = frozenset("""kill hurt destroy die murder beat burn shoot stab töten umbringen vernichten sterben tuer
    détruire frapper brûler mourir matar destruir quemar golpear morir""".split())

_TOKENS = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_END = frozenset(".!?;:\n")
SYMBOLS = ("other", "end", "negation", "report", "target", "threat", "insult")
#: Words that a negation or target reaches over, and those between an insult and its address.
NEAR, CLOSE = 4, 2
#: Weights of the features where there is nothing to fit them to.
UNFITTED = np.array([-4.0, 0.6, 0.4, 0.8, 0.1, 0.1, 0.5, 0.3, 0.6, 0.4, 0.0])
FEATURES = len(UNFITTED)

#: Arcs of a transducer, by state and symbol read: the next state and the marks written with the symbol.
#: State 0 is the first one.
Arcs = dict[tuple[int, str], tuple[int, frozenset[str]]]


def pattern(mark: str, opens: tuple[str, ...], marked: tuple[str, ...], scope: int | None) -> Arcs:
    """Transducer that marks the symbols `marked` after one of `opens` among the `scope` words before
    (None: anywhere before) in the clause. A state is the number of words that are still in reach."""
    arcs: Arcs = {}
    for state in range((scope or 1) + 1):
        for x in SYMBOLS:
            after = 0 if x == "end" else (scope or 1) if x in opens else state if scope is None else max(state - 1, 0)
            arcs[state, x] = after, frozenset([mark] if state and x in marked else [])
    return arcs


def compose(first: Arcs, second: Arcs) -> Arcs:
    """Transducer of the pairs of states that can be reached; its marks are those of both."""
    number, arcs = {(0, 0): 0}, {}
    pairs = [(0, 0)]
    for pair in pairs:          # grows while it is read
        for x in SYMBOLS:
            (p, a), (q, b) = first[pair[0], x], second[pair[1], x]
            if (p, q) not in number:
                number[p, q] = len(number)
                pairs.append((p, q))
            arcs[number[pair], x] = number[p, q], a | b
    return arcs


_BLAMES = ("insult", "threat")
CLAUSE = functools.reduce(compose, [
    pattern("negated", ("negation",), _BLAMES, NEAR), pattern("reported", ("report",), _BLAMES, None),
    pattern("targeted", ("target",), _BLAMES, NEAR), pattern("addressed", _BLAMES, ("target",), CLOSE)])


def total_of(symbol: str, marks: frozenset[str]) -> str:
    """The total that an arc adds to: one of plain, targeted, negated, reported, addressed, or none."""
    if symbol in _BLAMES:
        return next((x for x in ("negated", "reported", "targeted") if x in marks), "plain")
    return "addressed" if "addressed" in marks else ""


#: The acceptor by state, then by symbol: next state and total added to.
ACCEPTOR = [{x: (CLAUSE[s, x][0], total_of(x, CLAUSE[s, x][1])) for x in SYMBOLS}
            for s in range(len(CLAUSE) // len(SYMBOLS))]


def stems_of(word: str) -> list[str]:
    """A word's own entry (with an equals sign) and its stems."""
    return ["=" + word, *(word[:k] for k in STEMS if k <= len(word))]


def level(n: int) -> int:
    """The highest level index that n occurrences reach."""
    return sum(n >= x for x in LEVELS) - 1


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


class Lexicon:
    """Insult entries with document counts by class and level, and the clause grammar."""

    def __init__(self, rows: list[tuple[str, int, int, int]], toxic: int, clean: int):
        self.toxic, self.clean = toxic, clean
        self.counts: dict[str, list[tuple[int, int] | None]] = {}
        for entry, k, t, c in rows:
            self.counts.setdefault(entry, [None] * len(LEVELS))[k] = (t, c)
        self.memo: dict[str, tuple[str, tuple[str, ...]]] = {}

    def weight(self, entry: str, n: int, label: int | None) -> float:
        """Greatest log odds among the levels that n occurrences reach, without the document itself."""
        best = 0.0
        for found in self.counts[entry][:level(n) + 1]:
            if found:
                t, c = found[0] - (label == 1), found[1] - (label == 0)
                odds = (t + 0.5) / (self.toxic - (label == 1) + 1) * (self.clean - (label == 0) + 1) / (c + 0.5)
                best = max(best, math.log(odds))
        return best

    def symbol(self, word: str) -> tuple[str, tuple[str, ...]]:
        """The lexical transducer: a word's symbol, and its entries if it is an insult."""
        if len(self.memo) > CACHE_WORDS:
            self.memo.clear()
        entries = tuple(x for x in stems_of(word) if x in self.counts)
        found = ("insult" if entries else "end" if word in _END else "negation" if word in NEGATIONS
                 else "report" if word in REPORTS else "threat" if word in THREATS
                 else "target" if word in TARGETS else "other"), entries
        self.memo[word] = found
        return found

    def features(self, text: str, label: int | None = None) -> list[float]:
        """Totals of the document's clauses; label: that of a row whose counts the weights hold."""
        words = _TOKENS.findall(text.lower())
        memo, symbol = self.memo, self.symbol
        symbols = [memo[w] if w in memo else symbol(w) for w in words]
        ends = sum(x == "end" for x, _ in symbols)
        size = math.log1p(len(words) - ends) / 5
        if not any(x in _BLAMES for x, _ in symbols):
            return [1.0] + [0.0] * (FEATURES - 2) + [size]
        number = Counter(e for _, entries in symbols for e in entries)
        weight = {e: self.weight(e, n, label) for e, n in number.items()}
        sums = dict.fromkeys(("plain", "targeted", "negated", "reported", "addressed"), 0.0)
        matched, threats, strongest, hit, seen, state = 0, 0, 0.0, False, set(), 0
        for x, entries in [*symbols, ("end", ())]:
            state, total = ACCEPTOR[state][x]
            if x == "end":
                matched += hit
                hit = False
            elif total:
                w = max(weight[e] for e in entries) if entries else 1.0
                sums[total] += w
                if total != "addressed" and w > 0:
                    hit = True
                    threats += x == "threat"
                    if entries and total in ("plain", "targeted"):
                        strongest = max(strongest, w)
                    seen.update(entries[:1])
        totals = [sums[x] for x in ("plain", "targeted", "negated", "reported")]
        return [1.0, strongest, *map(math.log1p, totals), matched / (ends + 1),
                *map(math.log1p, (len(seen), threats, sums["addressed"])), size]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps; the first feature, the constant, has no penalty."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """doc_id, text and toxic of at most `rows` labelled documents that are not held out, one row of each."""
    ids = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .join(F.broadcast(ids), "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))  # at most `rows` ids


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, np.ndarray]:
    """The lexicon and the weights of the features."""
    rows = common.cut(sample(docs, labels))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon([], 0, 0), UNFITTED

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            found: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                number = Counter()
                for w, n in Counter(_TOKENS.findall(text.lower())).items():
                    if w not in _END:
                        for e in stems_of(w):
                            number[e] += n
                found[toxic].update((e, k) for e, n in number.items() for k in range(level(n) + 1))
            keys = list(found[0].keys() | found[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array([e for e, _ in keys], pa.string()), pa.array([k for _, k in keys], pa.int32()),
                 pa.array([found[1][x] for x in keys], pa.int64()), pa.array([found[0][x] for x in keys], pa.int64())],
                ["entry", "k", "t", "c"])
        return step
    counted = common.map_arrow(rows.select("text", "toxic"), make, "entry string, k int, t long, c long") \
        .groupBy("entry", "k").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = F.log((F.col("t") + 0.5) / (sizes[1] + 1)) - F.log((F.col("c") + 0.5) / (sizes[0] + 1))
    best = counted.where((F.col("t") >= LEAST_DOCUMENTS) & (odds >= LEAST_WEIGHT)) \
        .orderBy((odds * F.sqrt("t")).desc(), "entry", "k").limit(ENTRIES)
    lexicon = Lexicon([tuple(r) for r in best.collect()], sizes[1], sizes[0])

    def inputs():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            toxic = b.column("toxic").to_pylist()
            x = [lexicon.features(t, y) for t, y in zip(b.column("text").to_pylist(), toxic, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("toxic")], ["x", "y"])
        return step
    got = common.map_arrow(rows.select("text", "toxic"), inputs, "x array<double>, y int").collect()
    return lexicon, fit(np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float))


def scored(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """The rows of docs with their score as column `name`, which replaces a column of that name."""
    lexicon, weights = learn(docs, labels)

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([lexicon.features(t or "") for t in b.column("text").to_pylist()])
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            return b.set_column(b.schema.get_field_index(name), name, pa.array(score))
        return step
    df = docs.withColumn(name, F.lit(0.0))
    return common.map_arrow(df, make, df.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: held_out, score and predicted."""
    common.prepare(spark)
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, common.read(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score below 0.5."""
    score = common.free_name(docs, "score")
    return scored(docs, labels, score).where(F.col(score) < 0.5).select(*docs.columns)
