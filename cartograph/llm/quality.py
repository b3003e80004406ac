"""Quality rules by distribution divergence (DataFrame functions only).

Every document gets a histogram of character classes and one of its language's common words.
The sums over all documents of a language that pass the base rules are that language's
references. A document whose Jensen-Shannon distance to either reference is above a limit is
not kept. A short document's histogram is far from any reference by chance alone, so the limit
has an allowance that falls with its length, and below ``MIN_WORDS`` the base rule decides.

Defined cases: a null text has no words and fails the base rule, as does an empty one; a null or
unknown language is one and the same, without common words; repeated rows are all returned
(and counted in the references); repeated words of trigrams are found by 64-bit hashes; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_WORDS = 50
#: Limits of the Jensen-Shannon distance (base 2, 0 to 1), and allowances that are divided by the
#: root of the characters or words.
CLASS_LIMIT, CLASS_ALLOWANCE = 0.12, 2.6
WORD_LIMIT, WORD_ALLOWANCE = 0.12, 1.9

# White space, symbols, and the other character classes.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
PUNCTUATION = ".,;:!?'\"()[]{}-_/\\@+=~^`"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The most common function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it as was with be by on not he his but".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}
N_COMMON = 20
CLASSES = ["letters", "capitals", "spaces", "symbols", "digits", "punctuation", "wide"]


def repeat_words(hashes: str) -> Column:
    """Words inside 3-word windows that occur twice or more, from an array of word hashes.

    Windows are sorted with their places; the windows equal to a neighbour are repeated, and
    their places, back in order, cover min(3, distance to the next) words each.
    """
    return F.expr(f"""
        CASE WHEN size({hashes}) < 4 THEN 0L ELSE
        aggregate(
          array_sort(transform(
            filter(
              transform(array(array_sort(transform(sequence(0, size({hashes}) - 3),
                i -> struct(xxhash64({hashes}[i], {hashes}[i + 1], {hashes}[i + 2]) AS h, i AS i)))),
                s -> transform(s, (x, j) -> struct(
                  x.i AS i,
                  (j > 0 AND s[greatest(j - 1, 0)].h = x.h)
                    OR (j + 1 < size(s) AND s[least(j + 1, size(s) - 1)].h = x.h) AS again)))[0],
              x -> x.again),
            x -> x.i)),
          struct(0L AS n, -3 AS at),
          (a, i) -> struct(a.n + least(3, i - a.at) AS n, i AS at),
          a -> a.n) END""")


def features(docs: DataFrame) -> DataFrame:
    """Counts of every document; the text is read once and not carried on."""
    spaces = f"[{' '}\\x09-\\x0D]+"
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    df = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.when(lang.isin(*COMMON_WORDS), lang).otherwise("").alias("lang"))
    df = df.withColumn("words", F.filter(F.split("text", spaces), lambda w: w != ""))
    # Each class is counted by its own search, which costs little where the class is rare.
    for name, members in (("spaces", SPACES), ("symbols", SYMBOLS), ("digits", DIGITS),
                          ("punctuation", PUNCTUATION), ("capitals", CAPITALS)):
        pattern = "[" + "".join(f"\\x{ord(c):02X}" for c in members) + "]"
        df = df.withColumn(name, F.regexp_count("text", F.lit(pattern)).cast("long"))
    length = F.length("text").cast("long")
    df = df.withColumn("wide", F.octet_length("text") - length)
    letters = length - sum((F.col(c) for c in CLASSES[1:-1]), F.lit(0)) - F.col("wide")
    classes = F.array(F.greatest(letters, F.lit(0).cast("long")), *[F.col(c).cast("long") for c in CLASSES[1:]])
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    df = df.withColumn("seen", F.filter(F.transform("words", lambda w: F.lower(F.translate(w, PUNCTUATION, ""))),
                                        lambda w: w.isin(every)))
    listed = F.lit(None).cast("array<string>")
    for lang, words in COMMON_WORDS.items():
        listed = F.when(F.col("lang") == lang, F.array(*map(F.lit, words))).otherwise(listed)
    df = df.withColumn("listed", F.coalesce(listed, F.expr("CAST(array() AS array<string>)")))
    # a second reference keeps Catalyst from moving "seen" into the function, once per listed word
    hits = F.when(F.size("seen") == 0, F.transform("listed", lambda w: F.lit(0).cast("long"))) \
        .otherwise(F.transform("listed", lambda w: F.size(F.filter("seen", lambda x: x == w)).cast("long")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{' '}\\x09-\\x0D]"))
    df = df.withColumn("hits", hits).withColumn("lines", lines) \
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"),
        (length - F.col("spaces")).alias("word_chars"), F.col("symbols").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words("hashes").alias("n_repeat_words"), classes.alias("classes"), "hits")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rest = F.col("n_words") - F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select("*", failed.alias("base_failed"),
                     F.concat("hits", F.array(F.greatest(rest, F.lit(0).cast("long")))).alias("common")).drop("hits")


def references(counts: DataFrame) -> DataFrame:
    """One row per language: sums of both histograms over its documents."""
    def sums(c: str, n: int) -> Column:
        return F.array(*[F.coalesce(F.sum(F.get(c, F.lit(i))), F.lit(0)) for i in range(n)]).alias(f"ref_{c}")
    return counts.groupBy("lang").agg(sums("classes", len(CLASSES)), sums("common", N_COMMON + 1))


def js_distance(counts: str, reference: str) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two histograms; 0 if one is empty."""
    return F.expr(f"""
        CASE WHEN aggregate({counts}, 0L, (a, x) -> a + x) = 0
               OR coalesce(aggregate({reference}, 0L, (a, x) -> a + x), 0L) = 0 THEN 0D ELSE
        sqrt(greatest(0D, aggregate(
          zip_with(
            transform({counts}, x -> x / aggregate({counts}, 0L, (a, y) -> a + y)),
            transform(slice({reference}, 1, size({counts})),
                      x -> x / aggregate({reference}, 0L, (a, y) -> a + y)),
            (p, q) -> CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0D END
                    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0D END),
          0D, (a, x) -> a + x) / 2)) END""")


def _near(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """counts with both distances to the references of the language, and whether both are near."""
    # one row per language with a list of words, and one for all others
    df = counts.join(F.broadcast(refs), "lang", "left").withColumn("class_distance", js_distance("classes", "ref_classes")) \
        .withColumn("word_distance", js_distance("common", "ref_common")).drop("ref_classes", "ref_common")
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    class_limit = CLASS_LIMIT + CLASS_ALLOWANCE / F.sqrt(F.greatest(chars, F.lit(1)))
    word_limit = WORD_LIMIT + WORD_ALLOWANCE / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    return df.withColumn("near", (F.col("class_distance") <= class_limit) & (F.col("word_distance") <= word_limit))


def judged(counts: DataFrame) -> DataFrame:
    """counts with both distances and the verdict.

    The references are summed twice: over all documents that pass the base rules, and then over
    those of them that are near the first references, so that junk does not move them.
    """
    passed = counts.where(~F.col("base_failed"))
    refs = references(_near(passed, references(passed)).where("near"))
    return _near(counts, refs).withColumn("kept", ~F.col("base_failed") & F.col("near"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the base counts, both distances, base_failed and kept."""
    common.prepare(spark)
    counts = common.cut(features(common.read(spark, sf_dir, "documents")))
    return judged(counts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))
