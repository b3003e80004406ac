"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger keeps, per
(blob, rule version), the spans found; a scan takes only the pairs that the ledger lacks, each
once however many paths share the blob, appends them, and joins the findings of all blobs back
to all paths.

Defined cases: a null text is an empty one; an empty text has no span; equal texts are one blob;
repeated rows are all returned; other columns of the input are ignored; a null doc_id is kept.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The base kinds, in their order, with the least length of the checked group.
BASE_RULES = [
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
# Kinds beyond the base, from the public formats of these credentials.
MORE_RULES = [
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 36),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 1),
]
RULES = BASE_RULES + MORE_RULES
KINDS = [k for k, *_ in RULES]
#: What a span must have next to it, so that a quick search can rule a kind out.
_QUICK = {"hex": re.compile(r"[0-9a-f]{32}"), "access": re.compile("AKIA"), "github": re.compile("gh[pousr]_"),
          "slack": re.compile("xox"), "jwt": re.compile("eyJ"), "pem": re.compile("-----BEGIN ")}

FINDINGS = "spans array<struct<kind:int,start:int,end:int>>"
LEDGER = f"blob string, rule_version string, {FINDINGS}"


def rule_version(rules: list[tuple[str, str, int, int]] = RULES) -> str:
    """Content address of a set of rules."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def find_spans(text: str, compiled: list[tuple[int, re.Pattern, re.Pattern | None, int, int]]) -> list[dict]:
    """All spans by start, then kind; a match with a too short group is dropped, not retried."""
    out = []
    for i, rx, quick, group, least in compiled:
        if quick is not None and not quick.search(text):
            continue
        out += [(m.start(), i, m.end()) for m in rx.finditer(text) if len(m[group]) >= least]
    return [{"kind": i, "start": s, "end": e} for s, i, e in sorted(out)]


def compile_rules(rules: list[tuple[str, str, int, int]] = RULES):
    return [(i, re.compile(p), _QUICK.get(k), g, n) for i, (k, p, g, n) in enumerate(rules)]


def _scan(rules):
    def make():
        compiled, version = compile_rules(rules), rule_version(rules)
        spans = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [find_spans(x, compiled) for x in b.column("content").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [b.column("blob"), pa.array([version] * b.num_rows), pa.array(found, spans)],
                ["blob", "rule_version", "spans"])
        return step
    return make


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger at a path; empty while nothing has been scanned."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(ledger) if there else spark.createDataFrame([], LEDGER)


def scan_blobs(addressed: DataFrame, ledger: str, rules: list = RULES) -> DataFrame:
    """(blob, spans) of the blobs with findings, after the unseen blobs of addressed(blob, content)
    have been scanned and added to the ledger.

    Writes to the ledger folder before it returns. A blob that another run adds at the same time
    is stored twice with equal spans; one of them is read.
    """
    spark = addressed.sparkSession
    version = rule_version(rules)
    known = read_ledger(spark, ledger).where(F.col("rule_version") == version).select("blob")
    # grouped before the anti join: one row per blob and map task is shuffled, however often a text is repeated
    unseen = addressed.groupBy("blob").agg(F.first("content").alias("content")).join(known, "blob", "left_anti")
    common.map_arrow(unseen, _scan(rules), LEDGER).write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger).where((F.col("rule_version") == version) & (F.size("spans") > 0)) \
        .groupBy("blob").agg(F.first("spans").alias("spans"))


def scan_versions(versions: DataFrame, ledger: str, rules: list = RULES) -> DataFrame:
    """(path, blob, spans) of all rows of versions(path, content); see scan_blobs."""
    content = F.coalesce(F.col("content").cast("string"), F.lit(""))
    addressed = versions.select("path", F.sha2(content, 256).alias("blob"), content.alias("content"))
    found = scan_blobs(addressed.select("blob", "content"), ledger, rules)
    return addressed.drop("content").join(found, "blob", "left") \
        .withColumn("spans", F.coalesce("spans", F.expr(f"CAST(array() AS {FINDINGS[6:]})")))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    common.prepare(spark)
    docs = common.read(spark, sf_dir, "documents")
    found = scan_versions(docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content")),
                          common.scratch(spark, "secret-ledger"))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    return found.select(
        F.col("path").alias("doc_id"),
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.col("blob"))


def redact(docs: DataFrame, ledger: str, rules: list = RULES) -> DataFrame:
    """The documents with every span replaced by ``[SECRET:kind]`` and n_chars, where a text
    changed, counted anew. A null text stays null; all columns and rows are kept."""
    names, kinds = docs.columns, [k for k, *_ in rules]
    docs = common.set_aside(docs, "__blob", "__spans")
    columns = docs.columns

    def cover(text: str, spans: list[dict] | None) -> str:
        parts, at = [], 0
        for s in spans or ():
            if s["start"] >= at:
                parts += [text[at:s["start"]], f"[SECRET:{kinds[s['kind']]}]"]
            at = max(at, s["end"])
        return "".join([*parts, text[at:]])

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = map(cover, b.column("text").to_pylist(), b.column("__spans").to_pylist())
            return b.set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
        return step

    blob = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = scan_blobs(docs.select(blob.alias("blob"), F.coalesce("text", F.lit("")).alias("content")), ledger, rules)
    found = found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    joined = docs.withColumn("__blob", blob).join(found, "__blob", "left").drop("__blob")
    dirty = F.col("__spans").isNotNull()
    done = common.map_arrow(joined.where(dirty), make, joined.schema)
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.where(~dirty).unionByName(done).select(*columns).toDF(*names)
