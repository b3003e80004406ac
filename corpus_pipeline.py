"""Corpus pipeline: filter, deduplicate, decontaminate, redact and pack the documents.

``run(spark, sf_dir)`` applies STAGES in order to ``documents``; each stage's rows are written
as Parquet to the shared checkpoint folder and reread as the documents of the next one, and removed
once that one has been written; the last one's rows stay for the caller. All stages but the last return
the columns of documents.

Defined cases: a null or empty text is scored, is its own class, holds no window and no secret, and is
packed as the separator alone; copies and repeated rows are one class of the n-gram join, of which the
least doc_id stays; rows with a null doc_id go on like others; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartograph.scratch import delete_path
from cartograph.llm import common, decontaminate, ngram_join, packing, secrets, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5; the labels are those of all documents."""
    common.prepare(spark)
    return toxicity.drop_toxic(docs, common.read(spark, sf_dir, "labels"))


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every class of near copies."""
    common.prepare(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    common.prepare(spark)
    return decontaminate.drop_contaminated(docs, common.read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by markers."""
    common.prepare(spark)
    return secrets.redact(docs, common.scratch(spark, "secret-ledger"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    common.prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_each_class),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot express the stages; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs, last = common.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = common.scratch(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            delete_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
