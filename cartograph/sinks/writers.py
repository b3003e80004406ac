"""Text and parquet sinks (K1-K8).

Every writer uses mode("overwrite") (K8) and raises when the write fails. Outputs are
written partitioned (one file per task); ``single_file=True`` folds a bounded result
(top pairs, k centres, one recommendation line) into one part file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.operators.cooccur import pair_lines
from cartograph.operators.index import index_lines
from cartograph.operators.kmeans import center_lines, label_lines
from cartograph.schemas import FEATURE_COLUMNS


def write_lines(lines: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a one-column (``value``) DataFrame as text files under ``path``."""
    out = lines.coalesce(1) if single_file else lines
    out.write.mode("overwrite").text(path)
    return path


def clean_lines(clean: DataFrame) -> DataFrame:
    """K1 text: ``uid,iid,cid,bt,ts`` with canonical integers."""
    return clean.select(F.concat_ws(
        ",", *[F.col(c).cast("string") for c in
               ("user_id", "item_id", "category_id", "behavior_type", "ts")]).alias("value"))


def write_clean_log_text(clean: DataFrame, path: str) -> str:
    return write_lines(clean_lines(clean), path)


def write_clean_log(clean: DataFrame, path: str) -> str:
    """Typed hand-over between our own jobs (parquet keeps types and allows pushdown)."""
    clean.write.mode("overwrite").parquet(path)
    return path


def feature_lines(features: DataFrame, cols: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """K2 text: ``uid,F1,F2,F3`` with four decimals (Java rounding, point as separator)."""
    return features.select(F.concat_ws(
        ",", F.col("user_id").cast("string"),
        *[F.format_string("%.4f", F.col(c)) for c in cols]).alias("value"))


def write_features_text(features: DataFrame, path: str) -> str:
    return write_lines(feature_lines(features), path)


def write_index_text(index: DataFrame, path: str) -> str:
    """K3: ``item<TAB>u1,u2,...`` (a split hot item writes several lines)."""
    return write_lines(index_lines(index), path)


def write_pairs_text(top: DataFrame, path: str) -> str:
    """K4: ``a,b<TAB>count`` in rank order, one file (the result is top-N bounded)."""
    return write_lines(pair_lines(top), path, single_file=True)


def write_centers_text(centers: DataFrame, path: str) -> str:
    """K5: ``cid<TAB>F1,F2,F3``, one file (k rows)."""
    return write_lines(center_lines(centers), path, single_file=True)


def write_labels_text(labels: DataFrame, path: str) -> str:
    """K6: ``uid,cid`` (partitioned; one row per user)."""
    return write_lines(label_lines(labels), path)


def write_recommendation(line: DataFrame, path: str) -> str:
    """K7: the single recommendation line."""
    return write_lines(line, path, single_file=True)
