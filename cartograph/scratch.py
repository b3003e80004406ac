"""Scratch storage with an owner.

A ``Scratch`` is one folder below the session's shared checkpoint folder. A call that cuts a lineage
or hands data from one job to the next puts its files there, and removes them with ``release`` (or at
the end of a ``with`` block) once its result no longer reads them. Cuts are written tables, so a lost
executor reads them again; unlike a checkpoint, nobody has to wait for a garbage collection to get the
space back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartograph.session import ensure_checkpoint_dir


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def left_over(spark: SparkSession) -> list[str]:
    """Names of what is in the session's checkpoint folder now."""
    p, fs = _path(spark, ensure_checkpoint_dir(spark))
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


class Scratch:
    """A folder of its own for the files of one call."""

    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        """A fresh path in the folder."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, name: str = "cut") -> DataFrame:
        """df written and read back: valid until ``release``."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Removes the folder; a second call does nothing."""
        delete_path(self.spark, self.folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.release()
