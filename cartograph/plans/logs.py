"""Clean logs of the three bindings, ready for every downstream operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartograph.operators.clean import clean_text, clean_typed
from cartograph.sources.bindings import events_log, events_text_lines, orders_log


def events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding A, validated."""
    return clean_typed(events_log(spark, sf_dir))


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding B, validated."""
    return clean_typed(orders_log(spark, sf_dir))


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding C: raw text lines through the text parser."""
    return clean_text(events_text_lines(spark, sf_dir))
