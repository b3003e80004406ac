"""Structured Streaming variants: continuous log cleaning and per-user activity."""

from cartograph.streaming.ingest import (  # noqa: F401
    clean_log_stream, ingest_clean_log, user_activity_stream,
)
