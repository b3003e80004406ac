"""Readers: raw text logs, typed logs, exported text formats and the driver-table bindings."""

from cartograph.sources.bindings import (  # noqa: F401
    events_log, events_text_lines, events_typed, orders_log, read_table,
)
from cartograph.sources.readers import (  # noqa: F401
    read_clean_log, read_clean_log_text, read_feature_fields, read_features_text, read_index_fields, read_index_text, read_raw_log,
)
