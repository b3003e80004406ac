"""Writers of the exported line formats (K1-K8). All of them overwrite their target."""

from cartograph.sinks.writers import (  # noqa: F401
    clean_lines, feature_lines, write_centers_text, write_clean_log, write_clean_log_text,
    write_features_text, write_index_text, write_labels_text, write_lines, write_pairs_text,
    write_recommendation,
)
