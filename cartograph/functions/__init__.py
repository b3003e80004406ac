"""Column-expression helpers. Everything here returns a ``Column``; nothing runs a job."""

from cartograph.functions.behavior import (  # noqa: F401
    BEHAVIOR_SCORES, DEEP_BEHAVIORS, VALID_BEHAVIORS, behavior_score,
)
from cartograph.functions.numeric import (  # noqa: F401
    argmin_struct, clamp01, euclidean_distance, minmax_scaled, safe_range, significant,
)
from cartograph.functions.text import (  # noqa: F401
    JAVA_WHITESPACE, java_trim, parse_long, split_fields,
)
from cartograph.functions.hashing import stable_order_key  # noqa: F401
