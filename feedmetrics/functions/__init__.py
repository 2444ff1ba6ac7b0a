from feedmetrics.functions.columns import (  # noqa: F401
    q,
    classify_suffix,
    outside,
    duration_parts,
    nan_as_null,
    coerce_numeric,
)
from feedmetrics.functions.logtime import log_time_ms, LOG_TIME_PATTERNS  # noqa: F401
