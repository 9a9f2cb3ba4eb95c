from gridlake.functions.columns import (  # noqa: F401
    date_of,
    default_source,
    epoch_micros,
    guarded_ratio,
    hour_utc,
    interval_id,
    interval_day,
    local_to_utc,
    message_key,
    millis_to_timestamp,
    month_of,
    nan_to_null,
    normalize_name,
    null_safe_sum,
    period_return,
    timestamp_to_millis,
    to_int64,
    to_numeric,
)
from gridlake.functions.measures import mean, total, whole_units  # noqa: F401
