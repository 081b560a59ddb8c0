from tidemart.functions.columns import (
    blank_to_null,
    date_key,
    flag,
    guarded_ratio,
    hash_bucket,
    kpi_ratio,
    money_sum,
    norm_text,
    or_unknown,
    session_id,
    surrogate_key,
)

__all__ = [
    "blank_to_null",
    "date_key",
    "flag",
    "guarded_ratio",
    "hash_bucket",
    "kpi_ratio",
    "money_sum",
    "norm_text",
    "or_unknown",
    "session_id",
    "surrogate_key",
]
