from tidemart.operators.cleaning import CleanSpec, Field, clean, tidy
from tidemart.operators.latest import keep_latest
from tidemart.operators.sampling import hash_sample
from tidemart.operators.skew import measure_hot_keys, spread_join

__all__ = [
    "CleanSpec",
    "Field",
    "clean",
    "hash_sample",
    "keep_latest",
    "measure_hot_keys",
    "spread_join",
    "tidy",
]
