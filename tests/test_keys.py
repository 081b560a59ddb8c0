"""Surrogate keys are pinned: a change would orphan every stored fact."""

import pytest
from pyspark.sql import functions as F

from tidemart.functions import or_unknown, surrogate_key


def xxh64(data: bytes, seed: int = 42) -> int:
    import xxhash

    value = xxhash.xxh64_intdigest(data, seed)
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("parts", [["c1"], ["google", "search", "cpc"], ["cpc", "search", "google"]])
def test_key_is_the_chained_hash_of_its_parts(spark, parts):
    seed = 42
    for part in parts:  # the hash of one part seeds the next
        seed = xxh64(part.encode(), seed % 2**64)
    row = spark.range(1).select(surrogate_key(*[F.lit(p) for p in parts]).alias("k")).first()
    assert row["k"] == seed % (2**63 - 1)


def test_missing_parts_are_unknown(spark):
    none = F.lit(None).cast("string")
    row = spark.range(1).select(
        surrogate_key(or_unknown(none), F.lit("x")).alias("a"), surrogate_key(F.lit("unknown"), F.lit("x")).alias("b")
    ).first()
    assert row["a"] == row["b"]
