"""Column expressions used by every layer. All are built-in, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Surrogate keys are the 64-bit hash folded into [0, 2^63 - 2].
KEY_MODULUS = 9223372036854775807
UNKNOWN = "unknown"

# Cents plus two guard digits. Sums of this type do not depend on row order.
MONEY_TERM = "decimal(18,4)"

FOLDS = {"lower": F.lower, "upper": F.upper, "keep": lambda c: c}


def blank_to_null(c: Column) -> Column:
    """Trim, then turn the empty string into NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def norm_text(c: Column, fold: str = "keep", blank_is_null: bool = True) -> Column:
    """Trim and change case: ``lower``, ``upper`` or ``keep``."""
    return FOLDS[fold](blank_to_null(c) if blank_is_null else F.trim(c))


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def guarded_ratio(numerator: Column, denominator: Column, guard: Column | None = None) -> Column:
    """``numerator / denominator`` where the guard (by default the denominator) is positive, else NULL."""
    return F.when((denominator if guard is None else guard) > 0, numerator / denominator)


def kpi_ratio(numerator: Column, denominator: Column, digits: int, scale: int = 1) -> Column:
    """Rounded ratio for reports: 0.0 where the denominator is not positive."""
    value = numerator / denominator
    if scale != 1:
        value = value * scale
    return F.round(F.when(denominator > 0, value).otherwise(F.lit(0.0)), digits)


def surrogate_key(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(KEY_MODULUS))


def date_key(day: Column) -> Column:
    """Calendar day as a ``yyyyMMdd`` integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def money_sum(c: Column) -> Column:
    """Exact sum of a money column held as double."""
    return F.sum(c.cast(MONEY_TERM))


def hash_bucket(c: Column, buckets: int) -> Column:
    """|hash| mod n. The remainder is taken first, because |smallest long| overflows."""
    return F.abs(F.xxhash64(c) % F.lit(buckets))


def session_id(user: Column, order: Column, product: Column) -> Column:
    """``sess_`` and the first 12 hex digits of the md5 of the three ids."""
    digest = F.md5(F.concat_ws("||", user, order, product))
    return F.concat(F.lit("sess_"), F.substring(digest, 1, 12))
