"""Repeatable sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: rows taken per run by the source generator.
DEFAULT_SAMPLE = 1500
# Bits of a hash that one histogram tells apart.
STEP = 12


def hash_border(df: DataFrame, hashed: Column, rows: int) -> int:
    """A value of the long column ``hashed`` up to which at least ``rows`` rows of ``df`` lie, and at most twice as many
    (but for equal hashes, and the largest long if there are fewer rows).

    A histogram over the leading bits finds the slot that holds the wanted row; while that slot is too large, the next
    bits are counted within it. At most 2^STEP counts reach the driver at a time, whatever the size of the table.
    """
    slot, shift, below = 0, 64, 0
    while shift > STEP:
        inside = df if shift == 64 else df.filter(F.shiftright(hashed, shift) == slot)
        shift -= STEP
        counts = inside.groupBy(F.shiftright(hashed, shift).alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()
        for found in sorted((r["slot"], r["n"]) for r in counts):
            slot, reached = found[0], below + found[1]
            if reached >= rows:
                break
            below = reached
        else:
            return (1 << 63) - 1
        if reached <= 2 * rows:
            break
    return (slot << shift) + (1 << shift) - 1


def hash_sample(df: DataFrame, keys: list[str], rows: int = DEFAULT_SAMPLE) -> DataFrame:
    """``rows`` pseudo-random rows, the same ones on every run: those with the smallest hashes of ``keys``.

    Only rows up to the hash border are put in order; the remaining columns break ties between repeated keys.
    """
    hashed = F.xxhash64(*keys)
    rest = [c for c in df.columns if c not in keys]
    return df.filter(hashed <= hash_border(df, hashed, rows)).orderBy(hashed, *keys, *rest).limit(rows)
