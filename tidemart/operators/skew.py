"""Joins whose left side may hold a hot key.

A key with many times the rows of an average shuffle partition would send them all to one task. ``measure_hot_keys`` finds
such keys with one narrow scan, and ``spread_join`` splits exactly those over many tasks by repeating the few
matching right rows. Keys that are not hot join as usual, and with nothing hot the plan is a plain join.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot with more rows than so many average partitions of a shuffle.
FACTOR = 4
#: With fewer partitions than this no measuring takes place: a key cannot be much larger than a task's share anyway.
LEAST_PARTITIONS = 16
#: Keys a summary tracks for each key that can be hot; its counts are off by a small part of the bar.
TRACKED = 8
#: Summaries of tasks meet in so many groups before they meet in one.
GROUPS = 64
Slots = Mapping[int, int]
HotKeys = Mapping[str, Slots]


def measure_hot_keys(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], share: float | None = None, partitions: int | None = None
) -> dict[str, dict[str, dict[int, int]]]:
    """Table -> column -> hash of a hot key -> number of pieces.

    By default a key is hot beyond ``FACTOR`` average partitions, and its pieces are as large as one; ``partitions`` is
    the session's number of shuffle partitions. With ``share`` it is hot with more than that part of the table's rows.

    One job scans the key columns. Every task keeps a frequent-items summary of key hashes (Spark's approx_top_k), whose length
    follows from the bar alone; summaries are merged in two steps. Fewer keys than 1 / bar can pass, which bounds what
    reaches the driver. NULL keys have one hash and are measured too.
    """
    found: dict[str, dict[str, dict[int, int]]] = {t: {c: {} for c in cs} for t, (_, cs) in tables.items()}
    if not tables:
        return found
    spark = next(df for df, _ in tables.values()).sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit, bar = (share, share) if share else (1 / partitions, FACTOR / partitions)
    if bar >= 1 or not share and partitions < LEAST_PARTITIONS:
        return found
    most = math.ceil(1 / bar)
    tracked = min(1_000_000, TRACKED * most)

    def keys(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        marks = [F.struct(F.lit(c).alias("column"), F.xxhash64(c).alias("key")) for c in columns]
        return df.select(F.lit(table).alias("table"), F.inline(F.array(*marks)))

    rows = reduce(DataFrame.unionByName, [keys(table, df, columns) for table, (df, columns) in tables.items()])
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")
    state, count = F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("state"), F.count(F.lit(1)).alias("n")
    parts = rows.groupBy("table", "column", group).agg(state, count)
    whole = parts.groupBy("table", "column").agg(F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"), F.sum("n").alias("rows"))
    frequent = whole.select("table", "column", "rows", F.inline(F.expr(f"approx_top_k_estimate(state, {most})")))
    for row in frequent.filter(F.col("count") > F.col("rows") * bar).collect():
        pieces = math.ceil(row["count"] / max(1.0, row["rows"] * unit))
        if pieces > 1:
            found[row["table"]][row["column"]][row["item"]] = pieces
    return found


def _pieces(key: Column, hot: Slots) -> Column:
    """Number of pieces of a key, rounded up to a power of two: the hot hashes then are few sets, which Spark looks up in
    constant time however many they are."""
    sets = defaultdict(list)
    for hashed, n in hot.items():
        sets[1 << (n - 1).bit_length()].append(hashed)
    pieces = F.lit(1)
    for n, hashes in sorted(sets.items()):
        pieces = F.when(F.xxhash64(key).isin(hashes), n).otherwise(pieces)
    return pieces


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: Slots | None,
    spread_by: Sequence[str],
    how: str = "left",
    also: Sequence[str] = (),
) -> DataFrame:
    """``left.join(right, [key, *also], how)`` with hot keys split by the hash of ``spread_by``.

    ``spread_by`` are left columns that tell the rows of one key apart, so the split is the same when a lost task
    runs again. ``how`` must keep left rows apart: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split the left side of a {how} join")
    if left.schema[key].dataType != right.schema[key].dataType:
        raise TypeError(f"{key} has different types on the two sides")
    if not hot:
        return left.join(right, [key, *also], how)
    pieces = _pieces(F.col(key), hot)
    split = left.withColumn("_piece", F.pmod(F.xxhash64(*spread_by), pieces).cast("int"))
    repeated = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return split.join(repeated, [key, *also, "_piece"], how).drop("_piece")
