"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ("ingestion_time",)) -> DataFrame:
    """One row per key: the one with the highest ``newest`` columns, NULLs last.

    The other columns break ties, so the result never depends on row order. ``rank = 1`` on a row_number lets
    Spark prune each map task to one row per key before the shuffle, so a key that holds a large share of the
    input still sends only one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in (*newest, *rest))
    partition = ", ".join(f"`{c}`" for c in keys)
    ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS _rank")
    return ranked.filter("_rank = 1").drop("_rank")
