"""Connected components of a link table, by hooking roots to smaller ones and doubling the jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import saved

#: Parts into which the nodes of one label are dealt when labels change, so that a huge component is no hot key.
SALT = 16


def _follow(pairs: DataFrame, key: str, hooks: DataFrame) -> DataFrame:
    """pairs with ``key`` replaced by what it is hooked to. Many rows may share a key; hooks have one row per root."""
    salted = hooks.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_s"))
    left = pairs.withColumn("_s", F.expr(f"CAST(pmod(xxhash64(node), {SALT}) AS INT)"))
    joined = left.join(salted, (left[key] == salted["_hi"]) & (left["_s"] == salted["_s"]), "left")
    return joined.select("node", F.coalesce("_lo", key).alias(key))


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null); root is the smallest node of the component.

    Rounds: every root that a link joins to smaller roots is hooked to the smallest of them; chains of hooks are
    shortened by doubling; labels follow. At least half of the linked roots disappear per round. Repeated links, links
    to oneself and an empty table are fine.
    """
    edges = saved(edges.select("a", "b").filter("a <> b").distinct(), "links")
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = saved(ends.select("node", F.col("node").alias("root")), "labels")
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        apart = edges.join(of_a, "a").join(of_b, "b").filter("ra <> rb")
        hooks = saved(apart.groupBy(F.greatest("ra", "rb").alias("hi")).agg(F.min(F.least("ra", "rb")).alias("lo")), "hooks")
        if hooks.isEmpty():
            return labels
        while True:
            onward = hooks.select(F.col("hi").alias("_mid"), F.col("lo").alias("_end"))
            longer = hooks.join(onward, hooks["lo"] == onward["_mid"], "left")
            longer = saved(longer.select("hi", F.coalesce("_end", "lo").alias("lo"), F.col("_end").isNotNull().alias("moved")), "hooks")
            hooks = longer.select("hi", "lo")
            if longer.filter("moved").isEmpty():
                break
        labels = saved(_follow(labels, "root", hooks), "labels")
