"""Keyed tables whose upserts cost what a batch touches, not what the table holds.

Rows are dealt into hash buckets of their key. The base has one folder per bucket with one row per key. A micro-batch
writes its latest row per key as a delta, in folders of just the buckets it touches. The table is read as: untouched buckets of the base as
they are (no shuffle), touched buckets without the keys of the deltas, and the latest delta row of each key. ``merge_deltas``
writes the touched buckets anew and leaves all other folders; it runs by itself once ``MOST_DELTAS`` batches wait.

The pointer (``sources/published.py``) names the base folder of each bucket and the deltas in their order, so readers never see a
half-written batch. A batch that runs again rewrites its own delta; a batch number below those already merged means that the
checkpoint was lost, and is refused.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.latest import keep_latest
from tidemart.sources.published import KEPT, children, next_number, pointers, publish, read_parts, remove, state_of, tidy

#: Waiting batches that are merged into the base.
MOST_DELTAS = 8


def _bucket(keys: Sequence[str], buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])


def _buckets_in(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removeprefix("bucket=")) for n in children(spark, folder) if n.startswith("bucket="))


def write_delta(rows: DataFrame, table: str, batch_id: int, keys: Sequence[str], buckets: int = 0) -> None:
    """Adds a batch (one row per key) to the table. ``buckets`` counts only for a table that does not exist yet; by default it
    gets as many as the cluster deals its shuffles over, so that a bucket is what one task can hold."""
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = next_number(spark, table)
    state = state_of(spark, table) or {"buckets": buckets, "base": {}, "deltas": {}, "merged": -1}
    if batch_id <= state["merged"]:
        raise ValueError(f"batch {batch_id} of {table} is merged already: a new checkpoint needs a new table")
    folder = f"{table}/delta/batch_id={batch_id}"
    dealt = rows.withColumn("bucket", _bucket(keys, state["buckets"])).repartition("bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    state["schema"] = rows.schema.json()
    state["keys"] = list(keys)
    state["deltas"][str(batch_id)] = _buckets_in(spark, folder)
    publish(spark, table, state, number)


class Upserted:
    """A table as its pointer says at the moment of opening."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table, self.state = spark, table, state_of(spark, table)
        if not self.state:
            raise FileNotFoundError(f"{table} was never written")
        self.schema = T.StructType.fromJson(json.loads(self.state["schema"]))
        self.keys: list[str] = self.state["keys"]
        self.touched = sorted({b for buckets in self.state["deltas"].values() for b in buckets})

    def _parts(self, touched: bool) -> dict[str, str]:
        """Base folders of the buckets that waiting batches touch, or of the others."""
        return {b: v for b, v in self.state["base"].items() if (int(b) in self.touched) == touched}

    def _base(self, touched: bool) -> DataFrame:
        """Base rows of these buckets, with their bucket."""
        return read_parts(self.spark, f"{self.table}/base", _with_bucket(self.schema), "bucket", self._parts(touched))

    def deltas(self) -> DataFrame:
        """Rows of the waiting batches, with bucket and batch_id."""
        schema = T.StructType([*_with_bucket(self.schema).fields, T.StructField("batch_id", T.LongType())])
        paths = [f"{self.table}/delta/batch_id={n}" for n, buckets in self.state["deltas"].items() if buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.table}/delta").parquet(*paths)

    def superseded(self) -> DataFrame:
        """Base rows whose keys the waiting batches bring anew: what the table loses by them."""
        return self._base(touched=True).join(self.deltas().select(*self.keys).distinct(), self.keys, "left_semi")

    def _touched_rows(self) -> DataFrame:
        """Current rows of the touched buckets, with their bucket."""
        latest = keep_latest(self.deltas(), self.keys, newest=("batch_id",)).drop("batch_id")
        if not self._parts(touched=True):  # a join with no rows would still sort all waiting ones a second time
            return latest
        kept = self._base(touched=True).join(latest.select(*self.keys), self.keys, "left_anti")
        return kept.unionByName(latest)

    def rows(self) -> DataFrame:
        parts = self._base(touched=False)
        if self.touched:
            parts = parts.unionByName(self._touched_rows())
        return parts.select(*self.schema.names)

    def merge(self) -> None:
        """Writes the touched buckets as the new base and drops the deltas."""
        if not self.touched:
            return
        spark, table = self.spark, self.table
        number = next_number(spark, table)
        folder = f"{table}/base/version={number:012d}"
        # The bucket alone decides the task: a bucket is written as one file, whatever its number of keys.
        self._touched_rows().repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = {str(b): f"{number:012d}" for b in _buckets_in(spark, folder)}
        merged = max(self.state["merged"], *map(int, self.state["deltas"]))
        publish(spark, table, self.state | {"base": self.state["base"] | written, "deltas": {}, "merged": merged}, number)
        self.__init__(spark, table)
        held = [state for _, state in pointers(spark, table, KEPT)]
        tidy(spark, table, {f"version={v}" for state in held for v in state["base"].values()}, "base")
        batches = {f"batch_id={n}" for state in held for n in state["deltas"]}
        for name in children(spark, f"{table}/delta"):
            if name not in batches:
                remove(spark, f"{table}/delta/{name}")


def read_upserts(spark: SparkSession, table: str) -> DataFrame:
    """The current rows, one per key."""
    return Upserted(spark, table).rows()


def merge_deltas(spark: SparkSession, table: str, most: int = 0) -> None:
    """Merges the waiting batches if they are more than ``most``."""
    if state_of(spark, table) and len((found := Upserted(spark, table)).state["deltas"]) > most:
        found.merge()
