"""Exact duplicates of texts, with the frequent ones split off before the shuffle.

Two texts are equal if they are identical after lower-casing A-Z; they are compared by the SHA-256 of that form. One
scan writes (doc_id, digest); texts are not read again. Misra-Gries summaries of the partitions name the digests that
may be frequent. Their groups are counted exactly, the winners are broadcast, and their rows are resolved on the map
side. All other digests are shuffled; none of them has more than 2 / (k + 1) of the rows.

The row with the largest doc_id stays. Nulls: a null text is empty; a null doc_id is smaller than any other, and a
group of null ids only keeps one row with keep_id null. Rows with equal text and equal doc_id: exactly one stays, which
one is not defined (they cannot be told apart by these columns). An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from .tables import rows_that_stay, saved, texts_of, texts_of_series

COUNTERS = 1023


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lowered = pc.ascii_lower(batch.column(1))  # A-Z only
        out = pa.array([sha256(t).digest() for t in texts_of(lowered)], pa.binary())
        yield pa.record_batch([batch.column(0), out], names=["doc_id", "digest"])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and SHA-256 of the normalised text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digests, "doc_id long, digest binary")


def add_to_summary(summary: dict, keys: Iterator, counts: Iterator[int], k: int) -> None:
    """Misra-Gries: adds counted keys and, if more than k remain, takes the (k+1)th largest count off all counters.
    A counter falls short of the true count by at most (rows / (k + 1))."""
    for key, n in zip(keys, counts):
        summary[key] = summary.get(key, 0) + n
    if len(summary) > k:
        off = int(np.partition(np.fromiter(summary.values(), np.int64), len(summary) - k - 1)[len(summary) - k - 1])
        for key in [x for x, n in summary.items() if n <= off]:
            del summary[key]
        for key in summary:
            summary[key] -= off


def _summaries(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    summary: dict[bytes, int] = {}
    for batch in batches:
        counted = pc.value_counts(batch.column(0))
        add_to_summary(summary, counted.field(0).to_pylist(), counted.field(1).to_pylist(), k)
    names = ["digest", "n"]
    yield pa.record_batch([pa.array(list(summary), pa.binary()), pa.array(list(summary.values()), pa.int64())], names=names)


def frequent(marked: DataFrame, k: int) -> DataFrame:
    """At most k + 1 digests (column digest); every one with at least 2 / (k + 1) of the rows is among them.

    The counters of all partitions fall short of the true counts by rows / (k + 1) together, so those digests have a
    sum of at least rows / (k + 1); the counters add up to no more than all rows, so at most k + 1 digests reach that.
    """
    summaries = marked.select("digest").mapInArrow(partial(_summaries, k=k), "digest binary, n long")
    sums = summaries.groupBy("digest").agg(F.sum("n").alias("n"))
    return sums.filter(F.col("n") * (k + 1) >= marked.count()).select("digest")


def exact_duplicates(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """doc_id, digest, keep_id, group_size and kept for every row of ``docs``."""
    marked = saved(digests(docs).withColumn("row", F.monotonically_increasing_id()), "digests")
    candidates = F.broadcast(frequent(marked, k))  # at most k + 1 rows
    winner = F.max(F.struct("doc_id", "row"))
    winners = marked.join(candidates, "digest").groupBy("digest").agg(winner.alias("w"), F.count("*").alias("group_size"))
    winners = F.broadcast(saved(winners, "winners"))  # at most k + 1 rows
    by_map = marked.join(winners, "digest")
    group = Window.partitionBy("digest")
    rest = marked.join(winners, "digest", "left_anti")
    rest = rest.withColumn("w", winner.over(group)).withColumn("group_size", F.count("*").over(group))
    columns = ["doc_id", "digest", F.col("w.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("w.row")).alias("kept")]
    return by_map.select(*columns).union(rest.select(*columns))


@F.pandas_udf(BinaryType())
def digest_of(text: pd.Series) -> pd.Series:
    """SHA-256 of each text after lower-casing A-Z; null is empty."""
    return pd.Series([sha256(t).digest() for t in texts_of_series(text, pc.ascii_lower)])


def without_exact_duplicates(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows with equal doc_id and equal text become one."""
    stay = exact_duplicates(docs, k).filter("kept").select("doc_id", F.col("digest").alias("mark"))
    return rows_that_stay(docs, digest_of(F.col("text").cast("string")), stay)
