"""Tables, shared folders and text helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.sources.published import remove
from tidemart.sources.scratch import scratch_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return; bytes.split() cuts at the same.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts of a batch that a worker holds a second time as Python values.
TEXTS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder in the one that driver and executors share (spark.checkpoint.dir), or in a temporary folder of a
    local session without that setting."""
    return f"{scratch_folder(spark)}/{purpose}"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder: later reads neither repeat the work nor depend on executors."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes the files of a saved table that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        remove(table.sparkSession, folder)


def lower_ascii(column):
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null is empty. A few texts at a time are copied out of the batch."""
    for at in range(0, len(column), TEXTS_AT_ONCE):
        for x in pc.cast(column.slice(at, TEXTS_AT_ONCE), pa.large_binary()).to_pylist():
            yield x or b""


def texts_of_series(texts: pd.Series, change: Callable[[pa.Array], pa.Array] = lambda x: x) -> Iterator[bytes]:
    """The same of a pandas column, after ``change``."""
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        yield from texts_of(change(pa.array(texts.iloc[at : at + TEXTS_AT_ONCE].tolist(), pa.large_string(), from_pandas=True)))


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema)


def rows_that_stay(docs: DataFrame, mark, stay: DataFrame) -> DataFrame:
    """Rows of ``docs``, with their columns, whose (doc_id, mark of the text) is in ``stay`` (doc_id, mark); of rows that
    agree in both, one. Texts are shuffled once, by id and mark."""
    stay = stay.select(F.col("doc_id").alias("__stay_id"), F.col("mark").alias("__stay_mark"))
    own = docs.withColumns({"__own_id": F.col("doc_id").cast("long"), "__own_mark": mark})
    same = F.col("__own_id").eqNullSafe(F.col("__stay_id")) & (F.col("__own_mark") == F.col("__stay_mark"))
    order = Window.partitionBy("__own_id", "__own_mark").orderBy("__own_mark")
    first = own.join(stay, same, "left_semi").withColumn("__nth", F.row_number().over(order)).filter("__nth = 1")
    return first.select(*[first[c] for c in docs.columns])
