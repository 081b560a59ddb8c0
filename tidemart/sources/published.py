"""Tables that change while others read them: files first, then one small pointer file that names them.

A table's folder holds data folders and ``_published/<number>.json``. The highest pointer that is whole says which data
folders make up the table, so a reader sees the state before a write or the state after it, and a write that fails
leaves only folders that no pointer names. One writer at a time changes a table; two that do get the same number, and the
second one fails without harm. What the last ``KEPT`` pointers do not name is deleted after a write, so that
readers who opened the table before may finish.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTERS = "_published"
KEPT = 2


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, so that any store works that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, where = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def _read(spark: SparkSession, path: str) -> dict | None:
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:  # being written, or left by a writer that died
        return None
    finally:
        stream.close()


def pointers(spark: SparkSession, table: str, most: int = 1) -> list[tuple[int, dict]]:
    """(number, state) of the latest whole pointers, latest first."""
    found = []
    for name in reversed([n for n in children(spark, f"{table}/{POINTERS}") if n.endswith(".json")]):
        state = _read(spark, f"{table}/{POINTERS}/{name}")
        if state is not None:
            found.append((int(name.removesuffix(".json")), state))
        if len(found) == most:
            break
    return found


def state_of(spark: SparkSession, table: str) -> dict:
    """What the table's latest pointer says; empty if nothing is published."""
    return next((state for _, state in pointers(spark, table)), {})


def next_number(spark: SparkSession, table: str) -> int:
    """Above every pointer, also above a broken one."""
    names = [n for n in children(spark, f"{table}/{POINTERS}") if n.endswith(".json")]
    return 1 + max((int(n.removesuffix(".json")) for n in names), default=0)


def publish(spark: SparkSession, table: str, state: dict, number: int | None = None) -> None:
    """Makes ``state`` the table's current one. ``number`` is the one the writer took at its start; if another writer
    has used it since, the file exists and this fails."""
    number = number or next_number(spark, table)
    fs, where = file_system(spark, f"{table}/{POINTERS}/{number:012d}.json")
    stream = fs.create(where, False)
    stream.write(bytearray(json.dumps(state).encode()))
    stream.close()


def tidy(spark: SparkSession, table: str, named: Iterable[str], folder: str = "") -> None:
    """Deletes the data folders below ``folder`` that are not in ``named``, and the pointers before the last ``KEPT``."""
    keep = {POINTERS, *named}
    base = f"{table}/{folder}".rstrip("/")
    for name in children(spark, base):
        if name not in keep:
            remove(spark, f"{base}/{name}")
    for name in children(spark, f"{table}/{POINTERS}")[:-KEPT]:
        remove(spark, f"{table}/{POINTERS}/{name}")


# --- whole tables and tables by date -----------------------------------------------------------------------------------


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder(version: str) -> str:
    return f"version={version}"


def _versions(spark: SparkSession, table: str) -> set[str]:
    """Data folders that the last ``KEPT`` pointers name."""
    named = {v for _, state in pointers(spark, table, KEPT) for v in (*state.get("parts", {}).values(), state.get("version")) if v}
    return {_folder(v) for v in named}


def _schema_text(df: DataFrame) -> str:
    return df.schema.json()


def save_table(df: DataFrame, table: str, partition_by: str | None = None) -> DataFrame:
    """Saves all rows as the table's next state and returns it as read back. With ``partition_by`` its values become folders, which
    ``replace_parts`` can replace one by one."""
    return _written(df, table, partition_by, None)


def replace_parts(df: DataFrame, table: str, parts: Sequence[object]) -> DataFrame:
    """Replaces the folders of the values ``parts`` by the rows of ``df``, which hold no other values; a part without rows goes.
    All other folders stay as they are. A table that does not exist yet has to be saved whole first."""
    state = state_of(df.sparkSession, table)
    if not state.get("by"):
        raise ValueError(f"{table} is not saved in parts")
    return _written(df, table, state["by"], [_label(p) for p in parts])


def _label(value: object) -> str:
    return NO_VALUE if value is None else str(value)


def _written(df: DataFrame, table: str, by: str | None, replaced: Sequence[str] | None) -> DataFrame:
    spark = df.sparkSession
    number = next_number(spark, table)
    before = state_of(spark, table)
    version = f"{number:012d}"
    folder = f"{table}/{_folder(version)}"
    if by:
        # All rows of a value in few files: one task for each value, or more where it is large.
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(folder)
        written = {n.split("=", 1)[1]: version for n in children(spark, folder) if n.startswith(f"{by}=")}
        if replaced is not None and (other := set(written) - set(replaced)):
            raise ValueError(f"rows of parts that are not to be replaced: {sorted(other)[:5]}")
        kept = {} if replaced is None else {p: v for p, v in before["parts"].items() if p not in set(replaced)}
        state = {"by": by, "parts": kept | written, "schema": _schema_text(df)}
    else:
        df.write.mode("overwrite").parquet(folder)
        state = {"version": version, "schema": _schema_text(df)}
    publish(spark, table, state, number)
    tidy(spark, table, _versions(spark, table))
    return open_table(spark, table)


def open_table(spark: SparkSession, table: str) -> DataFrame:
    """The table as last published."""
    state = state_of(spark, table)
    if not state:
        raise FileNotFoundError(f"{table} was never published")
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    if "version" in state:
        return spark.read.schema(schema).parquet(f"{table}/{_folder(state['version'])}")
    return read_parts(spark, table, schema, state["by"], state["parts"])


def read_parts(spark: SparkSession, base: str, schema: T.StructType, by: str, parts: Mapping[str, str]) -> DataFrame:
    """Rows of the folders ``version=<version>/<by>=<part>`` below ``base``, for each part and its version; Spark skips the
    folders of other versions without opening them."""
    if not parts:
        return spark.createDataFrame([], schema)
    extra = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    folders = [f"{base}/{_folder(v)}" for v in sorted(set(parts.values()))]
    rows = spark.read.schema(extra).option("basePath", base).parquet(*folders)
    named = F.concat_ws("/", "version", F.coalesce(F.col(by).cast("string"), F.lit(NO_VALUE)))
    return rows.filter(named.isin(*[f"{v}/{p}" for p, v in parts.items()])).select(*schema.names)
