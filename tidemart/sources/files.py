"""Batch file sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.headers import read_by_header
from tidemart.sources.published import save_table


def files_below(spark: SparkSession, path: str) -> list[str]:
    """All files of a folder and its sub-folders; one short row per file reaches the driver."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return sorted(r["path"] for r in found.load(path).select("path").collect())
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # nothing has landed yet


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    columns: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header, columns by each file's own one. Without a schema the types are inferred, which reads the files
    twice and takes all files to have the same header."""
    if not schema:
        df = spark.read.option("header", True).options(**(options or {})).option("inferSchema", True).csv(path)
        return df.select(*columns) if columns else df
    df, _ = read_by_header(spark, files_below(spark, path), schema, options)
    return df.select(*(columns or T.StructType.fromDDL(schema).names))


def write_json(
    df: DataFrame,
    path: str,
    files: int,
    by: str | None = None,
    spread_by: Sequence[str] = (),
    max_records: int = 0,
    compression: str = "none",
) -> None:
    """JSON files of bounded length, clustered by ``by``.

    Clustering by one column alone puts a frequent value into one task, so ``spread_by`` (columns that tell rows
    apart) also takes part: a value then covers up to ``files`` tasks.
    """
    if by is None:
        spread = df.repartition(files)
    elif spread_by:
        piece = F.pmod(F.xxhash64(*spread_by), F.lit(files))
        spread = df.repartition(files, F.col(by), piece)
    else:
        spread = df.repartition(files, by)
    spread.write.mode("overwrite").option("maxRecordsPerFile", max_records).json(path, compression=compression)


def materialize(df: DataFrame, warehouse: str, name: str, partition_by: str | None = None) -> DataFrame:
    """Saves a dataset under its name and returns it as read back, so later plans start from the files. Who reads the dataset
    meanwhile keeps the state before."""
    return save_table(df, f"{warehouse}/{name}", partition_by)
