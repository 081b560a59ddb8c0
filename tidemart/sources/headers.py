"""CSV files whose columns go by each file's own header.

Spark's reader takes columns by position, so the files of one source are read in groups of equal headers: the first line
of every file is read on its own (a few hundred bytes per file, side by side), and each group gets the declared types in the order
of its header. Columns nobody declared are text; they are added to the result under their own names, null in files without them.
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.published import file_system

CORRUPT = "_corrupt_record"
log = logging.getLogger(__name__)
#: Files whose first lines are read at the same time.
READERS = 16
#: A header is among the first lines of a file; lines without any character are skipped, as Spark does.
BLANK_LINES = 100


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    """The first line that is not blank, also of a compressed file; empty for a file without one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, where = file_system(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    raw = fs.open(where)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw, encoding))
    try:
        for _ in range(BLANK_LINES):
            line = reader.readLine()
            if line is None:
                return ""
            if line.strip("﻿ \t\r"):
                return line.strip("﻿\r")
        return ""
    finally:
        reader.close()


def header_of(line: str, options: Mapping[str, str]) -> tuple[str, ...]:
    """Column names of a header line: without surrounding blanks; a missing or repeated name gets its position."""
    sign = options.get("sep") or options.get("delimiter") or ","
    if len(sign) > 1:
        cells = line.split(sign)
    else:
        cells = next(csv.reader([line], delimiter=sign, quotechar=options.get("quote") or '"', escapechar=options.get("escape")), [])
    names: list[str] = []
    for i, cell in enumerate(c.strip() for c in cells):
        name = cell or f"_c{i}"
        names.append(f"{name}_{i}" if name.lower() in (n.lower() for n in names) else name)
    return tuple(names)


def headers(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header; files without any line are left out."""
    encoding = options.get("encoding") or options.get("charset") or "UTF-8"
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda p: _first_line(spark, p, encoding), paths))
    found = defaultdict(list)
    for path, line in zip(paths, lines):
        if line:
            found[header_of(line, options)].append(path)
    return dict(found)


def new_columns(names: Sequence[str], declared: T.StructType, known: Sequence[str]) -> list[str]:
    """Names of a header that are neither declared nor known yet; case does not tell columns apart."""
    seen = {f.name.lower() for f in declared.fields} | {n.lower() for n in known}
    return [n for n in names if n.lower() not in seen]


def _of_group(spark: SparkSession, names: Sequence[str], paths: list[str], declared: T.StructType, extras: Sequence[str], options: Mapping[str, str]) -> DataFrame:
    types = {f.name.lower(): f for f in declared.fields}
    text = {e.lower(): T.StructField(e, T.StringType()) for e in extras}
    in_file = [types.get(n.lower()) or text[n.lower()] for n in names]
    schema = T.StructType([*in_file, T.StructField(CORRUPT, T.StringType())])
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]  # names are no patterns
    df = spark.read.schema(schema).options(**options).option("header", True).option("enforceSchema", True).csv(plain)
    have = {f.name for f in in_file}
    wanted = [*declared.fields, *text.values()]
    columns = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted]
    return df.select(*columns, CORRUPT, "_metadata")


def read_by_header(
    spark: SparkSession, paths: Sequence[str], schema: str, options: Mapping[str, str] | None = None, known: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Rows of the files, and the undeclared columns: those in ``known`` first, then new ones in the order they are met.

    The frame has the declared columns, the undeclared ones as text, the text of rows that cannot be placed, and the
    files' metadata. Two files may name their columns in any order.
    """
    options, declared, extras = dict(options or {}), T.StructType.fromDDL(schema), list(known)
    groups = headers(spark, paths, options)
    for names in sorted(groups):
        for name in new_columns(names, declared, extras):
            log.warning("%s has a new column %s", groups[names][0], name)
            extras.append(name)
    parts = [_of_group(spark, names, groups[names], declared, extras, options) for names in sorted(groups)]
    if not parts:
        fields = [*declared.fields, *[T.StructField(e, T.StringType()) for e in (*extras, CORRUPT)]]
        empty = spark.createDataFrame([], T.StructType(fields))
        return empty.withColumn("_metadata", F.struct(F.lit("").alias("file_path"))), extras
    return reduce(DataFrame.unionAll, parts), extras
