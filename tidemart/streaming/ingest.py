"""Incremental ingest: new landing files only, then stop.

CSV sources are appended, each file by its own header. JSON sources are upserted into tables laid out by key bucket
(``upserts.py``). A late row updates its key at any age, so there is no watermark. Every micro-batch has its own folder, which a
pointer names once it is whole; a batch that runs again rewrites its folder, so a restart after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.latest import keep_latest
from tidemart.plans.prep import EVENT_TIME_FORMAT
from tidemart.schemas import ADS_JSON, BRONZE_ADS, BRONZE_WEB_EVENTS, CSV_SOURCES, WEB_EVENTS_JSON
from tidemart.sources.headers import CORRUPT, read_by_header
from tidemart.sources.published import next_number, publish, state_of
from tidemart.streaming.upserts import MOST_DELTAS, merge_deltas, read_upserts, write_delta

# Columns some file sources add for values they could not place.
RESCUE_COLUMNS = ("_rescued_data", "source_folder")

# Folder and age of a row's file, while a batch is reduced to one row per key. The files of a folder are one landing run.
RUN = "_landing_run"

# What a file source of Spark gives for files it does not look into.
FILE_LIST = "path string, modificationTime timestamp, length bigint, content binary"
# Files of one micro-batch, unless an option says otherwise; their headers are read one by one.
FILES_PER_BATCH = "1000"

WEB_KEYS = ("event_id",)
ADS_KEYS = ("date", "campaign_id")


def stream_files(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """Paths of new files, in any sub-folder; contents are not read. Options of a file stream apply, such as
    maxFilesPerTrigger, or cleanSource to move files away that are done."""
    reader = spark.readStream.format("binaryFile").schema(FILE_LIST).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return reader.options(**(options or {})).option("recursiveFileLookup", True).load(path).select("path")


def stream_json(spark: SparkSession, path: str, schema: str, options: dict[str, str] | None = None) -> DataFrame:
    """New JSON-lines files, in any sub-folder: each landing run writes its own."""
    reader = spark.readStream.format("json").schema(f"{schema}, {CORRUPT} string").options(**(options or {}))
    return reader.option("recursiveFileLookup", True).load(path)


def with_audit(df: DataFrame, source_api: str | None = None) -> DataFrame:
    """Ingest time, and the file a row came from or the name of the API that sent it."""
    origin: dict[str, Column] = (
        {"source_file": F.col("_metadata.file_path")} if source_api is None else {"source_api": F.lit(source_api)}
    )
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/", 1)
    return df.withColumns({"ingestion_time": F.current_timestamp(), **origin, RUN: F.struct(folder.alias("folder"), "_metadata.file_modification_time")})


def parse_web(raw: DataFrame) -> DataFrame:
    """Typed web rows. The Z in the event time is a literal, so the session time zone (UTC) applies."""
    time = F.try_to_timestamp("event_time", F.lit(EVENT_TIME_FORMAT))
    return with_audit(raw).withColumn("event_time", time)


def parse_ads(raw: DataFrame, source_api: str = "ads_api") -> DataFrame:
    return with_audit(raw, source_api).withColumn("date", F.col("date").try_cast("date"))


def as_table(df: DataFrame, ddl: str, also: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns and types of a typed bronze table, and the columns named in ``also``."""
    schema = T.StructType.fromDDL(ddl)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *also)


def csv_batch_writer(table: str, schema: str, options: dict[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """Appends the rows of a micro-batch's files. The table's pointer keeps the batches and, in the order they were met,
    the columns that nobody declared."""

    def write(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        number, state = next_number(spark, table), state_of(spark, table) or {"batches": [], "extras": []}
        paths = sorted(r["path"] for r in files.collect())  # bounded by maxFilesPerTrigger
        rows, extras = read_by_header(spark, paths, schema, options, state["extras"])
        rows = with_audit(rows.drop(*RESCUE_COLUMNS)).drop(RUN, "_metadata")
        rows.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        extras = [e for e in extras if e not in RESCUE_COLUMNS]
        publish(spark, table, {"batches": sorted({*state["batches"], batch_id}), "extras": extras}, number)

    return write


def append_csv(stream: DataFrame, table: str, checkpoint: str, schema: str, options: dict[str, str] | None = None) -> StreamingQuery:
    """Appends what is new and stops. A batch is part of the table once its pointer names it, so it counts once."""
    writer = stream.writeStream.foreachBatch(csv_batch_writer(table, schema, options))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_appended(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All appended rows: declared columns, undeclared ones as text (null in batches before them), and the audit columns."""
    state = state_of(spark, table) or {"batches": [], "extras": []}
    extras = [T.StructField(e, T.StringType()) for e in state["extras"]]
    audit = T.StructType.fromDDL(f"{CORRUPT} string, ingestion_time timestamp, source_file string").fields
    full = T.StructType([*T.StructType.fromDDL(schema).fields, *extras, *audit])
    if not state["batches"]:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(*[f"{table}/batch_id={n}" for n in state["batches"]])


def _newest_run(rows: DataFrame) -> DataFrame:
    """Replaces the run by its age: when the last of its files was written, then its folder. A batch has few folders."""
    folder = F.col(f"{RUN}.folder")
    ages = rows.groupBy(folder.alias("_folder")).agg(F.max(f"{RUN}.file_modification_time").alias("_age"))
    aged = rows.join(F.broadcast(ages), folder == F.col("_folder"))
    return aged.withColumn(RUN, F.struct("_age", "_folder")).drop("_age", "_folder")


def batch_writer(table: str, keys: Sequence[str], buckets: int = 0) -> Callable[[DataFrame, int], None]:
    """Writes one micro-batch: rows without a full key are dropped, and one row per key is kept, that of the landing run
    written last, whatever its folder is called. Lines that could not be read go to a log of their own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch
            if CORRUPT in batch.columns:
                unreadable = batch.filter(F.col(CORRUPT).isNotNull()).drop(RUN)
                unreadable.write.mode("overwrite").parquet(f"{table}_unreadable/batch_id={batch_id}")
                rows = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            rows = _newest_run(rows) if RUN in rows.columns else rows
            newest = [c for c in (RUN, "ingestion_time") if c in batch.columns]
            one_per_key = keep_latest(rows.dropna(subset=list(keys)), keys, newest).drop(RUN)
            write_delta(one_per_key, table, batch_id, keys, buckets)
        finally:
            batch.unpersist()

    return write


def upsert_log(stream: DataFrame, log: str, checkpoint: str, keys: Sequence[str]) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch_writer(log, keys)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def ingest_csv_sources(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoints: str,
    sources: Sequence[str] = tuple(CSV_SOURCES),
    options: dict[str, str] | None = None,
) -> None:
    """All CSV sources side by side: every stream is started before the first is awaited."""
    running = [
        append_csv(
            stream_files(spark, f"{landing}/{name}", options),
            f"{bronze}/bronze_{name}",
            f"{checkpoints}/{name}",
            CSV_SOURCES[name],
            options,
        )
        for name in sources
    ]
    for query in running:
        query.awaitTermination()


def _ingest_keyed(typed: DataFrame, table: str, checkpoint: str, keys: Sequence[str], ddl: str) -> DataFrame:
    spark = typed.sparkSession
    upsert_log(as_table(typed, ddl, (RUN, CORRUPT)), table, checkpoint, keys).awaitTermination()
    merge_deltas(spark, table, MOST_DELTAS)
    return read_keyed(spark, table, ddl)


def read_keyed(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    """The upserted table; without rows if nothing was ever ingested."""
    return read_upserts(spark, table) if state_of(spark, table) else spark.createDataFrame([], ddl)


def ingest_web_events(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, options: dict[str, str] | None = None
) -> DataFrame:
    """``options`` such as maxFilesPerTrigger or maxBytesPerTrigger bound the micro-batches of a long backlog."""
    raw = stream_json(spark, f"{landing}/web_events", WEB_EVENTS_JSON, options)
    return _ingest_keyed(parse_web(raw), f"{bronze}/bronze_web_events", f"{checkpoints}/web_events", WEB_KEYS, BRONZE_WEB_EVENTS)


def ingest_ads(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, options: dict[str, str] | None = None
) -> DataFrame:
    raw = stream_json(spark, f"{landing}/api_ads_raw", ADS_JSON, options)
    return _ingest_keyed(parse_ads(raw), f"{bronze}/bronze_ads_campaigns", f"{checkpoints}/ads", ADS_KEYS, BRONZE_ADS)


def bronze_reader(spark: SparkSession, bronze: str, prefix: str = "") -> Callable[[str], DataFrame]:
    """Bronze tables by name (without ``prefix``), as ingested by the functions above, without unreadable rows."""
    keyed = {"bronze_web_events": BRONZE_WEB_EVENTS, "bronze_ads_campaigns": BRONZE_ADS}

    def read(name: str) -> DataFrame:
        name = prefix + name
        if name in keyed:
            return read_keyed(spark, f"{bronze}/{name}", keyed[name])
        rows = read_appended(spark, f"{bronze}/{name}", CSV_SOURCES[name.removeprefix("bronze_")])
        return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)

    return read
