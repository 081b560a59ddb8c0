"""Writes landing files from bronze tables: the counterpart of ingest, for replays and for checking it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.plans.prep import EVENT_TIME_FORMAT
from tidemart.sources.files import write_json
from tidemart.sources.headers import CORRUPT

# Files and rows per file of a landing run.
WEB_FILES, WEB_RECORDS = 16, 200_000
ADS_FILES, ADS_RECORDS = 4, 50_000
# JSON repeats its names in every line. A packed file is read by one task, which the records per file keep small.
PACKED = "gzip"

AUDIT = ("ingestion_time", "source_file", "source_api", CORRUPT)


def tasks_for(df: DataFrame, least: int) -> int:
    """Number of writing tasks: the fixed one, or more on a cluster that deals its shuffles over more. Files are bounded by
    their number of records, so nothing has to be counted."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def land_csv(df: DataFrame, landing: str, name: str) -> None:
    """Columns in the order of ``df``; readers go by the header."""
    # Keep surrounding blanks and tell an empty text from a missing one.
    writer = df.drop(*AUDIT).write.mode("append").option("header", True).option("nullValue", "\\N")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/{name}")


CSV_READ_OPTIONS = {"nullValue": "\\N"}


def land_web(df: DataFrame, landing: str, run: str) -> None:
    """One run folder of web events, clustered by campaign."""
    text = df.drop(*AUDIT).withColumn("event_time", F.date_format("event_time", EVENT_TIME_FORMAT))
    files = tasks_for(df, WEB_FILES)
    write_json(text, f"{landing}/web_events/{run}", files, "campaign_id", ["event_id"], WEB_RECORDS, PACKED)


def land_ads(df: DataFrame, landing: str, run: str) -> None:
    files = tasks_for(df, ADS_FILES)
    write_json(df.drop(*AUDIT), f"{landing}/api_ads_raw/{run}", files, max_records=ADS_RECORDS, compression=PACKED)
