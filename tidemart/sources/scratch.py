"""Folders for intermediate files."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# (application, folder) of each folder made.
_made: list[tuple[str | None, str]] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared one the cluster names in spark.checkpoint.dir.

    A session on one machine without that setting gets a temporary folder. On a cluster it is an error: executors would
    write to their own disks and readers would miss part of the rows.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if shared:
        folder = f"{shared.rstrip('/')}/tidemart-{uuid.uuid4().hex}"
    elif master == "local" or master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="tidemart-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    _made.append((getattr(spark.sparkContext, "applicationId", None), folder))
    return folder


def remove_scratch(spark: SparkSession, before: int = 0) -> None:
    """Deletes the folders this session has made after the first ``before`` ones, once their tables are no longer read."""
    conf, own = spark._jsc.hadoopConfiguration(), spark.sparkContext.applicationId
    mine = [made for made in _made[before:] if made[0] == own]
    for made in mine:
        path = spark._jvm.org.apache.hadoop.fs.Path(made[1])
        path.getFileSystem(conf).delete(path, True)
        _made.remove(made)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes what is made inside: for callers who are done with a result when they leave."""
    before = len(_made)
    try:
        yield
    finally:
        remove_scratch(spark, before)


@atexit.register
def _remove_at_exit() -> None:
    """What nobody removed goes with the driver, if its session still runs then."""
    spark = SparkSession._instantiatedSession
    if _made and spark is not None and spark._jsc is not None and spark._jsc.sc() is not None and not spark._jsc.sc().isStopped():
        remove_scratch(spark)
