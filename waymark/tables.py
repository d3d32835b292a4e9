"""Intermediate tables in the cluster's shared folder.

A table that several jobs read is written once as Parquet below
``spark.checkpoint.dir``; a lost executor then costs only the tasks it ran,
because nothing depends on blocks that lived on it. What is written also has
fixed partitions, whatever a second run of the same plan would sample.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_own: dict[str, str] = {}
_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, a temporary folder of
    our own in local mode, and an error on a cluster, whose machines share no such folder."""
    context = spark.sparkContext
    where = context.getConf().get("spark.checkpoint.dir", None) or _own.get(context.applicationId)
    if not where:
        if context.master.startswith("local") and not context.master.startswith("local-cluster"):
            where = "file://" + tempfile.mkdtemp(prefix="waymark-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own[context.applicationId] = where
    return where.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and return a reader of what was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    found = spark.read.schema(df.schema).parquet(path)
    _places[found] = path
    return found


def discard(df: DataFrame) -> None:
    """Delete what ``table`` wrote for ``df``, once nothing that is still to run reads it."""
    path = _places.pop(df, None)
    if path is not None:
        _written.remove((df.sparkSession, path))
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear() -> None:
    """Delete every table written so far; results that still read them become invalid."""
    while _written:
        spark, path = _written.pop()
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


@atexit.register
def _clear_at_exit() -> None:
    try:
        clear()
    except Exception:  # the JVM may be gone by now
        _written.clear()
