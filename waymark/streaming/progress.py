"""Progress and resume state as Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import tables


def finished(spark: SparkSession, folder: str, schema: StructType | str, files: int = 1000, pattern: str | None = None) -> DataFrame:
    """Files that arrive in ``folder``, at most ``files`` in a batch; only names that fit ``pattern``, if given."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(folder)


def progress_stream(done: DataFrame, paths: Column, seconds: Column) -> DataFrame:
    """Running totals of finished jobs, one row."""
    return done.agg(F.count("*").alias("jobs"), F.sum(paths).alias("paths"), F.round(F.sum(seconds), 6).alias("seconds"))


def resume_stream(log: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """(keys, state): completed is sticky, whatever the order of lines."""
    good = F.bool_or(F.col(status) == "SUCCESS")
    return log.where(F.col(status).isin("SUCCESS", "FAILED")).groupBy(*keys).agg(F.when(good, "completed").otherwise("failed").alias("state"))


def windowed_progress(done: DataFrame, time: str, late: str, width: str, seconds: Column) -> DataFrame:
    """Jobs and seconds for each window of event time; rows later than ``late`` are left out."""
    return done.withWatermark(time, late).groupBy(F.window(time, width)).agg(F.count("*").alias("jobs"), F.sum(seconds).alias("seconds"))


def drain(df: DataFrame, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Run a stream over what is there now; a reader of the resulting table.

    Every batch is written as Parquet in the shared folder, not gathered on the
    driver: in mode ``complete`` the last one is the result, else all together.
    """
    spark = df.sparkSession
    folder = f"{tables.shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    batches: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{number}")
        batches.append(number)

    writer = df.writeStream.outputMode(mode).foreachBatch(write).trigger(availableNow=True)
    writer.option("checkpointLocation", checkpoint or f"{folder}/checkpoint").start().awaitTermination()
    if not batches:
        return spark.createDataFrame([], df.schema)
    found = batches[-1:] if mode == "complete" else batches
    return spark.read.schema(df.schema).parquet(*(f"{folder}/{k}" for k in found))


def snapshots(df: DataFrame, path: str, checkpoint: str):
    """Start a stream that rewrites the folder ``path`` with the whole state, as JSON lines, after every batch."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").json(path)

    return df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
