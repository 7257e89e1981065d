"""Changed labels from a log of mutations: (ts, action, ids).

Delivery is at least once: a batch may come again after a failure, and what is made already is left out by an anti-join, so
a repeat does nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = "ts timestamp_ntz, action string, ids array<long>"


def changed_labels(log: DataFrame, since: str | None = None, exclude: DataFrame | None = None, made: DataFrame | None = None) -> DataFrame:
    """(label): distinct ids of completed mutations at or after a time, less those excluded or made."""
    rows = log.where(F.col("action") != "error") if since is None else log.where((F.col("action") != "error") & (F.col("ts") >= F.to_timestamp_ntz(F.lit(since))))
    out = rows.select(F.explode("ids").alias("label")).distinct()
    for other in (exclude, made):
        if other is not None:
            out = out.join(other.select("label").distinct(), "label", "left_anti")
    return out


def follow(spark: SparkSession, path: str, checkpoint: str, launch: Callable[[DataFrame, int], None], since: str | None = None, exclude: DataFrame | None = None, every: str | None = None) -> StreamingQuery:
    """Reads a folder of Parquet logs as it grows and gives each batch's changed labels to `launch`; without `every`, it takes what is there and ends."""
    log = spark.readStream.schema(LOG).parquet(path)

    def batch(df: DataFrame, number: int) -> None:
        changed = changed_labels(df, since, exclude)
        if not changed.isEmpty():
            launch(changed, number)

    writer = log.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def activity(log: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Mutations in each window of event time by action; a stream gives windows once they are older than `late`."""
    timed = log.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if log.isStreaming else timed
    return timed.groupBy(F.window("ts", window).alias("w"), "action").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "action", "n")


def sessions(log: DataFrame, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each key: successive rows no further apart than the gap."""
    timed = log.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if log.isStreaming else timed
    return timed.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")
