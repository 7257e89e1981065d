"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one is set only in local mode where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back: later jobs, and retries after a lost executor, start there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._gridloom_path = path
    return out


def cut_and_sum(df: DataFrame, *totals: Column) -> tuple[DataFrame, dict]:
    """`cut` and aggregates of its rows, taken while they are written."""
    seen = Observation()
    return cut(df.observe(seen, *totals)), seen.get


def forget(*cuts: DataFrame) -> None:
    """Deletes tables made by `cut` that no later job reads."""
    for df in cuts:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._gridloom_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
