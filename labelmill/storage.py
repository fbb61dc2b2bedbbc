"""Shared folder for stage tables that cut lineage and outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder that ``spark.checkpoint.dir`` names.

    Only a local session may go without the setting; it gets a folder of its own.
    On a cluster a machine-local folder would be lost with the machine. The setting
    itself is never changed.
    """
    app = spark.sparkContext.applicationId
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = _local.setdefault(app, tempfile.mkdtemp(prefix="labelmill-"))
    return f"{folder.rstrip('/')}/{app}"


def clear_stages(spark: SparkSession) -> None:
    """Delete what this application staged; tables that rest on it cannot be read any more."""
    jvm, folder = spark.sparkContext._jvm, shared_folder(spark)
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stage``, with aggregates of the rows taken while they are written: no pass of their own.

    The metrics are the last step of the written plan, whose tasks are counted once each,
    also if one has to run again.
    """
    seen = Observation()
    out = stage(df.observe(seen, *[m.alias(n) for n, m in metrics.items()]), name)
    return out, seen.get
