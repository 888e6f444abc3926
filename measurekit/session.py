"""Session defaults shared by the bench, the tests and the entry functions."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "measurekit", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for development; on a cluster pass the cluster's own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names, else one in its warehouse; a temporary one only on a single machine.

    A warehouse on a machine's own disk is not shared: on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="measurekit-checkpoint-")
    elif not folder:
        folder = shared_warehouse(spark.conf.get("spark.sql.warehouse.dir"))
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_warehouse(warehouse: str) -> str:
    if warehouse.startswith("file:") or "://" not in warehouse:
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: the warehouse {warehouse} is a machine's own")
    return f"{warehouse}/measurekit"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read back from there.

    Multi-step jobs call this after ingest and after preparation: later steps
    plan against stored rows, generated row ids are fixed for good, and a lost executor costs a
    re-read instead of a recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/measurekit-{name}-{uuid.uuid4().hex}"
