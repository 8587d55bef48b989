"""Session settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on: UTC session zone (epoch <->
    timestamp and local-time shifts assume it), AQE with skew-join splitting.
    Partition overwrite modes are passed per write, not set globally."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "streetflow") -> SparkSession:
    """Session for tests and the bench: local mode, UI off, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STREETFLOW_DRIVER_MEMORY", "8g"))
    )
    if os.environ.get("STREETFLOW_EVENT_LOG"):  # stage timings for profiling, no UI
        spark = spark.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir",
                                                                       os.environ["STREETFLOW_EVENT_LOG"])
    spark = (
        spark.getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only when the session has none and runs on one machine (local tests) is a
    fresh local folder set; on a cluster its executors would each write to their
    own disks, so there a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if current:
        return current
    if not re.fullmatch(r"local(\[[^,\]]*(,\s*\d+)?\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="streetflow-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Rows that are few and small but expand, dealt to as many tasks as shuffles
    have: AQE goes by their size as they are and would give them to one."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for staged tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
