"""Session helpers: the shared scratch folder and a session for tests and timings."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session (tests, timings) may
    fall back to a folder of this machine; anywhere else a missing setting is an error, because
    executors on other hosts could neither write nor read such a folder.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named is not None:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattframe-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`checkpoint_root`; nothing is created or deleted."""
    return f"{checkpoint_root(spark).rstrip('/')}/wattframe/{label}-{uuid.uuid4().hex}"


def keep(table: DataFrame) -> DataFrame:
    """The table computed once and written to the shared folder, with its lineage cut there.

    Lost executors cost a re-read, not a recomputation. Being Parquet, the copy is read by column
    and its size is known to the optimizer.
    """
    path = scratch_path(table.sparkSession, "kept")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def local_session(cpus: int | str = 8, **settings: str) -> SparkSession:
    """Session for tests and timings on one machine; cluster users bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wattframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
