"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and the bench. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tideline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    # Only a session with its own driver gets here; a remote client names the folder.
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call was given."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """Create a database whose managed tables live under the shared folder."""
    name = f"tideline_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(spark, name)}'")
    return name
