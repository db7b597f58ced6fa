"""Session settings shared by tests, bench and command line."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators are tested under."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pagewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of df by a reliable checkpoint in the shared folder of the cluster.

    The folder is the session's own ``spark.checkpoint.dir``; a folder is chosen here only
    where that is unset, as in local tests.  Spark removes checkpoints that nothing refers to
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = os.path.join(tempfile.gettempdir(), "pagewright-checkpoints")
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines don't share that folder, install the package or ship it with
    ``--py-files`` instead.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
