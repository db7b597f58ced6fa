"""Stage tables: a stage that was written is read, not computed again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def written(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is at path, by the marker that its commit leaves."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """The table at path, built and written first where it isn't there or overwrite is set; one
    that broke off is built again."""
    if overwrite or not written(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
