"""Running totals over a whole table, without a window that spans it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.session import reliable_checkpoint


def running_totals(sizes: DataFrame, key: str, count: str, name: str = "before") -> DataFrame:
    """sizes with the sum of count over all rows with a smaller key.

    Rows are range-partitioned by key and checkpointed, since ranges are drawn from a sample
    and must not change; the driver sees one sum per partition.
    """
    ranged = reliable_checkpoint(sizes.repartitionByRange(key).withColumn("_part", F.spark_partition_id()))
    sums = {r["_part"]: r["s"] for r in ranged.groupBy("_part").agg(F.sum(count).alias("s")).collect()}
    starts, total = [], 0
    for part in sorted(sums):
        starts.append((part, total))
        total += sums[part]
    offsets = sizes.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    inner = F.sum(count).over(W.partitionBy("_part").orderBy(key).rowsBetween(W.unboundedPreceding, 0)) - F.col(count)
    return ranged.withColumn("_inner", inner).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_inner") + F.col("_start")).drop("_part", "_inner", "_start")
