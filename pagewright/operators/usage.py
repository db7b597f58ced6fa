"""Token usage of model calls: validation of counts and sums that stay unknown if any part is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_count(value: Column) -> Column:
    """A count, 0 for null and negative ones."""
    return F.greatest(F.coalesce(value.cast("bigint"), F.lit(0)), F.lit(0))


def total_or_unknown(value: Column) -> Column:
    """The sum of a column, null as soon as one value is null (unlike SQL's sum)."""
    return F.when(F.count_if(value.isNull()) == 0, F.sum(value))


def usage_rollup(calls: DataFrame, *keys: str) -> DataFrame:
    """keys, call_count, input_tokens, output_tokens, total_tokens and, where calls have a
    ``cost``, cost."""
    sums = [F.sum(valid_count(F.col(c))).alias(c) for c in ("input_tokens", "output_tokens", "total_tokens")]
    cost = [total_or_unknown(F.col("cost")).alias("cost")] if "cost" in calls.columns else []
    return calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("call_count"), *sums, *cost)
