"""Windows of pages: sliding, tumbling, capped, and the first pages of a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions.order import running_totals


def page_lists(pages: DataFrame, page: str = "page_index") -> DataFrame:
    """filename and its sorted pages."""
    return pages.groupBy("filename").agg(F.sort_array(F.collect_list(page)).alias("pages"))


def sliding_windows(documents: DataFrame, size: int, stride: int) -> DataFrame:
    """filename, window (from 0), page_numbers: slices of ``pages`` at every stride; the short
    ones at the end are kept, and a document without pages has none."""
    if size < 1 or stride < 1:
        raise ValueError("size and stride must be positive")
    some = documents.where(F.size("pages") > 0)
    slices = F.transform(F.sequence(F.lit(0), F.size("pages") - 1, F.lit(stride)), lambda s: F.slice("pages", s + 1, F.lit(size)))
    return some.select("filename", F.posexplode(slices).alias("window", "page_numbers"))


def tumbling_windows(documents: DataFrame, size: int = 5) -> DataFrame:
    """Windows that don't overlap."""
    return sliding_windows(documents, size, size)


def capped_windows(windows: DataFrame, per_document: int | None = None, in_all: int | None = None) -> DataFrame:
    """The first per_document windows of each document, and of these the first in_all in order
    of documents; None means no bound.

    The total bound needs a running number over documents, which comes from the sums of ranges
    of documents; at most the first in_all documents can have a part in it.
    """
    own = windows
    if per_document is not None:
        own = own.where(F.col("window") < per_document)
    if in_all is None:
        return own
    first = own.groupBy("filename").agg(F.count(F.lit(1)).alias("_n")).orderBy("filename").limit(in_all)
    before = running_totals(first, "filename", "_n", "_before").select("filename", "_before")
    return own.join(F.broadcast(before) if in_all <= 100_000 else before, "filename").where(F.col("_before") + F.col("window") < in_all).drop("_before")


def description_sample(documents: DataFrame, most: int = 3) -> DataFrame:
    """The first pages of each document."""
    return documents.select("filename", F.slice("pages", 1, most).alias("pages"))
