"""Comparisons of document listings, statistics per document, file names after normalising."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions.text import normalize_filename, split_pages


def missing_on_either_side(left: DataFrame, right: DataFrame, key: str = "filename") -> DataFrame:
    """key, side: keys of one listing only; both have the same keys if this is empty."""
    both = left.select(key).distinct().withColumn("_l", F.lit(True)).join(right.select(key).distinct().withColumn("_r", F.lit(True)), key, "full_outer")
    return both.where("_l is null or _r is null").select(key, F.when(F.col("_l").isNull(), "right").otherwise("left").alias("side"))


def page_count_mismatch(left: DataFrame, right: DataFrame, key: str = "filename") -> DataFrame:
    """key, left_pages, right_pages of the documents in both with different numbers of pages."""
    joined = left.select(key, F.col("pages").alias("left_pages")).join(right.select(key, F.col("pages").alias("right_pages")), key)
    return joined.where("left_pages <> right_pages")


def page_counts(documents: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """key, pages: pages by page-break comments; null content has none."""
    return documents.select(key, F.when(F.col(content).isNull(), 0).otherwise(F.size(split_pages(F.col(content)))).alias("pages"))


def corpus_stats(documents: DataFrame, sections: DataFrame, summaries: DataFrame, key: str = "filename") -> DataFrame:
    """key, pages, sections, summaries of each document; 0 where there is none."""
    own = documents.select(key, "pages")
    for name, table in (("sections", sections), ("summaries", summaries)):
        own = own.join(table.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left")
    return own.select(key, "pages", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("sections", "summaries")])


def normalized_names(files: DataFrame, name: str = "filename") -> DataFrame:
    """name, normalized, clash: whether another file gets the same normalised name."""
    own = files.select(name).distinct().withColumn("normalized", normalize_filename(F.col(name)))
    clashes = own.groupBy("normalized").agg((F.count(F.lit(1)) > 1).alias("clash"))
    return own.join(clashes, "normalized").select(name, "normalized", "clash")
