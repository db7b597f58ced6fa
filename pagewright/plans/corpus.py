"""Inputs of the registered queries, made from the test tables by fixed rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, ShortType

from pagewright.functions.text import hash_integer, split_lines
from pagewright.operators.selection import CRITERIA


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def flat(df: DataFrame) -> DataFrame:
    """Arrays as text and whole numbers as BIGINT, for comparison with SQL."""

    def text(column: Column, kind: ArrayType) -> Column:
        if isinstance(kind.elementType, ArrayType):
            inner = F.transform(column, lambda x: text(x, kind.elementType))
            return F.array_join(inner, ";")
        return F.array_join(column.cast("array<string>"), ",")

    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, ArrayType):
            column = text(column, field.dataType)
        elif isinstance(field.dataType, (IntegerType, ShortType)):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def derived_pages(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, filename, page_index, total_pages, lines: each text is a page of its source.

    Lines of some pages are rewritten by doc_id into entries and titles of tables of contents.
    Ranks are computed over ids alone, so that a source with many texts moves no text.
    """
    documents = read(spark, folder, "documents")
    own = W.partitionBy("source")
    ranks = documents.select("doc_id", "source").select(
        "doc_id", F.col("source").alias("filename"), (F.row_number().over(own.orderBy("doc_id")) - 1).alias("page_index"), F.count(F.lit(1)).over(own).alias("total_pages"))
    texts = documents.select("doc_id", F.coalesce(split_lines(F.col("text")), F.array().cast("array<string>")).alias("raw"))
    entry = F.transform("raw", lambda x, i: F.concat(F.substring(x, 1, 40), F.repeat(F.lit("."), i % 3 * 2), F.lit(" "), (i + 1).cast("string")))
    numbered = F.transform("raw", lambda x, i: F.concat((i + 1).cast("string"), F.lit(".1 "), x))
    lines = F.when(F.col("doc_id") % 7 == 0, entry).when(F.col("doc_id") % 7 == 1, numbered).otherwise(F.col("raw"))
    lines = F.when(F.col("doc_id") % 14 == 0, F.concat(F.array(F.lit("Table of contents")), lines)).otherwise(lines)
    return ranks.join(texts.select("doc_id", lines.alias("lines")), "doc_id")


def md_documents(spark: SparkSession, folder: str) -> DataFrame:
    """id, filename, content of each document once, copies left out by a choice of the latest
    parsed one (then the smallest file name)."""
    own = read(spark, folder, "md_documents").where("content is not null")
    best = F.max_by(F.struct("filename", "content"), F.struct("parsed_at", "filename"))
    return own.groupBy("id").agg(best.alias("b")).select("id", "b.filename", "b.content")


def sections(spark: SparkSession, folder: str) -> DataFrame:
    """id, filename, section, page_numbers of each section once."""
    own = read(spark, folder, "sections").select("id", "filename", "section", "page_numbers")
    return own.groupBy("id").agg(F.min(F.struct("filename", "section", "page_numbers")).alias("b")).select("id", "b.*")


def to_judge(spark: SparkSession, folder: str) -> DataFrame:
    """Queries to judge, each id once (the earliest ingested), with ord."""
    own = read(spark, folder, "queries_to_judge")
    names = ["query", "summary", "supposed_query_type", "supposed_query_format", "filenames", "page_numbers"]
    best = F.min_by(F.struct(*names), "ingested_at")
    return own.groupBy("qtj_id").agg(best.alias("b")).select(F.col("qtj_id").alias("ord"), "qtj_id", "b.*")


def grade(criterion: str, key: str = "qtj_id") -> Column:
    """A grade from 1 to 5 that depends on key and criterion."""
    return (hash_integer(F.col(key), criterion) % 5 + 1).cast("int").alias(criterion)


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates with four grades and the columns that tell combined ones from single ones."""
    own = to_judge(spark, folder)
    originals = F.when(F.col("qtj_id") % 11 == 0, F.array("summary"))
    return own.select("*", originals.alias("original_summaries"), F.lit(None).cast("string").alias("addition_reason"), *[grade(c) for c in CRITERIA])


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "embeddings")
