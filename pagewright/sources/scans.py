"""Scans: Markdown files, page images, PDFs, JSON lines and arrays, matrices, settings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from pagewright.functions.text import PAGE_BREAK

_NAME = r"([^/]+?)(?:\.[^./]+)?$"


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """filename (without its suffix), content of every .md file, a row each."""
    own = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    return own.select(F.regexp_extract(F.url_decode("path"), _NAME, 1).alias("filename"), F.decode("content", "UTF-8").alias("content"))


def read_images(spark: SparkSession, folder: str, max_documents: int | None = None, with_content: bool = False) -> DataFrame:
    """filename, page, path of images ``<document>/<document>_<page>.<png|jpg|jpeg>``.

    A name without a page is an error.  max_documents counts folders by name, those without
    images among them, before anything else is left out.
    """
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{png,jpg,jpeg,PNG,JPG,JPEG}").load(folder)
    path = F.col("path")
    stem = F.regexp_extract(path, _NAME, 1)
    page = F.regexp_extract(stem, r"^(.+)_([0-9]+)$", 2)
    checked = F.when(page == "", F.raise_error(F.concat(F.lit("no page number in the name of "), path))).otherwise(page.cast("int"))
    own = own.select(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("filename"), checked.alias("page"), "path", *(["content"] if with_content else []))
    if max_documents is None:
        return own
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    first = sorted(s.getPath().getName() for s in listed if s.isDirectory())[:max_documents]
    return own.where(F.col("filename").isin(first)) if first else own.where("false")


def positional_pages(images: DataFrame) -> DataFrame:
    """images with page_position: their place (from 0) by page number, whatever was left out."""
    return images.withColumn("page_position", F.row_number().over(W.partitionBy("filename").orderBy("page")) - 1)


def read_pdf_pages(spark: SparkSession, folder: str, extractor: Callable[[bytes], list[str]]) -> DataFrame:
    """filename, page_index, lines, parse_status of every page that extractor finds in a PDF.

    extractor turns a file's bytes into its pages' texts; the library behind it is the
    caller's.  A file it fails on has one row with page_index null and the error.
    """
    own = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"]):
                name = Path(path).stem
                try:
                    rows += [(name, n, text.splitlines(), "ok") for n, text in enumerate(extractor(bytes(content)))]
                except Exception as error:
                    rows.append((name, None, [], f"error:{type(error).__name__}:{error}"))
            out = pd.DataFrame(rows, columns=["filename", "page_index", "lines", "parse_status"])
            out["page_index"] = out["page_index"].astype("Int32")
            yield out

    return own.mapInPandas(run, "filename string, page_index int, lines array<string>, parse_status string")


def read_pdf_markdown(spark: SparkSession, folder: str, converter: Callable[[bytes, int, int], str], page_count: Callable[[bytes], int], chunk_over: int = 80, chunk: int = 30, done: DataFrame | None = None) -> DataFrame:
    """filename, first_page, content, error: Markdown by an injected converter; files of more
    than chunk_over pages are converted chunk pages at a time, and those in done (filename)
    aren't read."""
    own = without_done(spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder), done).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"]):
                name, data = Path(path).stem, bytes(content)
                try:
                    pages = page_count(data)
                    step = chunk if pages > chunk_over else max(pages, 1)
                    for first in range(0, max(pages, 1), step):
                        rows.append((name, first, converter(data, first, min(first + step, pages)), None))
                except Exception as error:
                    rows.append((name, 0, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["filename", "first_page", "content", "error"])

    return own.mapInPandas(run, "filename string, first_page int, content string, error string")


def without_done(files: DataFrame, done: DataFrame | None) -> DataFrame:
    """Files whose names aren't in done (filename), left out before their bytes are read."""
    if done is None:
        return files
    own = files.withColumn("_name", F.regexp_extract(F.url_decode("path"), _NAME, 1))
    return own.join(done.select(F.col("filename").alias("_name")), "_name", "left_anti").drop("_name")


def joined_parts(parts: DataFrame) -> DataFrame:
    """filename, content, error of documents converted in parts: the parts in order, with page
    breaks between them, or the first error."""
    ordered = F.array_sort(F.collect_list(F.struct("first_page", "content")))
    own = parts.groupBy("filename").agg(ordered.alias("_p"), F.min("error").alias("error"))
    return own.select("filename", F.when(F.col("error").isNull(), F.array_join(F.col("_p.content"), f"\n{PAGE_BREAK}\n")).alias("content"), "error")


def render_pdf_pages(spark: SparkSession, folder: str, renderer: Callable[[bytes, int], bytes], page_count: Callable[[bytes], int], excluded: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    """filename, page, content: PNG bytes of the pages of PDFs by an injected renderer.

    excluded (filename, pages) names pages that aren't rendered; they are left out before the
    renderer sees them, and so are the documents in done (filename).
    """
    own = without_done(spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder), done).select(F.regexp_extract("path", _NAME, 1).alias("filename"), "content")
    gone = excluded.select("filename", F.col("pages").cast("array<int>").alias("pages")) if excluded is not None else spark.createDataFrame([], "filename string, pages array<int>")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content, skipped in frame.itertuples(index=False, name=None):
                data, skip = bytes(content), set() if skipped is None else set(skipped)
                for page in range(page_count(data)):  # a page at a time: images may be large
                    if page not in skip:
                        yield pd.DataFrame({"filename": [name], "page": [page], "content": [renderer(data, page)]})

    return own.join(gone, "filename", "left").select("filename", "content", "pages").mapInPandas(run, "filename string, page int, content binary")


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, and a line that is no object of the
    schema is an error that names its file."""
    corrupt = "_corrupt_record"
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    own = spark.read.schema(wide).option("columnNameOfCorruptRecord", corrupt).json(path)
    fault = F.concat(F.lit("not a JSON object in "), F.input_file_name(), F.lit(": "), F.substring(corrupt, 1, 80))
    first = schema.fields[0].name
    checked = F.when(F.col(corrupt).isNotNull(), F.raise_error(fault)).otherwise(F.col(first))
    return own.select(checked.cast(schema.fields[0].dataType).alias(first), *[F.col(f.name) for f in schema.fields[1:]])


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a file that holds one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_matrix(spark: SparkSession, path: str, rows: int | None = None, slices: int = 64) -> DataFrame:
    """ord, embedding of an .npy file on a shared file system; rows, where given, must match."""
    shape = np.load(path, mmap_mode="r").shape
    if rows is not None and shape[0] != rows:
        raise ValueError(f"{shape[0]} vectors for {rows} rows")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = np.load(path, mmap_mode="r")
        for frame in frames:
            for at in range(0, len(frame), 10_000):
                own = frame["id"].to_numpy()[at : at + 10_000]
                yield pd.DataFrame({"ord": own, "embedding": list(np.asarray(matrix[own], np.float32))})

    return spark.range(shape[0], numPartitions=min(slices, max(1, shape[0]))).mapInPandas(run, "ord bigint, embedding array<float>")


def read_settings(path: str, required: tuple[str, ...] = (), **defaults: object) -> dict[str, object]:
    """Settings of a YAML file over defaults; a missing required key is an error."""
    import yaml

    with open(path, encoding="utf-8") as file:
        own = yaml.safe_load(file) or {}
    missing = [k for k in required if k not in own]
    if missing:
        raise KeyError(f"missing settings: {missing}")
    return defaults | own


def read_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A dataset of Parquet files, or one of its splits (a subfolder)."""
    return spark.read.parquet(f"{path}/{split}" if split else path)
