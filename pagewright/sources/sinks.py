"""Sinks: JSON lines, CSV, JSON arrays, files by document, the usage log, vectors."""

from __future__ import annotations

import html
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.text import PAGE_BREAK

_NESTED = ("array", "map", "struct")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def flat_cells(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, nulls as empty text."""
    cells = [F.to_json(c) if df.schema[c].dataType.typeName() in _NESTED else F.col(c).cast("string") for c in df.columns]
    return df.select(*[F.coalesce(x, F.lit("")).alias(c) for c, x in zip(df.columns, cells)])


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    """CSV with a header; columns that df lacks are empty."""
    own = df
    for name in columns or ():
        if name not in own.columns:
            own = own.withColumn(name, F.lit(None).cast("string"))
    flat_cells(own.select(*(columns or own.columns))).write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop URI or plain path."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def _listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, whether a folder) of what is in a folder; nothing where there is none."""
    files, own = _hadoop(spark, path)
    return [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(own)] if files.exists(own) else []


def folders(spark: SparkSession, path: str) -> DataFrame:
    """filename: the folders within a folder."""
    return spark.createDataFrame([(n,) for n, folder in _listed(spark, path) if folder], "filename string")


def stems(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """filename: the files within a folder that end with suffix, without it."""
    return spark.createDataFrame([(n.removesuffix(suffix),) for n, folder in _listed(spark, path) if not folder and n.endswith(suffix)], "filename string")


def rename_files(spark: SparkSession, path: str, names: dict[str, str], suffix: str) -> int:
    """Rename files of a folder, given without their suffix; one that can't be is an error."""
    files, root = _hadoop(spark, path)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for old, new in names.items():
        if not files.rename(make(root, old + suffix), make(root, new + suffix)):
            raise OSError(f"can't rename {old}{suffix} to {new}{suffix}")
    return len(names)


def write_json_array(df: DataFrame, path: str, most: int = 100_000) -> None:
    """One file with one JSON array, for results that people read; more than most rows are an
    error, since they pass through the driver.  The file appears whole or not at all, on any
    Hadoop file system."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for one JSON array")
    spark = df.sparkSession
    files, target = _hadoop(spark, path)
    beside = target.suffix(".part")
    out = files.create(beside, True)
    out.write(bytearray(json.dumps([json.loads(r["j"]) for r in rows], ensure_ascii=False, indent=2).encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(beside, target):
        raise OSError(f"can't write {path}")


def write_by_document(df: DataFrame, path: str, key: str = "filename", mode: str = "overwrite") -> None:
    """JSON lines in a folder per document; key may be an array, whose first element counts.

    Rows are not gathered by document first, so a large one is written by many tasks.
    """
    own = df
    if df.schema[key].dataType.typeName() == "array":
        own, key = df.withColumn("first_filename", F.try_element_at(key, F.lit(1))), "first_filename"
    own.write.mode(mode).partitionBy(key).option("ignoreNullFields", False).json(path)


def write_record(df: DataFrame, path: str) -> None:
    """A single record as one file."""
    df.limit(1).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _save(folder: str, name: str, body: bytes) -> None:
    """Write a file beside its place and move it there, so that a task that runs twice leaves
    the same file; folder is a path or a URI that all executors can reach."""
    system, root = fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
    target = f"{root}/{name}"
    system.create_dir(os.path.dirname(target), recursive=True)
    beside = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
    with system.open_output_stream(beside) as file:
        file.write(body)
    system.move(beside, target)


def _each(df: DataFrame, write: Callable[..., None]) -> int:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False, name=None):
                write(*row)
            yield pd.DataFrame({"n": [len(frame)]})

    return df.mapInPandas(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def write_texts(df: DataFrame, folder: str, suffix: str = "md", name: str = "filename", text: str = "content") -> int:
    """A file per row; returns their number."""
    return _each(df.select(name, text), lambda own, body: _save(folder, f"{own}.{suffix}", (body or "").encode()))


def write_images(df: DataFrame, folder: str) -> int:
    """filename, page, content as ``<filename>/<filename>_<page>.png``; returns their number."""
    return _each(df.select("filename", "page", "content"), lambda own, page, body: _save(folder, f"{own}/{own}_{page}.png", bytes(body)))


def as_html(text: str) -> str:
    """Markdown's headings and paragraphs as HTML, each page a section; other marks stay text."""
    out = []
    for page in text.split(PAGE_BREAK):
        blocks = []
        for block in re.split(r"\n\s*\n", page.strip()):
            heading = re.fullmatch(r"(#{1,6}) (.*)", block)
            tag, body = (f"h{len(heading[1])}", heading[2]) if heading else ("p", block)
            blocks += [f"<{tag}>{html.escape(body)}</{tag}>"] if body.strip() else []
        out.append("<section>" + "".join(blocks) + "</section>")
    return "<!DOCTYPE html><html><body>" + "".join(out) + "</body></html>"


def as_tags(text: str) -> str:
    """The same with tags for headings, text and page breaks."""
    pages = []
    for page in text.split(PAGE_BREAK):
        lines = []
        for block in re.split(r"\n\s*\n", page.strip()):
            heading = re.fullmatch(r"(#{1,6}) (.*)", block)
            tag, body = (f"section_header_level_{len(heading[1])}", heading[2]) if heading else ("text", block)
            lines += [f"<{tag}>{html.escape(body, quote=False)}</{tag}>"] if body.strip() else []
        pages.append("\n".join(lines))
    return "<doctag>" + "\n<page_break>\n".join(pages) + "</doctag>"


FORMATS: dict[str, Callable[[str, str], str]] = {
    "md": lambda name, text: text, "json": lambda name, text: json.dumps({"filename": name, "pages": text.split(PAGE_BREAK)}, ensure_ascii=False), "html": lambda name, text: as_html(text), "doctags": lambda name, text: as_tags(text),
}


def write_documents(df: DataFrame, folder: str, suffix: str = "md") -> int:
    """filename, content as a file per document in one of FORMATS; returns their number."""
    if suffix not in FORMATS:
        raise ValueError(f"unknown format: {suffix}")
    make = FORMATS[suffix]
    return _each(df.select("filename", "content"), lambda own, text: _save(folder, f"{own}.{suffix}", make(own, text or "").encode()))


def append_usage(usage: DataFrame, path: str) -> None:
    """Append rows to the usage log."""
    usage.coalesce(1).write.mode("append").json(path)


def write_vectors(df: DataFrame, path: str, key: str, text: str, vector: str = "embedding") -> None:
    """Vectors with the hash of the text they were made from, so that stale ones are known."""
    df.select(key, F.sha2(text, 256).alias("content_hash"), vector).write.mode("overwrite").parquet(path)


def fresh_vectors(known: DataFrame, wanted: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows of wanted whose vector is known for this very text, with it, and those to embed."""
    hashed = wanted.withColumn("content_hash", F.sha2(text, 256))
    return hashed.join(known, [key, "content_hash"]).drop("content_hash"), hashed.join(known, [key, "content_hash"], "left_anti").drop("content_hash")
