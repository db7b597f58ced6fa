"""Word folding and Arrow plumbing shared by the operators of this package."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PAGE_BREAK = "<!-- page break -->"

#: Blocks of combining marks.
_MARK_BLOCKS = ((0x300, 0x36F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
_MARKS = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _MARK_BLOCKS) + "]+")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case without accents, with sharp s written as ss."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFKD", text.lower())).replace("ß", "ss")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits of the folded text; an empty list for null."""
    return _WORD.findall(fold(text)) if text else []


def one_per_key(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row of each key with the named columns, without rows whose key is null.

    Copies that differ in the columns are settled by the smallest values, so the result does
    not depend on the order of rows.
    """
    picked = df.select(key, *columns).where(F.col(key).isNotNull())
    if not columns:
        return picked.distinct()
    best = F.min(F.struct(*[F.col(c) for c in columns])).alias("_best")
    return picked.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in columns])


def one_per_key_in_place(df: DataFrame, key: str, *columns: str, most: int = 200_000) -> DataFrame:
    """one_per_key() that moves no row whose key stands once.

    Keys are counted without the columns.  Up to most keys that stand several times are
    broadcast: their rows alone are shuffled.  With more of them one_per_key() does the same.
    """
    own = df.select(key, *columns).where(F.col(key).isNotNull())
    several = own.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key).limit(most + 1).collect()
    if len(several) > most:
        return one_per_key(df, key, *columns)
    if not several:
        return own
    keys = F.broadcast(df.sparkSession.createDataFrame(several, df.select(key).schema))
    return own.join(keys, key, "left_anti").unionByName(one_per_key(own.join(keys, key, "left_semi"), key, *columns))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose text in column stays near max_bytes.

    A row is never cut; one longer than max_bytes comes alone.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    begin = total = 0
    for row, size in enumerate(sizes):
        if row > begin and total + size > max_bytes:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def extended(df: DataFrame, kept: str, ddl: str) -> StructType:
    """The schema of df's column kept, followed by the columns in ddl."""
    return StructType(df.select(kept).schema.fields + StructType.fromDDL(ddl).fields)
