from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators.usage import usage_rollup


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "x string").select(function(F.col("x")).alias("y")).first()["y"]


def test_lines_like_python(spark):
    for value in ("a\nb\r\nc\rd\x0be\x0cf\x1cg\x85h i j\n", "", "x", "\n", "two  spaces", "a\n\n"):
        assert one(spark, value, T.split_lines) == value.splitlines()


def test_normalize_line(spark):
    assert one(spark, "  a  b\t c ", T.normalize_line) == "a b c"


def test_uuid5(spark):
    for name in ("report", "Zürich", ""):
        assert one(spark, name, lambda c: T.uuid5(str(uuid.NAMESPACE_URL), c)) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_payload_and_reasoning(spark):
    assert one(spark, '```json\n{"a": 1}\n```', T.json_payload) == '{"a": 1}'
    assert one(spark, 'Sure: {"a": {"b": 2}} bye', T.json_payload) == '{"a": {"b": 2}}'
    assert one(spark, "<think>x\ny</think> z", T.strip_reasoning) == "z"


def test_data_url_round_trip(spark):
    frame = spark.createDataFrame([("p.PNG", bytearray(b"x" * 100)), ("q.jpg", bytearray(b""))], "path string, content binary")
    rows = frame.select(T.data_url(F.col("path"), F.col("content")).alias("u"), "content").select(T.data_url_parts(F.col("u")).alias("p"), "content").collect()
    assert [(r["p"]["kind"], r["p"]["bytes"]) for r in rows] == [("png", b"x" * 100), ("jpeg", b"")]
    bad = spark.createDataFrame([("p.gif", bytearray(b"x"))], "path string, content binary")
    with pytest.raises(Exception, match="not an image suffix"):
        bad.select(T.data_url(F.col("path"), F.col("content"))).collect()


def test_bounded_text(spark):
    frame = spark.createDataFrame([("x" * 30,)], "x string")
    assert len(frame.select(T.bounded_text(F.col("x"), 5, 4, 2).alias("y")).first()["y"]) == 10


def test_unknown_cost_absorbs(spark):
    frame = spark.createDataFrame([("m", 1, -2, 3, 1.0), ("m", 4, None, 6, None), ("n", 1, 1, 2, 0.5)], "model string, input_tokens int, output_tokens int, total_tokens int, cost double")
    got = {r["model"]: r for r in usage_rollup(frame, "model").collect()}
    assert got["m"]["cost"] is None and got["m"]["output_tokens"] == 0 and got["m"]["call_count"] == 2 and got["n"]["cost"] == 0.5


def test_ascii_of_other_alphabets(spark):
    for value, plain in (("Žluťoučký kůň", "Zlutoucky kun"), ("Łódź straße", "Lodz strasse"), ("Αθήνα", "Athina"), ("Москва Жуков щи", "Moskva Zhukov shchi"), ("œuvre naïve", "oeuvre naive"), ("plain", "plain"), (None, None)):
        assert one(spark, value, T.to_ascii) == plain


def test_small_helpers(spark):
    frame = spark.createDataFrame([(1, ["a"], "k", "text")], "n int, v array<string>, k string, t string")
    row = frame.select(
        T.utc_stamp(F.lit("2024-02-03 04:05:06.7").cast("timestamp")).alias("stamp"), T.padded(F.col("v"), F.lit(3), F.lit("z")).alias("padded"), T.padded(F.col("v"), F.lit(0), F.lit("z")).alias("same"),
        T.lookup(F.create_map(F.lit("k"), F.lit(5)), F.col("k"), F.lit(0)).alias("found"), T.lookup(F.create_map(F.lit("k"), F.lit(5)), F.lit("x"), F.lit(0)).alias("lost"), T.content_hash(F.col("t")).alias("hash"),
    ).first()
    assert (row["stamp"], row["padded"], row["same"], row["found"], row["lost"]) == ("2024-02-03T04:05:06Z", ["a", "z", "z"], ["a"], 5, 0) and len(row["hash"]) == 64
