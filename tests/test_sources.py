from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql.types import StructType

from pagewright.operators import reconcile
from pagewright.sources import scans, sinks
from pagewright.streaming import pages as streams


def test_markdown_and_images(spark, tmp_path):
    (tmp_path / "b c.md").write_text("# B\n", encoding="utf-8")
    (tmp_path / "a.md").write_text("Ä", encoding="utf-8")
    assert sorted(map(tuple, scans.read_markdown(spark, str(tmp_path)).collect())) == [("a", "Ä"), ("b c", "# B\n")]
    for name in ("d1/d1_10.png", "d1/d1_2.PNG", "d2/d2_0.jpeg", "d3/d3_1.gif"):
        (tmp_path / "imgs" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "imgs" / name).write_bytes(b"x")
    own = scans.read_images(spark, str(tmp_path / "imgs"))
    assert sorted((r["filename"], r["page"]) for r in own.collect()) == [("d1", 2), ("d1", 10), ("d2", 0)]
    assert [r["page_position"] for r in scans.positional_pages(own).orderBy("filename", "page").collect()] == [0, 1, 0]
    assert scans.read_images(spark, str(tmp_path / "imgs"), 1).select("filename").distinct().count() == 1
    (tmp_path / "imgs" / "d1" / "bad.png").write_bytes(b"x")
    with pytest.raises(Exception, match="no page number"):
        scans.read_images(spark, str(tmp_path / "imgs")).collect()


def test_pdf_errors_are_rows(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one\fx")
    (tmp_path / "b.pdf").write_bytes(b"bad")

    def extract(data: bytes) -> list[str]:
        if data == b"bad":
            raise ValueError("broken")
        return data.decode().split("\f")

    rows = {(r["filename"], r["page_index"]): r["parse_status"] for r in scans.read_pdf_pages(spark, str(tmp_path), extract).collect()}
    assert rows == {("a", 0): "ok", ("a", 1): "ok", ("b", None): "error:ValueError:broken"}
    parts = scans.read_pdf_markdown(spark, str(tmp_path), lambda d, a, b: f"{a}-{b}", lambda d: 100).where("filename = 'a'").orderBy("first_page").collect()
    assert [r["content"] for r in parts] == ["0-30", "30-60", "60-90", "90-100"]


def test_rendering_and_texts(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"xyz")
    gone = spark.createDataFrame([("a", [1])], "filename string, pages array<int>")
    rows = scans.render_pdf_pages(spark, str(tmp_path), lambda d, k: d[k : k + 1], len, gone).collect()
    assert sorted((r["page"], bytes(r["content"])) for r in rows) == [(0, b"x"), (2, b"z")]
    frame = spark.createDataFrame([("one", "text"), ("two", None)], "filename string, content string")
    assert sinks.write_texts(frame, str(tmp_path / "out")) == 2
    assert (tmp_path / "out" / "one.md").read_text() == "text" and (tmp_path / "out" / "two.md").read_text() == ""
    assert len(list((tmp_path / "out").iterdir())) == 2


def test_json_round_trips(spark, tmp_path):
    frame = spark.createDataFrame([("a", [1, 2], None), ("b", None, "x")], "filename string, pages array<int>, note string")
    path = str(tmp_path / "rows")
    sinks.write_json_lines(frame, path)
    assert sorted(map(tuple, scans.read_json_lines(spark, path, frame.schema).collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)
    (tmp_path / "bad.jsonl").write_text('{"filename": "a"}\n\nnot json\n')
    with pytest.raises(Exception, match="not a JSON object"):
        scans.read_json_lines(spark, str(tmp_path / "bad.jsonl"), StructType.fromDDL("filename string, pages array<int>")).collect()
    sinks.write_json_array(frame, str(tmp_path / "all.json"))
    assert {r["filename"] for r in json.loads((tmp_path / "all.json").read_text())} == {"a", "b"}
    assert scans.read_json_array(spark, str(tmp_path / "all.json"), frame.schema).count() == 2
    with pytest.raises(ValueError):
        sinks.write_json_array(frame, str(tmp_path / "all.json"), most=1)
    sinks.write_csv(frame, str(tmp_path / "csv"), ["filename", "pages", "other"])
    lines = sorted(x for f in (tmp_path / "csv").glob("*.csv") for x in f.read_text().splitlines())
    assert "filename,pages,other" in lines and any("[1,2]" in x for x in lines)
    sinks.write_by_document(frame.selectExpr("array(filename, 'z') as filenames", "note"), str(tmp_path / "by"), "filenames")
    assert (tmp_path / "by" / "first_filename=a").exists()


def test_matrix_and_settings(spark, tmp_path):
    matrix = np.arange(12, dtype=np.float32).reshape(4, 3)
    np.save(tmp_path / "m.npy", matrix)
    rows = scans.read_matrix(spark, str(tmp_path / "m.npy"), 4).orderBy("ord").collect()
    assert [list(r["embedding"]) for r in rows] == matrix.tolist()
    with pytest.raises(ValueError):
        scans.read_matrix(spark, str(tmp_path / "m.npy"), 5)
    (tmp_path / "s.yaml").write_text("a: 1\n")
    assert scans.read_settings(str(tmp_path / "s.yaml"), ("a",), b=2) == {"a": 1, "b": 2}
    with pytest.raises(KeyError):
        scans.read_settings(str(tmp_path / "s.yaml"), ("c",))


def test_reconcile(spark):
    left = spark.createDataFrame([("a", 2), ("b", 1)], "filename string, pages int")
    right = spark.createDataFrame([("a", 3), ("c", 1)], "filename string, pages int")
    assert sorted(map(tuple, reconcile.missing_on_either_side(left, right).collect())) == [("b", "left"), ("c", "right")]
    assert [tuple(r) for r in reconcile.page_count_mismatch(left, right).collect()] == [("a", 2, 3)]
    names = spark.createDataFrame([("Über uns",), ("uber-uns",), ("x",)], "filename string")
    got = {r["filename"]: (r["normalized"], r["clash"]) for r in reconcile.normalized_names(names).collect()}
    assert got == {"Über uns": ("uber_uns", True), "uber-uns": ("uber_uns", True), "x": ("x", False)}


def test_streams(spark, tmp_path):
    frame = spark.createDataFrame([("a", 0, 1, ["Contents", "One .... 1", "Two .... 2"]), ("b", 0, 1, ["x"])], "filename string, page_index int, total_pages int, lines array<string>")
    frame.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = streams.scored_page_stream(streams.read_page_stream(spark, str(tmp_path / "in"), "filename string, page_index int, total_pages int, lines array<string>"))
    query = streams.start(stream, lambda batch, n: seen.extend(batch.select("filename", "is_toc_page").collect()), str(tmp_path / "c1"))
    query.awaitTermination(120)
    assert sorted(map(tuple, seen)) == [("a", True), ("b", False)]
    events = spark.sql("select timestamp_ntz'2024-01-01 00:01:00' as ts, 'm' as model, 5 as tokens union all select timestamp_ntz'2024-01-01 00:03:00', 'm', 7")
    events.write.parquet(str(tmp_path / "ev"))
    rows = []
    live = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    query = streams.usage_windows(live).writeStream.outputMode("complete").foreachBatch(lambda b, n: rows.extend(b.collect())).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [(r["call_count"], r["tokens"]) for r in rows][-1] == (2, 12)


def test_records_and_datasets(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    frame.write.parquet(str(tmp_path / "set" / "train"))
    assert scans.read_dataset(spark, str(tmp_path / "set"), "train").count() == 2 and scans.read_dataset(spark, str(tmp_path / "set" / "train")).count() == 2
    sinks.write_record(frame.orderBy("n"), str(tmp_path / "one"))
    assert [r["s"] for r in spark.read.json(str(tmp_path / "one")).collect()] == ["a"]


def test_first_of_a_stream(spark, tmp_path):
    rows = [(k % 3, f"2024-01-01 00:0{k}:00") for k in range(6)]
    spark.createDataFrame(rows, "k int, ts string").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("k int, ts string").parquet(str(tmp_path / "in"))
    seen = []
    query = streams.start(streams.first_seen(source, "k", "ts"), lambda batch, n: seen.extend(r["k"] for r in batch.collect()), str(tmp_path / "check"))
    query.awaitTermination(60)
    assert sorted(seen) == [0, 1, 2]
