"""Line identity of text files."""

import pytest
from pyspark.sql import functions as F

from cinderlog.operators.parse import accepted, parse_header, rejected
from cinderlog.sources import files


@pytest.fixture
def folder(tmp_path):
    texts = {
        "b.log": [f"240101 100000,{i} INFO c: line {i} " + "x" * (i % 50) for i in range(4000)],
        "a.log": ["first", "", "240101 100000,1 INFO c: é"], "c.log": [], "d.log": ["no newline at the end"],
    }
    (tmp_path / "raw").mkdir()
    for name, lines in texts.items():
        end = "\r\n" if name == "a.log" else "\n"
        body = end.join(lines) + (end if lines and name != "d.log" else "")
        (tmp_path / "raw" / name).write_bytes(body.encode())
    want = {}
    for number, name in enumerate(n for n in sorted(texts) if texts[n]):
        want.update({(number << files.LINE_BITS) + i: line for i, line in enumerate(texts[name])})
    return str(tmp_path / "raw"), want


@pytest.mark.parametrize("size", ["7k", "50k", "128m"])
@pytest.mark.parametrize("splits", [files.BROADCAST_SPLITS, 0])
def test_line_ids_do_not_depend_on_splits(spark, folder, monkeypatch, size, splits):
    path, want = folder
    monkeypatch.setattr(files, "BROADCAST_SPLITS", splits)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        lines = files.raw_lines(spark, path)
        assert {r.line_id: r.value for r in lines.collect()} == want
        parsed = parse_header(lines)
        good, bad = ({r.line_id for r in part(parsed).select("line_id").collect()} for part in (accepted, rejected))
        assert good | bad == set(want) and not good & bad and len(bad) == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_changed_splits_are_refused(spark, folder):
    path, want = folder
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    try:
        lines = files.raw_lines(spark, path).where(F.col("line_id") >= 0)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
        try:
            got = {r.line_id: r.value for r in lines.collect()}
        except Exception as error:
            assert "splits of the input have changed" in str(error)
        else:
            assert got == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.log").write_text("")
    assert files.raw_lines(spark, str(tmp_path / "empty")).isEmpty()


def test_rows_of_few_row_groups_are_spread(spark, tmp_path):
    """As many splits as cores, but one row group: the rows are dealt out all the same."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.range(50_000).withColumnRenamed("id", "event_id").coalesce(1).write.parquet(str(tmp_path / "rows"))
    scan = session.read.parquet(str(tmp_path / "rows"))
    assert 8 <= scan.rdd.getNumPartitions() < 16
    per_task = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert per_task(scan) == [50_000]
    assert len(per_task(files.spread(scan, "event_id"))) == 16
    assert max(per_task(files.spread(scan, "event_id"))) < 5_000
    spark.range(0, 50_000, 1, 8).withColumnRenamed("id", "event_id").write.parquet(str(tmp_path / "even"))
    even = spark.read.parquet(str(tmp_path / "even"))
    assert files.spread(even, "event_id") is even
