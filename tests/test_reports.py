import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog import schema
from cinderlog.operators import series
from cinderlog.plans import reports
from cinderlog.plans.structuring import structure_files
from cinderlog.sources import files, sinks, streams

# Usual templates of the two statements.
TRANSFER = (
    "src: <*>, dest: <*>, bytes: <*>, op: HDFS_WRITE, cliID: <*> offset: <*>, "
    "srvID: 4f8dd80e-ab80-41ad-b045-99cfeb1828d2, blockid: BP-<*>-<*><*>:<*>_<*>, duration: <*>"
)
CONNECT_RETRY = (
    "Retrying connect to server: mesos-master-<*><*>. Already tried <*> time(s); retry policy is "
    "RetryUpToMaximumCountWithFixedSleep(maxRetries=<*>, sleepTime=<*> MILLISECONDS)"
)


def row(i, **fields):
    base = dict(
        line_id=i, log_date="240101", log_time="000000", pid="1", log_level="INFO", component="c", content="",
        event_time=dt.datetime(2024, 1, 1), event_id="e", event_template="t", parameters=[],
    )
    return tuple({**base, **fields}[f] for f in schema.STRUCTURED.fieldNames())


@pytest.fixture(scope="module")
def logs(spark):
    move = "src: /10.0.0.1:50010, dest: /10.0.0.2:50010, bytes: {}, op: HDFS_WRITE, duration: {}"
    rows = [
        row(0, event_template=K.SLOW_WRITE, parameters=["cost:400ms"], log_level="WARN"),
        row(1, event_template=K.SLOW_WRITE, parameters=["cost:none"]),
        row(2, event_template=K.SLOW_WRITE, parameters=[]),
        row(3, event_template=K.SLOW_WRITE, parameters=["600", "1"]),
        row(4, event_template=TRANSFER, content=move.format(1048576 * 3000, 1000000000)),
        row(5, event_template=TRANSFER, content=move.format(10, 0)),
        row(6, event_template=TRANSFER, content="src: nothing else"),
        row(7, event_template=CONNECT_RETRY, content="Already tried 4 time(s)", parameters=["x", "y", "4"]),
        row(8, event_template=CONNECT_RETRY, content="Already tried 4 time(s)", parameters=["x"]),
        row(9, event_template=K.IO_EXCEPTION, log_level="ERROR", log_date="240102"),
        row(10, event_template=K.PERMISSION_DENIED, log_level="ERROR", log_date="240102"),
        row(11, event_template=K.PERMISSION_DENIED, log_level="DEBUG", log_date="2024-02-01", event_id="f"),
        row(12, log_date="bad", log_level=None, event_id=None),
    ]
    return spark.createDataFrame(rows, schema.STRUCTURED)


def test_severity(logs):
    assert reports.severity(logs).first().asDict() == dict(error=2, warn=1, info=8, fatal=0)


def test_exceptions(logs):
    got = [tuple(r) for r in reports.exceptions(logs).collect()]
    assert got == [("240102", 2), ("2024-02-01", 1)]


def test_write_latency_skips_lines_without_digits(logs):
    assert reports.write_latency(logs).first()[0] == 500.0
    assert reports.write_latency(logs.limit(0)).first()[0] is None


def test_speed(logs):
    got = {r.line_id: r for r in reports.transfer_speed(logs).collect()}
    assert (got[4].src, got[4].dest, got[4].speed, got[4].speed_mib_s) == (
        "10.0.0.1:50010", "10.0.0.2:50010", "3,000.00", 3000.0)
    assert got[5].speed is None and got[6].speed is None and got[6].dest == ""


def test_retries(logs):
    assert [tuple(r) for r in reports.retries(logs).collect()] == [(4, 2)]
    by_index = [tuple(r) for r in reports.retries(logs, param_index=2).collect()]
    assert by_index == [(None, 1), (4, 1)]


def test_monthly(logs):
    got = {(r.log_level, r.month): (r.total_records, r.distinct_eventid) for r in reports.monthly_severity(logs).collect()}
    assert got[("DEBUG", "202402")] == (1, 1) and got[(None, None)] == (0, 0)
    assert got[("INFO", "202401")] == (8, 1)


def test_filter_and_columns_reach_the_scan(spark, logs, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_structured(logs, path)
    stored = files.structured_parquet(spark, path)
    assert stored.count() == 13 and stored.where("log_day = '2024-01-01'").count() == 13
    plan = reports.write_latency(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_template" in plan and "ReadSchema: struct<event_template:string,parameters:array<string>>" in plan
    pruned = stored.where("log_day = '2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_day" in pruned


def test_structure_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.log").write_text("240101 000000,1 INFO c: open file 1\n240101 000001,1 INFO c: open file 2\n\n")
    (raw / "b.log").write_text("garbage\n240101 000002,1 WARN c: open file 3\n")
    structure_files(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "rejects"))
    rows = files.structured_parquet(spark, str(tmp_path / "out")).orderBy("event_time").collect()
    assert [(r.event_template, r.parameters) for r in rows] == [("open file <*>", [str(i)]) for i in (1, 2, 3)]
    assert len({r.line_id for r in rows}) == 3 and rows[0].line_id < rows[1].line_id
    assert {r.value for r in spark.read.parquet(str(tmp_path / "rejects")).collect()} == {"", "garbage"}


def test_all_report_files(spark, logs, tmp_path):
    reports.write_all(logs, str(tmp_path))
    for name in ("exceptions", "severity", "slowness", "speed", "retrycount", "monthly"):
        parts = list((tmp_path / name).glob("part-*.csv"))
        assert parts and parts[0].read_text().strip()
        assert name == "speed" or len(parts) == 1


def test_spread_leaves_wide_scans_alone(spark, sf_dir):
    narrow = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert files.spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 30)
    assert files.spread(wide) is wide


def test_topic_options():
    assert streams.topic_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t"}
    full = streams.topic_options("h:1", "t", 10000, "latest", False)
    assert full["maxOffsetsPerTrigger"] == "10000" and full["startingOffsets"] == "latest" and full["failOnDataLoss"] == "false"


def test_series(spark):
    counts = spark.createDataFrame(
        [("A", 60, 1), ("A", 120, None), ("A", 180, 3), ("B", 60, 9)], "log_level string, t bigint, event_count bigint"
    ).withColumn("window_end", F.timestamp_seconds("t"))
    latest = {r.log_level: r.event_count for r in series.latest_per_level(counts).collect()}
    assert latest == {"A": 3, "B": 9}
    trend = series.count_trend(counts, F.timestamp_seconds(F.lit(60)), F.timestamp_seconds(F.lit(180))).collect()
    assert [(r.log_level, r.event_count) for r in trend] == [("A", 1), ("A", None), ("A", 3), ("B", 9)]
    means = series.mean_per_interval(counts, "window_end", ["event_count"], 60, 301, 60).orderBy("interval_start").collect()
    assert [r.mean_event_count for r in means] == [5.0, None, 3.0, None, None]
    newest = series.newest(
        counts.withColumn("batch_id", F.col("t")).select("log_level", "event_count", "batch_id"), ["log_level"]
    )
    assert {r.log_level: r.event_count for r in newest.collect()} == {"A": 3, "B": 9}


def test_windows_count_by_hash(logs):
    plan = series.level_counts(logs)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_defaults_select_raw_lines(spark):
    """Mined templates hide other tokens than the usual ones; the statements are found."""
    from cinderlog.plans.structuring import structure

    head = "240101 010203,7 INFO dfs.DataNode: "
    lines = [
        head + f"src: /10.0.0.{i}:50010, dest: /10.0.0.9:50010, bytes: {i}048576, op: HDFS_WRITE, cliID: c_{i} offset: 0, "
        f"srvID: s{i}, blockid: BP-1-10.0.0.1-2:blk_{i}_1, duration: {i}000" for i in range(1, 5)
    ] + [
        head + f"Retrying connect to server: mesos-master-{i}/10.0.0.{i}:9000. Already tried {i} time(s); retry policy is "
        f"RetryUpToMaximumCountWithFixedSleep(maxRetries=10, sleepTime=1000 MILLISECONDS)" for i in range(1, 4)
    ] + [head + f"Slow BlockReceiver write data to disk cost:{i}00ms (threshold=300ms)" for i in (4, 6)]
    raw = spark.createDataFrame(list(enumerate(lines)), "line_id bigint, value string")
    structured = structure(raw)[0]
    assert reports.transfer_speed(structured).count() == 4
    assert {(r.retrycount, r.event_count) for r in reports.retries(structured).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert reports.write_latency(structured).first()[0] == 500


def test_statements_are_filtered_by_their_templates(store):
    """The templates of a statement reach the scan as a filter; contents are not compared."""
    for report in (reports.transfer_speed(store), reports.retries(store)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [In(event_template" in plan or "PushedFilters: [IsNotNull(event_template), EqualTo(event_template" in plan
        assert "LIKE" not in plan and "Contains" not in plan


def test_many_templates_of_a_statement_are_joined(spark, store, monkeypatch):
    want = sorted(map(tuple, reports.retries(store).collect()))
    monkeypatch.setattr(reports, "PUSHED_TEMPLATES", 0)
    assert sorted(map(tuple, reports.retries(store).collect())) == want and want
