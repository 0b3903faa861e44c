import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderlog.functions import points, text, times
from cinderlog.operators.parse import accepted, parse_header, rejected

VALID = [
    ("081109 203615,148 INFO dfs.DataNode$PacketResponder: PacketResponder 1 for block blk_38 terminating",
     ("081109", "203615", "148", "INFO", "dfs.DataNode$PacketResponder",
      "PacketResponder 1 for block blk_38 terminating")),
    ("2015-10-17 15:37:56,547 WARN a.b: x: y: z", ("2015-10-17", "15:37:56", "547", "WARN", "a.b", "x: y: z")),
    ("240101 000000,1,2 INFO two words:   spaced  out ", ("240101", "000000", "1,2", "INFO", "two words", "spaced  out ")),
    ("240101 000000,1 INFO c:no: rest", ("240101", "000000", "1", "INFO", "c:no", "rest")),
    ("240101 000000,1 INFO c: ", ("240101", "000000", "1", "INFO", "c", "")),
    ("99999x 000000,1 INFO c: bad date", ("99999x", "000000", "1", "INFO", "c", "bad date")),
]
INVALID = [
    None, "", "   ", "no header at all", "240101 000000 1 INFO c: no comma", " 240101 000000,1 INFO c: leading",
    "240101 ,1 INFO c: no time", "240101 000000, INFO c: no pid", "240101 000000,1 INFO", "240101 000000,1 INFO c no colon",
    "240101 000000,1 INFO : no component", "240101 000000,1 INFO c:", "\tat java.lang.Thread.run(Thread.java:745)",
]


@pytest.fixture(scope="module")
def parsed(spark):
    values = [v for v, _ in VALID] + INVALID
    return parse_header(spark.createDataFrame(list(enumerate(values)), "line_id bigint, value string"))


def test_header_fields(parsed):
    got = accepted(parsed).orderBy("line_id").select(
        "log_date", "log_time", "pid", "log_level", "component", "content"
    ).collect()
    assert [tuple(r) for r in got] == [fields for _, fields in VALID]


def test_rejects_keep_every_other_line(parsed):
    got = [r.value for r in rejected(parsed).orderBy("line_id").collect()]
    assert got == INVALID


def test_filter_runs_once_and_first(parsed):
    plan = accepted(parsed)._jdf.queryExecution().optimizedPlan().toString()
    condition = [line for line in plan.splitlines() if "Filter" in line]
    assert len(condition) == 1 and "split" not in condition[0]


def test_times(spark):
    cases = [
        ("081109", "203615", dt.datetime(2008, 11, 9, 20, 36, 15)),
        ("2015-10-17", "15:37:56", dt.datetime(2015, 10, 17, 15, 37, 56)),
        ("2015-10-17", "153756", dt.datetime(2015, 10, 17, 15, 37, 56)),
        ("241301", "000000", None), ("240101", "256000", None), ("2024-1-1", "000000", None),
        ("x", "000000", None), ("240101", "", None), (None, "000000", None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "d string, t string")
    got = df.select(
        F.date_format(times.log_timestamp(F.col("d"), F.col("t")), "yyyy-MM-dd HH:mm:ss")
    ).collect()
    assert [r[0] for r in got] == [c[2] and c[2].strftime("%Y-%m-%d %H:%M:%S") for c in cases]
    months = df.select(times.month_key(F.col("d"))).collect()
    assert [r[0] for r in months][:4] == ["200811", "201510", "201510", None]


def test_instants(spark):
    row = spark.range(1).select(
        F.unix_micros(times.iso_instant(F.lit("2024-01-01T00:01:00.250+01:00"))),
        F.unix_micros(times.epoch_instant(F.lit(1704067260.25))),
        times.iso_instant(F.lit("nonsense")),
    ).first()
    assert tuple(row) == (1704063660250000, 1704067260250000, None)


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("a blk_1 b blk_-2 c blk_1 src: /10.0.0.1:50010, dest: /h2:9 bytes: 12 duration: x",), ("none",), (None,)],
        "content string",
    )
    c = F.col("content")
    src = text.endpoint(c, r"src: (/[^ ]+)")
    got = df.select(
        text.first_block_id(c), text.block_ids(c), src, text.host(src), text.port(src),
        text.named_number(c, "bytes"), text.named_number(c, "duration"),
    ).collect()
    assert tuple(got[0]) == ("blk_1", ["blk_1", "blk_-2"], "10.0.0.1:50010,", "10.0.0.1", 50010, 12, None)
    assert tuple(got[1]) == ("", [], "", "", None, None, None)
    assert got[2][0] is None
    listed = spark.range(1).select(
        text.split_list(F.lit("['/10.0.0.1', '', '5]']")), text.item(F.array(F.lit("a")), 3),
        text.first_integer(F.lit("cost:ms")), text.first_integer(F.lit("cost:31ms of 5")),
    ).first()
    assert tuple(listed) == (["10.0.0.1", "", "5"], None, None, 31)


def test_masks_and_digit_tokens(spark):
    masked = text.mask(F.lit("at /10.0.0.1:50010: and 1.2.3.4 BP-1-10.0.0.1-2:blk_3 v1 end"))
    hidden = text.hide_digit_tokens(F.lit("a 1 b2c ä9 x-y <*>, <*>1 z"))
    row = spark.range(1).select(masked, hidden, text.squeeze(F.lit("  a \t b "))).first()
    assert tuple(row) == ("at <*> and <*> <*>:blk_3 v1 end", "a <*> <*> <*> x-y <*>, <*> z", "a b")


def test_points_escape_and_skip(spark):
    df = spark.createDataFrame(
        [("a b,c=d", 5, 1), ("", 5, 1), (None, 5, 1), ("x", None, 1), ("x", 5, None)], "tag string, n bigint, t bigint"
    )
    line = points.point("m", {"level": F.col("tag")}, {"n": points.integer_field(F.col("n"))}, F.timestamp_seconds("t"))
    got = [r[0] for r in df.select(line).collect()]
    assert got == [r"m,level=a\ b\,c\=d n=5i 1000000000", "m n=5i 1000000000", "m n=5i 1000000000", None, None]
