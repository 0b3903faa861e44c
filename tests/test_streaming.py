import pytest
from pyspark.sql import functions as F

from cinderlog import schema
from cinderlog.functions.envelope import from_envelope, to_envelope
from cinderlog.operators import series
from cinderlog.operators import templates as T
from cinderlog.sources import streams
from cinderlog.streaming import batches, jobs
from cinderlog.streaming.catalogue import known_templates, learn, publish_templates, restated


@pytest.fixture(scope="module")
def session(spark):
    return jobs.stream_session(spark, 4)


def lines_of(minute, texts):
    return [f"240101 10{minute:02d}00,1 INFO c: {t}" for t in texts]


def feed(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def structured(spark, out):
    values = spark.read.schema("value string").text(f"{out}/structured")
    return from_envelope(values, schema.STRUCTURED)


def run(session, folder, out):
    source = streams.directory_values(session, str(folder), max_files=1)
    return jobs.run_to_end(jobs.structure_stream(source, str(out), f"{out}/checkpoint"))


def test_structuring_restarts_and_keeps_rejects(spark, session, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    feed(raw, "1.log", lines_of(0, ["open file 1", "open file 2", "kept 300ms"]) + ["broken"])
    run(session, raw, out)
    feed(raw, "2.log", lines_of(1, ["open file 3", "kept 400ms"]))
    run(session, raw, out)
    run(session, raw, out)  # nothing new
    rows = structured(spark, out)
    assert sorted(r.line_id for r in rows.collect()) == [0, 1, 2, 4, 5]  # 3 was rejected
    assert {r.event_template for r in rows.where("content LIKE 'open%'").collect()} == {"open file <*>"}
    # The second batch widens the template; the first batch's line keeps its own.
    kept = {r.content: r.event_template for r in rows.where("content LIKE 'kept%'").collect()}
    assert kept == {"kept 300ms": "kept 300ms", "kept 400ms": "kept <*>"}
    now = restated(rows, known_templates(spark, f"{out}/catalogue"))
    assert now.columns == rows.columns
    assert {(r.event_template, *r.parameters) for r in now.where("content LIKE 'kept%'").collect()} == {
        ("kept <*>", "300ms"), ("kept <*>", "400ms")}
    assert [r.value for r in spark.read.parquet(f"{out}/rejects").collect()] == ["broken"]
    metrics = from_envelope(spark.read.schema("value string").text(f"{out}/metrics"), schema.BATCH_METRICS).collect()
    assert sorted(m.record_count for m in metrics) == [2, 4]
    for m in metrics:
        assert m.latency > 0 and abs(m.throughput - m.record_count / m.latency) < 1e-6
    points = series.batch_points(spark.createDataFrame(metrics, schema.BATCH_METRICS)).collect()
    assert all(p.value.startswith("streaming_metrics,batch_id=") for p in points)


def downstream(session, out):
    """The messages that a reader of the published rows has taken so far."""
    source = streams.directory_values(session, f"{out}/structured/*")
    jobs.run_to_end(jobs.replay_stream(source, f"{out}/taken", f"{out}/checkpoint-taken"))
    return session.read.schema("value string").text(f"{out}/taken")


def test_failed_batch_is_replayed_once(spark, session, tmp_path, monkeypatch):
    """Whatever step a batch dies in, a reader beside it gets each of its rows once."""
    raw, out = tmp_path / "raw", tmp_path / "out"
    feed(raw, "0.log", lines_of(0, ["z 0"]))
    run(session, raw, out)
    feed(raw, "1.log", lines_of(0, ["a 1", "b 2"]))
    real = batches.move

    def fail_before(spark, source, target):
        raise RuntimeError("not moved")

    def fail_after(spark, source, target):
        real(spark, source, target)
        raise RuntimeError("moved")

    def fail(messages, batch_id):
        raise RuntimeError("at the end")

    for step, sinks in ((fail_before, {}), (fail_after, {}), (real, dict(metrics_sink=fail))):
        monkeypatch.setattr(batches, "move", step)
        source = streams.directory_values(session, str(raw))
        with pytest.raises(Exception, match="moved|at the end"):
            jobs.run_to_end(jobs.structure_stream(source, str(out), f"{out}/checkpoint", **sinks))
        downstream(session, out)
    run(session, raw, out)
    rows = structured(spark, out).collect()
    assert sorted((r.line_id, r.content) for r in rows) == [(0, "z 0"), (1, "a 1"), (2, "b 2")]
    taken = from_envelope(downstream(session, out), schema.STRUCTURED)
    assert sorted(r.content for r in taken.collect()) == ["a 1", "b 2", "z 0"]
    assert sorted(r.record_count for r in from_envelope(
        spark.read.schema("value string").text(f"{out}/metrics"), schema.BATCH_METRICS).collect()) == [1, 2]
    assert known_templates(spark, f"{out}/catalogue").count() == 3


def test_empty_batch_has_metrics(spark, session, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    feed(raw, "1.log", [])
    feed(raw, "2.log", lines_of(0, ["a 1"]))
    feed(raw, "3.log", [])
    run(session, raw, out)
    metrics = from_envelope(spark.read.schema("value string").text(f"{out}/metrics"), schema.BATCH_METRICS).collect()
    assert {m.batch_id: m.record_count for m in metrics} == {"0": 0, "1": 1, "2": 0}
    assert all(m.throughput == 0 for m in metrics if m.record_count == 0)
    assert [r.line_id for r in structured(spark, out).collect()] == [0]


WIDENING = (
    ["limit 300ms kept", "job red is done now", "disk one was full at noon", "start task alpha now please"]
    + ["limit 400ms kept", "job blue is done now", "disk two was full at night", "start task beta then thanks"]
    + ["limit 300ms kept", "job red was done again", "disk one is empty at noon", "start task alpha now thanks"]
    + ["job green is done now", "start job alpha now please", "limit off kept", "open a b c d e f g", "open a x y z e f h"]
)


@pytest.mark.parametrize("cuts", [[17], [4, 8, 17], [1, 2, 9, 16, 17]])
def test_templates_do_not_depend_on_batch_cuts(spark, tmp_path, cuts):
    """A stream's catalogue is that of mining its lines at once, however they were cut."""
    shaped = lambda texts: T.with_shape(spark.createDataFrame(list(enumerate(texts)), "line_id bigint, content string"))
    path = f"{tmp_path}/catalogue"
    for batch, (low, high) in enumerate(zip([0, *cuts], cuts)):
        news = learn(shaped(WIDENING[low:high]), known_templates(spark, path, before=batch))
        if not news.isEmpty():
            batches.publish(spark, path, batch, news.write.parquet)
    every = shaped(WIDENING)
    want = T.assign_templates(every, T.mine_templates(every))
    first = T.assign_templates(every, known_templates(spark, path, before=1).select("shape", "pattern"))
    columns = ["line_id", "event_id", "event_template", "parameters"]
    got = restated(first, known_templates(spark, path))
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
    before = sorted(map(tuple, known_templates(spark, path).collect()))
    at = publish_templates(spark, path)
    assert (at.number, at.upto) == (0, batches.batch_ids(spark, path)[-1])
    assert sorted(map(tuple, known_templates(spark, path).collect())) == before


def test_versions_are_pinned_and_survive_a_crash(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/catalogue"
    put = lambda batch, *rows: batches.publish(
        spark, path, batch, spark.createDataFrame(rows, schema.CATALOGUE).write.parquet)
    assert publish_templates(spark, path) is None and known_templates(spark, path).isEmpty()
    assert put(0, ("go on", "go on", "go on")) and not put(0, ("again",) * 3)
    first = publish_templates(spark, path)
    put(1, ("stop it now", "stop it now", "stop it now"))
    shapes = lambda **which: {r.shape for r in known_templates(spark, path, **which).collect()}
    with monkeypatch.context() as broken:
        def fail(*_):
            raise RuntimeError("before the pointer")
        broken.setattr(batches, "put_text", fail)
        with pytest.raises(RuntimeError):
            publish_templates(spark, path)
    assert batches.pointer(spark, path) == first and shapes() == {"go on", "stop it now"}
    assert batches.batch_ids(spark, path) == [0, 1]
    second = publish_templates(spark, path)
    assert (second.number, second.upto) == (1, 1)
    assert shapes(version=0) == {"go on"} and shapes(version=1) == shapes() == {"go on", "stop it now"}
    assert batches.batch_ids(spark, path) == [1]  # what the first snapshot held is gone
    assert not put(0, ("late",) * 3) and not put(1, ("late",) * 3)
    publish_templates(spark, path)
    with pytest.raises(ValueError):
        known_templates(spark, path, version=0)
    assert shapes() == {"go on", "stop it now"}


def test_a_version_may_use_another_similarity(spark, tmp_path):
    path = f"{tmp_path}/catalogue"
    lines = T.with_shape(spark.createDataFrame(list(enumerate(["open a b c", "open a x c"])), "line_id bigint, content string"))
    batches.publish(spark, path, 0, learn(lines, known_templates(spark, path)).write.parquet)
    assert {r.pattern for r in known_templates(spark, path).collect()} == {"open a <*> c"}
    publish_templates(spark, path, similarity=0.9)
    assert {r.pattern for r in known_templates(spark, path).collect()} == {"open a b c", "open a x c"}


def test_known_lines_teach_nothing(spark):
    def shaped(texts):
        return T.with_shape(spark.createDataFrame(list(enumerate(texts)), "line_id bigint, content string"))

    nothing = spark.createDataFrame([], schema.CATALOGUE)
    first = learn(shaped(["go 1 x", "go 2 x", "stay 5 y"]), nothing)
    assert learn(shaped(["go 7 x", "stay 5 y"]), first).isEmpty()
    wider = {r.shape: r.pattern for r in learn(shaped(["stay 6 y"]), first).collect()}
    assert wider == {"stay <*> y": "stay <*> y"}
    more = {r.shape: r.pattern for r in learn(shaped(["go on z", "new line"]), first).collect()}
    assert "new line" in more and "go on z" in more


def test_merge_with_a_known_template_updates_all_its_shapes(spark):
    def shaped(texts):
        return T.with_shape(spark.createDataFrame(list(enumerate(texts)), "line_id bigint, content string"))

    nothing = spark.createDataFrame([], schema.CATALOGUE)
    first = learn(shaped(["the job red is done", "the job blue is done"]), nothing)
    assert {r.pattern for r in first.collect()} == {"the job <*> is done"}
    news = learn(shaped(["the job red was done"]), first)
    assert {r.shape: r.pattern for r in news.collect()} == {
        s: "the job <*> <*> done" for s in ("the job red is done", "the job blue is done", "the job red was done")
    }


def test_newest_catalogue_wins(spark, tmp_path):
    for batch, pattern in ((0, "a #1"), (1, "a <*>"), (5, "later")):
        spark.createDataFrame([("a <*>", pattern, pattern)], schema.CATALOGUE).write.parquet(f"{tmp_path}/c/batch_id={batch}")
    assert [tuple(r) for r in known_templates(spark, f"{tmp_path}/c", 5).collect()] == [("a <*>",) * 3]
    assert known_templates(spark, f"{tmp_path}/none", 5).isEmpty()


def message(i, minute, level="INFO"):
    return f'{{"line_id":{i},"log_level":"{level}","event_time":"2024-01-01T10:{minute:02d}:0{i % 10}.000Z"}}'


def counts_query(session, folder, out, **options):
    rows = streams.rows_from_values(streams.directory_values(session, str(folder), max_files=1), schema.STRUCTURED)
    counts = jobs.windowed_counts(rows, **options)
    return jobs.run_to_end(jobs.counts_stream(counts, f"{out}/messages", f"{out}/checkpoint"))


def table(df):
    return sorted(
        (r.s, r.log_level, r.event_count) for r in df.withColumn("s", F.date_format("window_start", "HH:mm")).collect()
    )


def test_update_mode_upserts(spark, session, tmp_path):
    topic, out = tmp_path / "topic", tmp_path / "out"
    feed(topic, "1", [message(1, 0), message(2, 0), message(3, 1, "WARN")])
    counts_query(session, topic, out)
    feed(topic, "2", [message(4, 0), message(5, 2)])
    counts_query(session, topic, out)
    # Kept: compaction deletes the batches that a lazy frame would read.
    got = spark.createDataFrame(jobs.current_counts(spark, f"{out}/messages").collect())
    assert table(got) == [("10:00", "INFO", 3), ("10:01", "WARN", 1), ("10:02", "INFO", 1)]
    rows = spark.createDataFrame([], schema.STRUCTURED)
    values = spark.read.schema("value string").text(str(topic))
    batch = series.level_counts(from_envelope(values, schema.STRUCTURED))
    assert table(batch) == table(got) and rows.isEmpty()
    for upto in (1, 1):  # the second snapshot deletes the batches of the first
        assert jobs.compact_counts(spark, f"{out}/messages").upto == upto
        assert sorted(map(repr, jobs.current_counts(spark, f"{out}/messages").collect())) == sorted(map(repr, got.collect()))
    assert batches.batch_ids(spark, f"{out}/messages") == []
    feed(topic, "3", [message(6, 0), message(7, 3)])
    counts_query(session, topic, out)
    assert batches.batch_ids(spark, f"{out}/messages") == [2]
    assert table(jobs.current_counts(spark, f"{out}/messages")) == [
        ("10:00", "INFO", 4), ("10:01", "WARN", 1), ("10:02", "INFO", 1), ("10:03", "INFO", 1)]
    assert jobs.compact_counts(spark, f"{out}/nothing") is None and jobs.current_counts(spark, f"{out}/nothing").isEmpty()
    first = got.where("event_count = 3").first()
    assert (first.orig_first_timestamp.second, first.orig_last_timestamp.second) == (1, 4)


def test_watermark_drops_late_rows_only(spark, session, tmp_path):
    topic, out = tmp_path / "topic", tmp_path / "out"
    feed(topic, "1", [message(1, 30)])
    counts_query(session, topic, out, watermark="10 minutes")
    feed(topic, "2", [message(2, 25), message(3, 5)])  # one in time, one too late
    counts_query(session, topic, out, watermark="10 minutes")
    assert table(jobs.current_counts(spark, f"{out}/messages")) == [("10:25", "INFO", 1), ("10:30", "INFO", 1)]


def test_processing_time_counts_every_row(spark, session, tmp_path):
    topic, out = tmp_path / "topic", tmp_path / "out"
    feed(topic, "1", [message(i, i) for i in range(5)])
    counts_query(session, topic, out, time="processing")
    got = jobs.current_counts(spark, f"{out}/messages")
    assert got.agg(F.sum("event_count")).first()[0] == 5


def test_append_without_watermark_is_refused(session, tmp_path):
    topic = tmp_path / "topic"
    feed(topic, "1", [message(1, 0)])
    rows = streams.rows_from_values(streams.directory_values(session, str(topic)), schema.STRUCTURED)
    with pytest.raises(Exception, match="watermark"):
        to_envelope(jobs.windowed_counts(rows)).writeStream.format("console").outputMode("append").start()


def test_archive_survives_restart(spark, session, tmp_path):
    topic, out = tmp_path / "topic", tmp_path / "out"
    for name, ids in (("1", (1, 2)), ("2", (3,)), ("3", ())):
        feed(topic, name, [message(i, 0)[:-1] + ',"log_date":"240101"}' for i in ids])
        rows = streams.rows_from_values(streams.directory_values(session, str(topic)), schema.STRUCTURED)
        jobs.run_to_end(jobs.archive_stream(rows, f"{out}/rows", f"{out}/checkpoint"))
    assert sorted(r.line_id for r in spark.read.parquet(f"{out}/rows").collect()) == [1, 2, 3]


def test_line_numbers(spark):
    first = 3 << 60  # far beyond what a shifted batch number would leave room for
    got = jobs.numbered_lines(spark.range(100).repartition(5), first).select("line_id").collect()
    assert sorted(r.line_id for r in got) == list(range(first, first + 100))


def test_line_numbers_of_many_uneven_tasks(spark):
    places = [(t, r) for t in range(0, 60_000, 2_000) for r in range(t % 7 + 1)] + [(1 << 30, r) for r in range(40)]
    placed = spark.createDataFrame(places, "_task bigint, _row bigint").repartition(4)
    ids = sorted(r.line_id for r in jobs.numbered_lines(placed, 5).collect())
    assert ids == [5 + i for i in range(len(places))]


def test_numbers_go_on_from_the_batch_before(spark, tmp_path):
    out = str(tmp_path)
    assert jobs.first_number(spark, out, 0) == 0
    with pytest.raises(ValueError):
        jobs.first_number(spark, out, 9)
    for batch in (8_388_608, 8_388_609, 8_388_610):
        jobs.keep_number(spark, out, batch, batch + 7)
        jobs.keep_number(spark, out, batch, 1)  # a replayed batch notes nothing new
    assert jobs.first_number(spark, out, 8_388_611) == 8_388_617
    assert jobs.first_number(spark, out, 8_388_610) == 8_388_616
    with pytest.raises(ValueError):
        jobs.first_number(spark, out, 8_388_609)


def test_three_queries_side_by_side(spark, session, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    feed(raw, "1.log", lines_of(0, ["a 1", "a 2"]))

    def rows():
        return streams.rows_from_values(streams.directory_values(session, f"{out}/structured/*"), schema.STRUCTURED)

    queries = jobs.live(
        streams.directory_values(session, str(raw)), rows, str(out), f"{out}/checkpoint",
        "1 second", "1 second", "1 second",
    )
    try:
        for name, more in (("2.log", ["a 3"]), ("3.log", ["b"])):
            feed(raw, name, lines_of(1, more))
            for query in queries:
                query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert sorted(r.content for r in spark.read.parquet(f"{out}/archive").collect()) == ["a 1", "a 2", "a 3", "b"]
    got = jobs.current_counts(spark, f"{out}/counts")
    assert got.agg(F.sum("event_count")).first()[0] == 4


def test_console_stream(session, tmp_path):
    feed(tmp_path / "in", "1", ["hello"])
    source = streams.directory_values(session, f"{tmp_path}/in")
    query = jobs.run_to_end(jobs.console_stream(source, f"{tmp_path}/c"))
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_points_stream_skips_bad_messages(spark, session, tmp_path):
    topic = tmp_path / "topic"
    good = '{"window_end":"2024-01-01T00:01:00.000Z","log_level":"INFO","event_count":3}'
    feed(topic, "1", [good, "not json"])
    values = streams.directory_values(session, str(topic))
    jobs.run_to_end(jobs.points_stream(values, "counts", f"{tmp_path}/p", f"{tmp_path}/c"))
    assert [r.value for r in spark.read.schema("value string").text(f"{tmp_path}/p").collect()] == [
        "metrics,level=INFO event_count=3i 1704067260000000000"
    ]


def test_console_display(store, capsys):
    store.select("log_level").limit(1).show()
    assert "log_level" in capsys.readouterr().out
