"""Every operator as a query over the given tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog import schema
from cinderlog.checks import loglines as L
from cinderlog.functions.envelope import from_envelope, to_envelope
from cinderlog.functions.text import first_integer, item, split_list
from cinderlog.functions.times import epoch_instant, iso_instant, log_timestamp, month_key
from cinderlog.operators import evaluate, features, series, sessions, splits, templates
from cinderlog.operators.parse import accepted, parse_header
from cinderlog.operators.ranking import positions
from cinderlog.plans import anomaly, reports
from cinderlog.plans.structuring import structure
from cinderlog.session import scratch_path, write_table
from cinderlog.sources import files, sinks, streams
from cinderlog.streaming import jobs
from cinderlog.streaming.catalogue import known_templates, publish_templates, restated

HEADER = ["log_date", "log_time", "pid", "log_level", "component", "content"]


def text(column, name=None):
    """Time as text, so that no engine's time zone handling enters the comparison."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name or column)


def joined(column, name=None, sep="|"):
    return F.array_join(column, sep).alias(name or column)


# Parsing

def header_parse(spark, sf):
    return accepted(parse_header(L.raw(spark, sf))).select("line_id", *HEADER)


def text_log_scan(spark, sf):
    path = scratch_path(spark, "rawlogs")
    L.raw(spark, sf).select("value").write.text(path)
    return accepted(parse_header(files.raw_lines(spark, path))).select(*HEADER)


def line_identity(spark, sf):
    """Lines of a folder of files, read under two split sizes: ids and how many lines agree."""
    path, read = scratch_path(spark, "rawlogs"), []
    L.raw(spark, sf).select("value").write.text(path)
    for size in ("64k", "1m"):
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", size)
        session.conf.set("spark.sql.files.openCostInBytes", "1k")
        read.append(spark.read.parquet(write_table(files.raw_lines(session, path), "lines").inputFiles()[0].rpartition("/")[0]))
    first, second = read
    both = first.join(second.withColumnRenamed("value", "other"), "line_id", "full_outer")
    return both.agg(
        F.count("*").alias("n_lines"), F.countDistinct("line_id").alias("n_ids"),
        F.count_if(F.col("value") == F.col("other")).alias("n_equal"))


def rejected_lines(spark, sf):
    """Document lines are no log lines; whatever fits the header grammar is accepted."""
    lines = files.spread(L.table(spark, sf, "documents")).select(
        F.col("doc_id").alias("line_id"), F.explode(F.split("text", "\n")).alias("value")
    )
    parsed = parse_header(lines)
    return parsed.groupBy(F.col("line_id").alias("doc_id")).agg(
        F.count("*").alias("n_lines"), F.count_if(~F.col("is_valid")).alias("n_rejected")
    )


def event_timestamp(spark, sf):
    parsed = accepted(parse_header(L.raw(spark, sf)))
    time = log_timestamp(F.col("log_date"), F.col("log_time"))
    return parsed.select(
        "line_id", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        month_key(F.col("log_date")).alias("month"),
    )


# Template mining

def log_templates(spark, sf):
    return templates.template_table(structure(L.raw(spark, sf))[0])


def structured_lines(spark, sf):
    rows = structure(L.raw(spark, sf))[0]
    return rows.select(
        "line_id", *HEADER, text("event_time"), "event_id", "event_template", joined("parameters")
    )


def document_templates(spark, sf):
    """Templates of all document lines: leaves of many patterns that have to be split."""
    lines = files.spread(L.table(spark, sf, "documents")).select(F.explode(F.split("text", "\n")).alias("content"))
    counted = templates.with_shape(lines, masks=()).groupBy(F.col("shape").alias("pattern")).agg(F.count("*").alias("n"))
    return templates.merge_similar(counted).groupBy("template").agg(
        F.count("*").alias("n_patterns"), F.sum("n").alias("n_lines"), F.min("pattern").alias("first_pattern"))


def template_topk(spark, sf):
    return templates.template_counts(L.store(spark, sf), 3)


def skeleton_topk(spark, sf):
    parsed = accepted(parse_header(L.raw(spark, sf)))
    counted = templates.content_skeletons(parsed, "content")
    return counted.orderBy(F.desc("n_lines"), "skeleton").limit(50)


def document_skeletons(spark, sf):
    """Line skeletons of the documents: every number hidden."""
    documents = files.spread(L.table(spark, sf, "documents"))
    lines = documents.select(F.explode(F.split("text", "\n")).alias("line"))
    return templates.content_skeletons(lines, "line", masks=("[0-9]+",))


# Reports

def severity_report(spark, sf):
    return reports.severity(L.store(spark, sf))


def exceptions_report(spark, sf):
    return reports.exceptions(L.store(spark, sf))


def write_latency_report(spark, sf):
    return reports.write_latency(L.store(spark, sf)).select(
        F.round("average_write_latency", 6).alias("average_write_latency")
    )


def transfer_speed_report(spark, sf):
    return reports.transfer_speed(L.store(spark, sf)).withColumn(
        "speed_mib_s", F.round("speed_mib_s", 6)
    )


def retry_report(spark, sf):
    return reports.retries(L.store(spark, sf))


def retry_report_by_parameter(spark, sf):
    return reports.retries(L.store(spark, sf), param_index=1)


def monthly_severity_report(spark, sf):
    return reports.monthly_severity(L.store(spark, sf))


def report_files(spark, sf):
    """Structured Parquet by date -> report -> CSV -> read back."""
    base = scratch_path(spark, "reports")
    sinks.write_structured(L.store(spark, sf), f"{base}/structured")
    structured = files.structured_parquet(spark, f"{base}/structured")
    reports.write_all(structured, base)
    return spark.read.schema("log_level string, month string, total_records bigint, distinct_eventid bigint").option(
        "header", True
    ).csv(f"{base}/monthly")


def report_set(spark, sf):
    """All six reports, written and read back, as report, key and number; the speeds summed up."""
    base = scratch_path(spark, "reports")
    sinks.write_structured(L.store(spark, sf), f"{base}/structured")
    reports.write_all(files.structured_parquet(spark, f"{base}/structured"), base)
    back = lambda name: spark.read.option("header", True).csv(f"{base}/{name}")
    tagged = lambda df, name, key, number: df.select(
        F.lit(name).alias("report"), key.alias("key"), number.cast("double").alias("number"))
    severity = back("severity").select(F.inline(F.array(*[
        F.struct(F.lit(level.lower()).alias("key"), F.col(level.lower()).alias("number")) for level in K.LEVELS])))
    speeds = back("speed").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("speed_mib_s").cast("double")), 2).alias("total")
    ).select(F.inline(F.array(
        F.struct(F.lit("lines").alias("key"), F.col("n").cast("double").alias("number")),
        F.struct(F.lit("sum").alias("key"), F.col("total").alias("number")))))
    monthly = back("monthly")
    parts = [
        tagged(back("exceptions"), "exceptions", F.col("log_date"), F.col("event_count")),
        tagged(severity, "severity", F.col("key"), F.col("number")),
        tagged(back("slowness"), "slowness", F.lit("average"), F.round(F.col("average_write_latency").cast("double"), 6)),
        tagged(speeds, "speed", F.col("key"), F.col("number")),
        tagged(back("retrycount"), "retrycount", F.col("retrycount"), F.col("event_count")),
        tagged(monthly, "monthly", F.concat_ws(" ", "log_level", "month"), F.col("total_records")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def structured_csv(spark, sf):
    path = scratch_path(spark, "csvlogs")
    sinks.write_csv(L.store(spark, sf), path)
    return files.structured_csv(spark, path).select(
        "line_id", "log_level", "content", "event_id", text("event_time"), joined("parameters")
    )


# Blocks and sessions

def block_endpoints(spark, sf):
    return reports.block_endpoints(L.store(spark, sf)).select(
        "line_id", "first_block_id", "source", "destination",
        "source_ip", "source_port", "destination_ip", "destination_port",
    )


def _events(spark, sf):
    return sessions.block_events(L.store(spark, sf))


def block_events(spark, sf):
    return _events(spark, sf).select("block_id", "line_id", "event_id", text("event_time"))


# Small enough that some blocks have several parts and some one.
PART = 5


def block_sessions(spark, sf):
    return sessions.session_parts(_events(spark, sf), PART).select(
        "block_id", "part", "own_events", joined("event_sequence", sep=",")
    )


def _labels(spark, sf):
    """Labels as the CSV file they come in."""
    path = scratch_path(spark, "labels")
    sinks.write_csv(L.labels(spark, sf), path)
    return files.label_csv(spark, path)


def _heads(spark, sf):
    return sessions.with_labels(sessions.session_heads(_events(spark, sf)), _labels(spark, sf))


def labelled_sessions(spark, sf):
    parts = sessions.session_parts(_events(spark, sf), PART)
    return sessions.with_labels(parts, _labels(spark, sf)).select(
        "block_id", "part", "label", joined("event_sequence", sep=",")
    )


def split_sequential(spark, sf):
    return splits.flag_sessions(write_table(_heads(spark, sf), "heads"), 0.8).select(
        "block_id", F.col("is_train").cast("int").alias("is_train")
    )


def split_stratified(spark, sf):
    heads = write_table(_heads(spark, sf), "heads")
    return splits.flag_sessions(heads, 0.8, "uniform").select(
        "block_id", "label", F.col("is_train").cast("int").alias("is_train")
    )


def split_complement(spark, sf):
    """Train, test, and the test set again as a difference and as an anti-join."""
    heads = write_table(_heads(spark, sf).select("block_id", "first_time", "label"), "heads")
    train, test = splits.split_sessions(heads, 0.8, "uniform")
    parts = [
        train.withColumn("part", F.lit("train")),
        test.withColumn("part", F.lit("test")),
        splits.distinct_difference(heads, train).withColumn("part", F.lit("difference")),
        heads.join(train.select("block_id"), "block_id", "left_anti").withColumn("part", F.lit("anti")),
        train.unionByName(test).distinct().withColumn("part", F.lit("union")),
    ]
    every = parts[0]
    for other in parts[1:]:
        every = every.unionByName(other)
    return every.groupBy("part").agg(F.count("*").alias("n"), F.sum("label").alias("n_anomalous"))


def session_head(spark, sf):
    """The first 100 sessions by time."""
    return splits.first_rows(_heads(spark, sf), ["first_time", "block_id"], 100).select(
        "block_id", text("first_time"), "n_events", "label"
    )


def shuffled_sessions(spark, sf):
    """Every session with its place in a repeatable shuffle."""
    keyed = _heads(spark, sf).withColumn("shuffle_key", splits.shuffle_key("block_id", 7))
    return positions(keyed, ["shuffle_key", "block_id"]).select("block_id", "label", "position")


def sequence_slices(spark, sf):
    """Slices of train and test sessions, with the session's label."""
    events = write_table(_events(spark, sf), "events")  # the contents are read once
    heads = sessions.with_labels(sessions.session_heads(events), _labels(spark, sf))
    chosen = splits.flag_sessions(write_table(heads, "heads"), 0.8).select(
        "block_id", "label", F.col("is_train").cast("int").alias("is_train"))
    return sessions.session_slices(events, chosen, 3, PART).select(
        "block_id", "part", "label", "is_train", "start", joined("event_sequence", sep=","), "next_event"
    )


# Time series

def _counts(spark, sf):
    return series.level_counts(L.store(spark, sf))


def _count_columns(counts):
    return counts.select(
        text("window_start"), text("window_end"), "log_level", "event_count",
        text("orig_first_timestamp"), text("orig_last_timestamp"),
    )


def level_counts_1m(spark, sf):
    return _count_columns(_counts(spark, sf))


def _batch_metrics(spark, sf):
    """The events in runs of 500 as if each run were a micro-batch."""
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    runs = L.table(spark, sf, "events").groupBy(
        F.floor(F.col("event_id") / 500).cast("string").alias("batch_id")
    ).agg(
        F.count("*").alias("record_count"),
        (cents / F.lit(100000.0)).alias("latency"),
        F.min(F.unix_seconds(F.col("ts").cast("timestamp"))).cast("double").alias("timestamp"),
    )
    rate = F.floor(F.col("record_count") / F.col("latency") * 1000.0) / 1000.0
    return runs.withColumn("throughput", F.when(F.col("latency") > 0, rate).otherwise(0.0))


def latest_per_level(spark, sf):
    return series.latest_per_level(_counts(spark, sf)).select(
        "log_level", text("window_end"), "event_count"
    )


def count_trend(spark, sf):
    """The last seven days."""
    counts = write_table(_counts(spark, sf), "counts")
    end = counts.agg(F.max("window_end")).first()[0]
    stop = F.lit(end)
    return series.count_trend(counts, stop - F.expr("interval 7 days"), stop).select(
        "log_level", text("window_end"), "event_count"
    )


def mean_per_interval(spark, sf):
    """Means per quarter of an hour over the whole time range, empty ones null."""
    metrics = _batch_metrics(spark, sf).withColumn("time", F.timestamp_seconds("timestamp"))
    low, high = metrics.agg(F.min("timestamp"), F.max("timestamp")).first()
    fields = ["latency", "throughput", "record_count"]
    means = series.mean_per_interval(metrics, "time", fields, int(low), int(high) + 1, 900)
    return means.select(
        text("interval_start"), *[F.round(f"mean_{f}", 6).alias(f"mean_{f}") for f in fields]
    )


def points_counts(spark, sf):
    """Counts -> JSON message -> line protocol."""
    messages = to_envelope(_counts(spark, sf))
    return series.count_points(from_envelope(messages, schema.LEVEL_COUNTS))


def message_instants(spark, sf):
    """Times inside messages, as instants again: ISO text, and epoch seconds."""
    counts = to_envelope(_counts(spark, sf).select("window_end")).distinct()
    iso = iso_instant(F.get_json_object("value", "$.window_end"))
    runs = to_envelope(_batch_metrics(spark, sf))
    epoch = epoch_instant(F.get_json_object("value", "$.timestamp").cast("double"))
    both = counts.select(F.lit("window_end").alias("kind"), iso.alias("time")).unionByName(
        runs.select(F.lit("timestamp").alias("kind"), epoch.alias("time"))
    )
    return both.select("kind", text("time"))


def points_metrics(spark, sf):
    messages = to_envelope(_batch_metrics(spark, sf))
    return series.batch_points(from_envelope(messages, schema.BATCH_METRICS))


def json_roundtrip(spark, sf):
    rows = from_envelope(to_envelope(L.store(spark, sf)), schema.STRUCTURED)
    return rows.select("line_id", "log_level", "content", text("event_time"), joined("parameters"))


def parameter_items(spark, sf):
    """The parameters as a printed list, taken apart again."""
    printed = F.concat(F.lit("['"), F.array_join("parameters", "', '"), F.lit("']"))
    items = L.store(spark, sf).select("line_id", split_list(printed).alias("items"))
    return items.select(
        "line_id", F.size("items").alias("n_items"), item(F.col("items"), 0).alias("first_item"),
        item(F.col("items"), 1).alias("second_item"),
        first_integer(F.array_join("items", " ")).alias("first_integer"),
    )


def json_props(spark, sf):
    return L.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k")
    )


# Streams

def in_time_pieces(df: DataFrame, time: str, pieces=3):
    """Consecutive time ranges of a table, for a replay in time order."""
    seconds = F.unix_seconds(time)
    marks = df.select(seconds.cast("double").alias("t")).approxQuantile(
        "t", [i / pieces for i in range(1, pieces)], 0.01
    )
    bounds = [None, *sorted(set(int(m) for m in marks)), None]
    for low, high in zip(bounds, bounds[1:]):
        piece = df
        if low is not None:
            piece = piece.where(seconds >= low)
        if high is not None:
            piece = piece.where(seconds < high)
        yield piece


def _messages(spark, sf, run):
    """Feed the structured rows as messages, piece by piece, and call run after each: every
    piece is a restart of the streams from their checkpoints."""
    path = scratch_path(spark, "topic")
    for piece in in_time_pieces(L.store(spark, sf), "event_time"):
        sinks.write_messages(piece, path)
        run(path)


def _read_messages(session, path):
    return streams.rows_from_values(streams.directory_values(session, path), schema.STRUCTURED)


def stream_level_counts(spark, sf):
    session, out = jobs.stream_session(spark), scratch_path(spark, "counts")

    def run(path):
        counts = jobs.windowed_counts(_read_messages(session, path), watermark="1 hour")
        jobs.run_to_end(jobs.counts_stream(counts, f"{out}/messages", f"{out}/checkpoint"))

    _messages(spark, sf, run)
    return _count_columns(jobs.current_counts(spark, f"{out}/messages"))


def _archived(spark, sf):
    """One topic, two readers: the archive, and the counts beside it; the output folder."""
    session, out = jobs.stream_session(spark), scratch_path(spark, "archive")

    def run(path):
        archive = jobs.archive_stream(
            _read_messages(session, path), f"{out}/rows", f"{out}/checkpoint-rows"
        )
        counts = jobs.windowed_counts(_read_messages(session, path), time="processing")
        beside = jobs.counts_stream(counts, f"{out}/counts", f"{out}/checkpoint-counts")
        for query in (archive, beside):
            jobs.run_to_end(query)

    _messages(spark, sf, run)
    return out


def stream_archive(spark, sf):
    return files.structured_parquet(spark, f"{_archived(spark, sf)}/rows").select(
        "line_id", *HEADER, "event_id", joined("parameters")
    )


def stream_side_counts(spark, sf):
    """What the second reader counted by time of arrival, per level, from a snapshot of the
    updates: its windows differ from run to run, their sums do not."""
    counts = f"{_archived(spark, sf)}/counts"
    jobs.compact_counts(spark, counts)
    return jobs.current_counts(spark, counts).groupBy("log_level").agg(F.sum("event_count").alias("event_count"))


def _raw_stream(spark, sf):
    """Raw lines replayed into a watched directory and structured; the output folder."""
    session, out = jobs.stream_session(spark), scratch_path(spark, "structuring")
    lines = parse_header(L.raw(spark, sf)).select("value", "event_time")
    for piece in in_time_pieces(write_table(lines, "lines"), "event_time"):
        piece.select("value").write.mode("append").text(f"{out}/files")
        source = streams.directory_values(session, f"{out}/files")
        jobs.run_to_end(jobs.replay_stream(source, f"{out}/raw", f"{out}/checkpoint-replay"))
        source = streams.directory_values(session, f"{out}/raw")
        jobs.run_to_end(jobs.structure_stream(source, out, f"{out}/checkpoint"))
    return session, out


def replay_stream(spark, sf):
    _, out = _raw_stream(spark, sf)
    values = spark.read.schema("value string").text(f"{out}/structured")
    return from_envelope(values, schema.STRUCTURED).select(*HEADER)


def stream_templates(spark, sf):
    """Templates of the stream's rows after a re-mined version was published."""
    _, out = _raw_stream(spark, sf)
    publish_templates(spark, f"{out}/catalogue")
    values = spark.read.schema("value string").text(f"{out}/structured")
    rows = restated(from_envelope(values, schema.STRUCTURED), known_templates(spark, f"{out}/catalogue"))
    return templates.template_counts(rows)


def stream_line_ids(spark, sf):
    """Lines that three batches numbered, rejects included: running numbers without gaps."""
    _, out = _raw_stream(spark, sf)
    rows = from_envelope(spark.read.schema("value string").text(f"{out}/structured"), schema.STRUCTURED)
    ids = rows.select("line_id").unionByName(spark.read.parquet(f"{out}/rejects").select("line_id"))
    return ids.agg(F.count("*").alias("n_lines"), F.countDistinct("line_id").alias("n_ids"),
                   F.min("line_id").alias("first_id"), F.max("line_id").alias("last_id"))


def stream_batch_metrics(spark, sf):
    """Metrics of the structuring stream, published as points and read back."""
    session, out = _raw_stream(spark, sf)
    messages = streams.directory_values(session, f"{out}/metrics/*")
    jobs.run_to_end(jobs.points_stream(messages, "batches", f"{out}/points", f"{out}/checkpoint-points"))
    points = spark.read.schema("value string").text(f"{out}/points")
    counted = F.regexp_extract("value", r"record_count=(\d+)i", 1).cast("bigint")
    return points.agg(F.sum(counted).alias("record_count"))


def stream_batch_points(spark, sf):
    """One row per batch and measure that the structuring stream published. How long a batch took
    differs from run to run: of latency and throughput, their product is shown, the lines."""
    session, out = _raw_stream(spark, sf)
    messages = streams.directory_values(session, f"{out}/metrics/*")
    jobs.run_to_end(jobs.points_stream(messages, "batches", f"{out}/points", f"{out}/checkpoint-points"))
    points = spark.read.schema("value string").text(f"{out}/points")
    number = lambda name: F.regexp_extract("value", rf"{name}=([0-9.Ee+-]+)", 1).cast("double")
    measures = points.select(
        F.regexp_extract("value", r"batch_id=(\d+)", 1).cast("long").alias("batch_id"),
        F.inline(F.array(
            F.struct(F.lit("record_count").alias("measure"), number("record_count").alias("lines")),
            F.struct(F.lit("latency x throughput").alias("measure"),
                     F.round(number("latency") * number("throughput")).alias("lines")),
        )))
    # Batches are cut at quantiles of time; what they sum to is what both engines know.
    return measures.groupBy("measure").agg(
        F.count("*").alias("n_batches"), F.max("batch_id").alias("last_batch"), F.sum("lines").cast("long").alias("lines"))


def stream_points(spark, sf):
    """Windowed counts of the whole table as one stream batch, as points."""
    session, out = jobs.stream_session(spark), scratch_path(spark, "points")
    sinks.write_messages(L.store(spark, sf), f"{out}/topic")
    counts = jobs.windowed_counts(_read_messages(session, f"{out}/topic"))
    jobs.run_to_end(jobs.counts_stream(counts, f"{out}/counts", f"{out}/checkpoint-counts"))
    messages = streams.directory_values(session, f"{out}/counts/*")
    jobs.run_to_end(jobs.points_stream(messages, "counts", f"{out}/points", f"{out}/checkpoint-points"))
    return spark.read.schema("value string").text(f"{out}/points").select("value")


# Features and classifier

def _words(spark, sf):
    words = F.split(F.lower("text"), "[^a-z]+")
    documents = files.dealt(L.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    exploded = documents.select("doc_id", F.explode(words).alias("term"))
    return exploded.where("term <> ''")


def _term_counts(spark, sf):
    return features.term_counts(_words(spark, sf), "doc_id", "term")


def _document_weights(spark, sf):
    counts = write_table(_term_counts(spark, sf), "terms")
    n = L.table(spark, sf, "documents").count()
    idf = write_table(features.idf_weights(counts, n, "term"), "idf")
    return features.tfidf(counts, idf, "term"), idf, n


def term_frequency(spark, sf):
    return _term_counts(spark, sf)


def idf_weights(spark, sf):
    n = L.table(spark, sf, "documents").count()
    return features.idf_weights(_term_counts(spark, sf), n, "term").select(
        "term", "df", F.round("idf", 6).alias("idf")
    )


def tfidf(spark, sf):
    weighted, _, _ = _document_weights(spark, sf)
    return weighted.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def tfidf_centered(spark, sf):
    weighted, idf, n = _document_weights(spark, sf)
    return features.centred(weighted, n, "term", means=features.term_means(idf, n, "term")).select(
        "doc_id", "term", F.round("centred", 6).alias("centred"),
        F.round("baseline", 6).alias("baseline"),
    )


def tfidf_ratio(spark, sf):
    weighted, _, _ = _document_weights(spark, sf)
    return weighted.select(
        "doc_id", "term", F.round(features.ratio(F.col("tfidf")), 6).alias("ratio")
    )


def session_tfidf(spark, sf):
    """Term weights of the block sessions."""
    counts = write_table(features.term_counts(_events(spark, sf)), "terms")
    n = counts.select("block_id").distinct().count()
    weighted = features.tfidf(counts, features.idf_weights(counts, n))
    return weighted.select("block_id", "event_id", "tf", F.round("tfidf", 6).alias("tfidf"))


def confusion_metrics(spark, sf):
    """Low quality as a prediction of toxicity."""
    rows = L.table(spark, sf, "labels").select(
        F.col("toxic").alias("label"), (F.col("quality") == 0).cast("int").alias("prediction")
    )
    return evaluate.confusion(rows).select(
        "tp", "fp", "tn", "fn",
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
    )


def roc_auc(spark, sf):
    """Document length as a score of toxicity."""
    scored = L.table(spark, sf, "labels").join(
        L.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    return evaluate.roc_auc(scored, "n_chars", "toxic").select(F.round("roc_auc", 6).alias("roc_auc"))


def _trained(spark, sf, split_type="sequential", export=False):
    base = scratch_path(spark, "model")
    _, metrics = anomaly.train(
        L.store(spark, sf), _labels(spark, sf), f"{base}/model", split_type=split_type,
        export_path=base if export else None,
    )
    return base, metrics


def anomaly_train_metrics(spark, sf):
    """Uniform split, so that both labels are in the test part."""
    return _trained(spark, sf, "uniform")[1]


def anomaly_predictions(spark, sf):
    base, _ = _trained(spark, sf)
    return anomaly.score(spark, L.store(spark, sf), f"{base}/model")


def anomaly_summary(spark, sf):
    """Trained, saved, loaded, applied to every block, counted, written as CSV."""
    base, _ = _trained(spark, sf)
    predictions = anomaly.score(spark, L.store(spark, sf), f"{base}/model")
    sinks.write_report(anomaly.summary(predictions), f"{base}/anomaly_count")
    return spark.read.schema("anomaly_count bigint, block_ids_count bigint").option(
        "header", True
    ).csv(f"{base}/anomaly_count").select("block_ids_count")


# Weighting and normalisation of the features that the classifier is trained on.
VARIANTS = [("tf-idf", None), ("tf-idf", "ratio"), ("tf-idf", "zero-mean"), (None, None), (None, "zero-mean")]


def _learnable_labels(spark, sf):
    """Labels that follow from the log, as the CSV file they come in: a block is anomalous if no
    line receives or writes it. What a trained model must answer is then known."""
    store, path = L.store(spark, sf), scratch_path(spark, "learnable")
    served = F.col("content").startswith("Receiving block") | F.col("content").startswith("src: ")
    per_block = sessions.block_events(store).select("block_id", F.lit(0).alias("served")).unionByName(
        sessions.block_events(store.where(served)).select("block_id", F.lit(1).alias("served")))
    sinks.write_csv(per_block.groupBy(F.col("block_id").alias("BlockId")).agg(
        F.when(F.max("served") == 1, "Normal").otherwise("Anomaly").alias("Label")), path)
    return files.label_csv(spark, path)


def anomaly_learned_metrics(spark, sf):
    """Test metrics of a model per weighting and normalisation, all trained on the same sessions."""
    vectors = anomaly.session_vectors(L.store(spark, sf), _learnable_labels(spark, sf))
    train_part, test_part = splits.split_sessions(vectors, 0.8, "uniform")
    found = []
    for weighting, normalization in VARIANTS:
        model = anomaly.fit(train_part, weighting, normalization)
        metrics = anomaly.evaluate(write_table(anomaly.predict(model, test_part), "predictions"))
        found.append(metrics.select(
            F.lit(f"{weighting}, {normalization}").alias("features"), "tp", "fp", "tn", "fn",
            *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")]))
    return reduce(DataFrame.unionByName, found)


def _learned(spark, sf):
    """Predictions for every block by a model that was saved and loaded again."""
    path = f"{scratch_path(spark, 'model')}/model"
    anomaly.train(L.store(spark, sf), _learnable_labels(spark, sf), path, split_type="uniform")
    return anomaly.score(spark, L.store(spark, sf), path)


def anomaly_learned_predictions(spark, sf):
    return _learned(spark, sf).select(
        "block_id", "prediction", (F.col("raw_margin") > 0).cast("int").alias("over_margin"))


def anomaly_learned_summary(spark, sf):
    """The counts of anomalous and of all blocks, written as CSV and read back."""
    path = f"{scratch_path(spark, 'summary')}/anomaly_count"
    sinks.write_report(anomaly.summary(_learned(spark, sf)), path)
    return spark.read.schema("anomaly_count bigint, block_ids_count bigint").option("header", True).csv(path)


def train_test_export(spark, sf):
    """The exported train and test files, read back."""
    base, _ = _trained(spark, sf, export=True)
    fields = "block_id string, part bigint, event_sequence string, label int"

    def read(name):
        rows = spark.read.schema(fields).option("header", True).option("escape", '"').csv(f"{base}/{name}")
        return rows.withColumn("is_train", F.lit(int(name == "train_data")))

    return read("train_data").unionByName(read("test_data")).select(
        "block_id", "label", "is_train",
        joined(F.from_json("event_sequence", "array<string>"), "event_sequence", ","),
    )


_NAMES = (
    "header_parse text_log_scan rejected_lines event_timestamp "
    "log_templates structured_lines document_templates template_topk skeleton_topk document_skeletons "
    "severity_report exceptions_report write_latency_report transfer_speed_report "
    "retry_report retry_report_by_parameter monthly_severity_report report_files structured_csv "
    "block_endpoints block_events block_sessions labelled_sessions "
    "split_sequential split_stratified split_complement session_head shuffled_sessions sequence_slices "
    "level_counts_1m latest_per_level count_trend mean_per_interval "
    "message_instants points_counts points_metrics json_roundtrip json_props parameter_items "
    "stream_level_counts stream_archive replay_stream stream_templates stream_batch_metrics "
    "stream_line_ids stream_side_counts stream_batch_points report_set line_identity "
    "stream_points term_frequency idf_weights tfidf tfidf_centered tfidf_ratio session_tfidf "
    "confusion_metrics roc_auc anomaly_train_metrics anomaly_predictions anomaly_summary "
    "train_test_export anomaly_learned_metrics anomaly_learned_predictions anomaly_learned_summary"
).split()

QUERIES = {name: globals()[name] for name in _NAMES}
