"""Jobs for spark-submit: python -m cinderlog <job> --help."""

import argparse

from cinderlog import schema
from cinderlog.operators.templates import template_counts
from cinderlog.plans import anomaly, reports
from cinderlog.plans.structuring import structure_files
from cinderlog.session import build_session
from cinderlog.sources import files, sinks, streams
from cinderlog.streaming import jobs
from cinderlog.streaming.catalogue import publish_templates


def _values(spark, args, topic, reader=""):
    """A topic if a broker is given, else the directory of that name. reader: whose limits hold,
    where there are several; the general ones stand in for those not given."""
    def limit(name):
        own = getattr(args, f"{reader}_{name}", None)
        return getattr(args, name) if own is None else own

    if args.servers:
        return streams.topic_values(
            spark, args.servers, topic, max_offsets=limit("max_offsets"),
            starting_offsets=limit("starting_offsets"), fail_on_data_loss=not args.tolerate_data_loss,
        )
    return streams.directory_values(spark, topic, limit("max_files"))


def structure(spark, args):
    structure_files(spark, args.input, args.output, args.rejects)


def report(spark, args):
    chosen = {}
    for choice in args.template or []:
        name, found, text = choice.partition("=")
        if not found or name not in reports.CHOICES:
            raise SystemExit(f"report: --template takes name=text with a name of {', '.join(reports.CHOICES)}")
        chosen[name] = text
    reports.write_all(files.structured_parquet(spark, args.input), args.output, chosen)


def templates(spark, args):
    counts = template_counts(files.structured_parquet(spark, args.input), args.top)
    if args.output:
        # The whole list has a row per template and keeps its files.
        sinks.write_report(counts, args.output, single_file=args.top is not None)
    elif args.top is not None:
        counts.show(args.top, truncate=False)
    else:
        raise SystemExit("templates: give --top, or --output for the whole list")


def train(spark, args):
    read = files.structured_csv if args.csv else files.structured_parquet
    _, metrics = anomaly.train(
        read(spark, args.input), files.label_csv(spark, args.labels), args.model, ratio=args.ratio,
        split_type=args.split, normalization=args.normalization, export_path=args.export,
        slice_width=args.slices,
    )
    metrics.show()


def score(spark, args):
    predictions = anomaly.score(spark, files.structured_parquet(spark, args.input), args.model)
    sinks.write_report(anomaly.summary(predictions), args.output)


def _topic_sinks(args):
    if not args.servers:
        return {}
    return dict(
        rows_sink=jobs.topic_sink(args.servers, args.rows_topic),
        metrics_sink=jobs.topic_sink(args.servers, args.metrics_topic),
    )


def structure_stream(spark, args):
    lines = _values(jobs.stream_session(spark), args, args.input)
    return jobs.structure_stream(lines, args.output, args.checkpoint, args.trigger, **_topic_sinks(args))


def _rows(session, args, source, reader=""):
    return streams.rows_from_values(_values(session, args, source, reader), schema.STRUCTURED)


def live(spark, args):
    """structuring, archive and counts in one application"""
    session = jobs.stream_session(spark)
    published = args.rows_topic if args.servers else f"{args.output}/structured/*"
    jobs.live(
        _values(session, args, args.input), lambda: _rows(session, args, published, "archive"), args.output,
        args.checkpoint, args.trigger or "0 seconds", count_rows=lambda: _rows(session, args, published, "count"),
        counts_to=(args.servers, args.counts_topic) if args.servers else None, **_topic_sinks(args),
    )
    session.streams.awaitAnyTermination()


def archive_stream(spark, args):
    rows = _rows(jobs.stream_session(spark), args, args.input)
    return jobs.archive_stream(rows, args.output, args.checkpoint, args.trigger)


def count_stream(spark, args):
    rows = _rows(jobs.stream_session(spark), args, args.input)
    counts = jobs.windowed_counts(rows, args.time, args.watermark)
    if args.servers:
        return jobs.counts_topic(counts, args.servers, args.output, args.checkpoint, args.trigger)
    return jobs.counts_stream(counts, args.output, args.checkpoint, args.trigger)


def points_stream(spark, args):
    values = _values(jobs.stream_session(spark), args, args.input)
    return jobs.points_stream(values, args.kind, args.output, args.checkpoint, args.trigger)


def remine(spark, args):
    """mine a stream's templates anew and publish them as the next version"""
    print(publish_templates(spark, f"{args.input}/catalogue"))


def compact_counts(spark, args):
    """fold a folder of count updates into a snapshot"""
    print(jobs.compact_counts(spark, args.input))


def replay_stream(spark, args):
    values = streams.directory_values(spark, args.input, args.max_files)
    return jobs.replay_stream(values, args.output, args.checkpoint, args.trigger)


def parser():
    top = argparse.ArgumentParser(prog="cinderlog")
    commands = top.add_subparsers(required=True)

    def command(run, *required, stream=False):
        sub = commands.add_parser(run.__name__.replace("_", "-"), help=run.__doc__)
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        if stream:
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--trigger", help="processing-time interval; default: take what is there and stop")
            sub.add_argument("--servers", help="Kafka brokers; input and output then name topics")
            sub.add_argument("--max-offsets", type=int)
            sub.add_argument("--starting-offsets")
            sub.add_argument("--tolerate-data-loss", action="store_true")
            sub.add_argument("--max-files", type=int)
        return sub

    command(structure, "input", "output").add_argument("--rejects")
    command(report, "input", "output").add_argument(
        "--template", action="append", metavar="NAME=TEXT",
        help=f"template of a report ({', '.join(reports.CHOICES)}) in place of the usual one; may be repeated")
    sub = command(templates, "input")
    sub.add_argument("--output")
    sub.add_argument("--top", type=int)
    sub = command(train, "input", "labels", "model")
    sub.add_argument("--csv", action="store_true", help="structured logs are CSV, not Parquet")
    sub.add_argument("--ratio", type=float, default=0.8)
    sub.add_argument("--split", default="sequential", choices=["sequential", "uniform"])
    sub.add_argument("--normalization", choices=["zero-mean", "ratio", "sigmoid"])
    sub.add_argument("--export", help="folder for the train and test sets as CSV")
    sub.add_argument("--slices", type=int, help="export runs of so many events instead of sessions")
    command(score, "input", "model", "output")
    for run in (structure_stream, live):
        sub = command(run, "input", "output", stream=True)
        sub.add_argument("--rows-topic", default="structured")
        sub.add_argument("--metrics-topic", default="batch_metrics")
        if run is live:
            sub.add_argument("--counts-topic", default="level_counts")
            for reader in ("archive", "count"):
                sub.add_argument(f"--{reader}-max-offsets", type=int, help=f"limit of the {reader} reader alone")
                sub.add_argument(f"--{reader}-max-files", type=int)
                sub.add_argument(f"--{reader}-starting-offsets")
    command(archive_stream, "input", "output", stream=True)
    sub = command(count_stream, "input", "output", stream=True)
    sub.add_argument("--time", default="processing", choices=["processing", "event"])
    sub.add_argument("--watermark")
    command(points_stream, "input", "output", stream=True).add_argument(
        "--kind", required=True, choices=["counts", "batches"]
    )
    command(replay_stream, "input", "output", stream=True)
    command(remine, "input")
    command(compact_counts, "input")
    return top


def main(argv=None):
    args = parser().parse_args(argv)
    query = args.run(build_session(), args)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
