import pytest

from cinderlog.__main__ import main, parser
from cinderlog.sources import files


def test_batch_jobs(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = [
        f"240101 0000{i:02d},1 INFO c: {verb} block blk_{i % 12} now"
        for i in range(60) for verb in (["open", "drop"] if i % 12 < 4 else ["open"])
    ]
    (raw / "a.log").write_text("\n".join(lines) + "\n")
    (tmp_path / "labels.csv").write_text(
        "BlockId,Label\n" + "".join(f"blk_{i},{'Anomaly' if i < 4 else 'Normal'}\n" for i in range(12))
    )
    out = {n: str(tmp_path / n) for n in ("logs", "reports", "model", "summary", "top", "export")}
    main(["structure", "--input", str(raw), "--output", out["logs"]])
    assert files.structured_parquet(spark, out["logs"]).count() == len(lines)
    main(["report", "--input", out["logs"], "--output", out["reports"]])
    main(["templates", "--input", out["logs"], "--output", out["top"], "--top", "1"])
    main(["train", "--input", out["logs"], "--labels", str(tmp_path / "labels.csv"), "--model", out["model"],
          "--split", "uniform", "--ratio", "0.75", "--export", out["export"]])
    main(["score", "--input", out["logs"], "--model", out["model"], "--output", out["summary"]])
    row = spark.read.option("header", True).csv(out["summary"]).first()
    assert (row.anomaly_count, row.block_ids_count) == ("4", "12")


def test_stream_jobs(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.log").write_text("240101 000000,1 INFO c: open 1\n240101 000059,1 WARN c: open 2\n")

    def run(job, source, target, *more):
        main([job, "--input", str(tmp_path / source), "--output", str(tmp_path / target),
              "--checkpoint", str(tmp_path / f"checkpoint-{job}-{target}"), *more])

    run("replay-stream", "raw", "copy", "--max-files", "1")
    run("structure-stream", "copy", "live")
    run("archive-stream", "live/structured/*", "archive")
    run("count-stream", "live/structured/*", "counts", "--time", "event", "--watermark", "1 hour")
    run("points-stream", "counts/*", "points", "--kind", "counts")
    run("points-stream", "live/metrics/*", "points2", "--kind", "batches")
    assert files.structured_parquet(spark, str(tmp_path / "archive")).count() == 2
    points = sorted(r.value for r in spark.read.schema("value string").text(str(tmp_path / "points")).collect())
    assert points == [
        "metrics,level=INFO event_count=1i 1704067260000000000", "metrics,level=WARN event_count=1i 1704067260000000000"
    ]
    assert "record_count=2i" in spark.read.schema("value string").text(str(tmp_path / "points2")).first().value


def test_job_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["train", "--input", "x"])
    args = parser().parse_args(["count-stream", "--input", "t", "--output", "u", "--checkpoint", "c", "--servers", "h:1",
                                "--max-offsets", "10000", "--trigger", "1 minute"])
    assert args.max_offsets == 10000 and args.time == "processing"
