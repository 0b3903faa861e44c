import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cinderlog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def small_pieces(monkeypatch):
    """Ranking cuts even small tables into many pieces, as it does large ones."""
    from cinderlog.operators import ranking
    monkeypatch.setattr(ranking, "PIECE_ROWS", 40)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def store(spark, sf_dir):
    from cinderlog.checks.loglines import store
    return store(spark, sf_dir)


@pytest.fixture(scope="session")
def skewed_events(spark, store):
    """Block events, of which one block holds a third, many at the same second."""
    from pyspark.sql import functions as F

    from cinderlog.operators.sessions import block_events
    from cinderlog.session import write_table

    hot = F.col("line_id") % 3 == 0
    lines = store.withColumn(
        "content", F.when(hot, F.lit("Receiving block blk_77 now")).otherwise(F.col("content"))
    ).withColumn("event_time", F.when(hot, F.date_trunc("day", "event_time")).otherwise(F.col("event_time")))
    return write_table(block_events(lines), "skewed")
