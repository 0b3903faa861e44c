import pytest
from pyspark.sql import functions as F

from cinderlog.operators import sessions as S
from cinderlog.operators import splits as P


@pytest.fixture(scope="module")
def expected(skewed_events):
    found = {}
    rows = skewed_events.collect()
    for r in sorted(rows, key=lambda r: (r.event_time, r.line_id)):
        found.setdefault(r.block_id, []).append(r.event_id)
    assert len(found["blk_77"]) > len(rows) / 4
    return found


@pytest.mark.parametrize("part_size", [1, 7, 100, 100_000])
def test_parts_make_the_whole_session(skewed_events, expected, part_size):
    got = {}
    parts = S.session_parts(skewed_events, part_size).orderBy("block_id", "part").collect()
    for r in parts:
        assert len(r.event_sequence) == r.own_events <= part_size
        got.setdefault(r.block_id, []).extend(r.event_sequence)
    assert got == expected


@pytest.mark.parametrize("width,part_size", [(1, 1), (3, 3), (3, 5), (4, 100), (4, 100_000)])
def test_slices(skewed_events, expected, width, part_size):
    want = sorted(
        (block, i, tuple(seq[i : i + width]), seq[i + width] if i + width < len(seq) else "#Pad")
        for block, seq in expected.items()
        for i in range(len(seq) - width + 1)
    )
    got = S.slices(skewed_events, width, part_size).collect()
    assert sorted((r.block_id, r.start, tuple(r.event_sequence), r.next_event) for r in got) == want


def test_short_sessions_give_no_slices(spark):
    events = spark.createDataFrame(
        [("short", 1, "a"), ("short", 2, "b"), ("equal", 1, "a"), ("equal", 2, "b"), ("equal", 3, "c"),
         ("long", 3, "c"), ("long", 1, "a"), ("long", 2, "b"), ("long", 4, "d")],
        "block_id string, line_id bigint, event_id string",
    ).withColumn("event_time", F.lit(None).cast("timestamp"))
    got = {(r.block_id, tuple(r.event_sequence), r.next_event) for r in S.slices(events, 3).collect()}
    assert got == {
        ("equal", ("a", "b", "c"), "#Pad"), ("long", ("a", "b", "c"), "d"), ("long", ("b", "c", "d"), "#Pad"),
    }


def test_bad_arguments(spark, skewed_events):
    with pytest.raises(ValueError):
        S.slices(skewed_events, 0)
    with pytest.raises(ValueError):
        S.session_parts(skewed_events, 2, lookahead=3)
    heads = S.session_heads(skewed_events)
    with pytest.raises(ValueError):
        P.split_sessions(heads, 0.5, "other")
    with pytest.raises(ValueError):
        P.split_sessions(heads, 0.5, "uniform")  # no label
    with pytest.raises(ValueError):
        P.split_sessions(heads, 0.5, "sequential", window="fixed")


@pytest.fixture(scope="module")
def heads(spark, skewed_events):
    from cinderlog.session import write_table
    names = [r.block_id for r in S.session_heads(skewed_events).orderBy("block_id").limit(9).collect()]
    labels = spark.createDataFrame(
        [(n, "Anomaly" if i % 2 else "Normal") for i, n in enumerate(names)] + [("blk_x", "Anomaly")],
        "BlockId string, Label string",
    )
    return write_table(S.with_labels(S.session_heads(skewed_events), labels), "heads")


def test_labels(heads):
    assert heads.agg(F.sum("label")).first()[0] == 4
    assert heads.where("label IS NULL OR block_id = 'blk_x'").count() == 0


@pytest.mark.parametrize("kind", ["sequential", "uniform"])
@pytest.mark.parametrize("ratio", [0.0, 0.5, 0.8, 1.0])
def test_split_sizes(heads, kind, ratio):
    train, test = P.split_sessions(heads, ratio, kind)
    a, b = {r.block_id for r in train.collect()}, {r.block_id for r in test.collect()}
    assert not a & b and len(a) + len(b) == heads.count()
    if kind == "sequential":
        assert len(a) == int(heads.count() * ratio)
        if a and b:
            assert train.agg(F.max("first_time")).first()[0] <= test.agg(F.min("first_time")).first()[0]
    else:
        n1 = heads.where("label = 1").count()
        assert train.where("label = 1").count() == int(n1 * ratio)
        assert train.where("label = 0").count() == int((heads.count() - n1) * ratio)
    again, _ = P.split_sessions(heads.repartition(3), ratio, kind)
    assert {r.block_id for r in again.collect()} == a


def test_one_class_only(heads):
    train, test = P.split_sessions(heads.where("label = 0"), 0.5, "uniform")
    assert train.count() == heads.where("label = 0").count() // 2


def test_shuffle_is_repeatable(heads):
    def order(df, seed=1):
        return [r.block_id for r in P.repeatable_shuffle(df, "block_id", seed).collect()]
    assert order(heads) == order(heads.repartition(5))
    assert order(heads) != order(heads, seed=2) and sorted(order(heads)) == sorted(order(heads, 2))
