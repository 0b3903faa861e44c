import pytest
from pyspark.sql import functions as F

from cinderlog.operators import ranking
from cinderlog.operators.ranking import _pieces, numbered, positions, rows_at, running_total, up_to, with_halo


@pytest.fixture(scope="module")
def table(spark):
    # One key holds most rows; the order column ties, the second one breaks ties.
    return spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"),
        (F.pmod(F.xxhash64("id"), F.lit(20))).alias("a"),
        F.col("id").alias("b"),
    )


@pytest.mark.parametrize("rows", [None, 400, 5000])
def test_positions_per_key(table, rows):
    got = positions(table, ["a", "b"], ["key"], rows)
    want = {}
    for r in sorted(table.collect(), key=lambda r: (r.key, r.a, r.b)):
        want.setdefault(r.key, []).append((r.a, r.b))
    seen = {(r.key, r.position): (r.a, r.b) for r in got.collect()}
    assert seen == {(k, i + 1): v for k, rows in want.items() for i, v in enumerate(rows)}


def test_hot_key_is_spread(table):
    """The key with 70% of the rows covers about 70% of the pieces, evenly."""
    pieces = _pieces(table, ["key", "a", "b"], rows=400).where("key = 'hot'").groupBy("_piece").count().collect()
    assert len(pieces) >= 5 and max(r["count"] for r in pieces) < 1500


@pytest.mark.parametrize("rows", [None, 400])
def test_running_total_without_key(table, rows):
    got = running_total(table, ["a", "b"], {"total": F.col("b")}, rows=rows).collect()
    total, want = 0, {}
    for r in sorted(table.collect(), key=lambda r: (r.a, r.b)):
        total += r.b
        want[r.b] = total
    assert {r.b: r.total for r in got} == want


@pytest.mark.parametrize("width", [1, 3, 100])
def test_numbered_rows_and_their_halo(table, width):
    unique = table.groupBy("key", "a", "b").count().where("a < 40")
    rows = numbered(unique, ["a", "b"], ["key"], unique.count())
    by_key = {}
    for r in sorted(rows.collect(), key=lambda r: (r.key, r.a, r.b)):
        by_key.setdefault(r.key, []).append(r)
    assert all([r.position for r in own] == list(range(1, len(own) + 1)) for own in by_key.values())
    want = set()
    for key, own in by_key.items():
        for piece in {r.piece for r in own}:
            last = max(r.position for r in own if r.piece == piece)
            want |= {(key, piece, r.position) for r in own if last < r.position <= last + width}
    halo = with_halo(rows, ["key"], width).where("not own").collect()
    assert len(halo) == len(want) > 0
    assert {(r.key, r.piece, r.position) for r in halo} == want


@pytest.fixture(params=[(4096, 10_000), (4, 30), (16, 1)])
def selection(request, monkeypatch):
    """Few buckets and few rows to look at: many passes over numbers and over ties."""
    for name, value in zip(("BUCKETS", "FEW"), request.param):
        monkeypatch.setattr(ranking, name, value)


@pytest.mark.parametrize("ratio", [0.0, 0.0001, 0.25, 0.8, 1.0])
def test_rows_at(table, selection, ratio):
    named = table.select("key", (F.col("a") * 10**15 - 7).alias("a"), F.concat(F.lit("é"), (F.col("b") % 900).cast("string")).alias("b"))
    rows = [(r.key, r.a, r.b) for r in named.collect()]
    want = sorted(((a, b) for _, a, b in rows), key=lambda r: (r[0], r[1].encode()))[: int(5000 * ratio)]
    bound = rows_at(named, F.col("a"), "b", ratio)[None]
    assert bound == (want[-1] if want else None)
    got = named.where(up_to(["a", "b"], bound and dict(zip("ab", bound)))).select("a", "b").collect()
    assert len(got) >= len(want) and {tuple(r) for r in got} == set(want)
    hot = named.withColumn("key", F.when(F.col("key") == "hot", "hot").otherwise("rest"))
    per_group = rows_at(hot, F.col("a"), "b", ratio, "key")
    for key in ("hot", "rest"):
        own = sorted(((a, b) for k, a, b in rows if (k == "hot") == (key == "hot")), key=lambda r: (r[0], r[1].encode()))
        n = int(len(own) * ratio)
        assert per_group[key] == (own[n - 1] if n else None)


def test_rows_at_of_no_rows(table):
    assert rows_at(table.limit(0).withColumn("b", F.lit("x")), F.col("a"), "b", 0.5) == {}
