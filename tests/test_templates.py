import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.operators import templates as T
from cinderlog.operators.splitting import split_groups
from tests.drain import mine

VERBS = ["opening", "closing", "reading", "writing"]


def log(n, seed):
    pick = random.Random(seed)
    for i in range(n):
        yield pick.choice([
            f"Receiving block blk_{pick.randint(-9, 9)} src: /10.0.0.{i % 9}:50010 dest: /10.0.0.{i % 7}:50011",
            f"PacketResponder {pick.randint(0, 3)} for block blk_{i} terminating",
            f"user {pick.choice(['anna', 'bert', 'cleo'])} is {pick.choice(VERBS)} file number {i}",
            "threshold (300ms) passed once more",
            f"retry after {i} seconds, of at most 99 seconds in all",
            "stopped",
        ])


def structured(spark, contents, partitions=4):
    lines = spark.createDataFrame(list(enumerate(contents)), "line_id bigint, content string")
    shaped = T.with_shape(lines.repartition(partitions))
    return T.assign_templates(shaped, T.mine_templates(shaped))


def split(patterns, similarity=0.5):
    """The rule of merge_similar over the patterns of one leaf, one group after another."""
    rows = [p.split(" ") for p in patterns]
    words = [sorted({r[i] for r in rows}) for i in range(len(rows[0]))]
    cuts = [(len(w), i) for i, w in enumerate(words) if len(w) > 1]
    fixed = sum(len(w) == 1 and w[0] != K.WILDCARD for w in words)
    if not cuts or fixed >= similarity * len(words):
        return dict.fromkeys(patterns, " ".join(w[0] if len(w) == 1 else K.WILDCARD for w in words))
    at = min(cuts)[1]
    out = {}
    for word in words[at]:
        out |= split([p for p, r in zip(patterns, rows) if r[at] == word], similarity)
    return out


def split_leaves(patterns, similarity=0.5):
    leaves = {}
    for p in patterns:
        leaves.setdefault((p.count(" "), *p.split(" ")[:2]), []).append(p)
    return {p: t for leaf in leaves.values() for p, t in split(leaf, similarity).items()}


def by_line(df):
    return [r.event_template for r in df.orderBy("line_id").collect()]


def test_equals_sequential_mining(spark):
    contents = list(log(300, 1))
    assert by_line(structured(spark, contents)) == mine(contents, K.MASKS)


def test_order_and_partitions_do_not_matter(spark):
    contents = list(log(200, 2))
    want = dict(zip(contents, by_line(structured(spark, contents))))
    shuffled = contents[:]
    random.Random(5).shuffle(shuffled)
    for partitions in (1, 7):
        assert dict(zip(shuffled, by_line(structured(spark, shuffled, partitions)))) == want


def pattern_of(template):
    return "(.*?)".join(re.escape(p) for p in template.split(K.WILDCARD))


def test_every_line_matches_its_template(spark):
    """Also with leaves that are split several times."""
    pick = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    contents = list(log(60, 4)) + [
        " ".join(["job", "state"] + [pick.choice(words) for _ in range(6)]) for _ in range(200)
    ]
    rows = structured(spark, contents).collect()
    assert len(rows) == len(contents)
    for r in rows:
        found = re.fullmatch(pattern_of(r.event_template), re.sub(r"\s+", " ", r.content.strip()))
        assert found, (r.event_template, r.content)
        rebuilt = r.event_template
        for value in r.parameters:
            rebuilt = rebuilt.replace(K.WILDCARD, value, 1)
        assert rebuilt == re.sub(r"\s+", " ", r.content.strip())


def merged(spark, patterns, similarity=0.5):
    df = spark.createDataFrame([(p,) for p in patterns], "pattern string").repartition(3)
    return {r.pattern: r.template for r in T.merge_similar(df, similarity=similarity).collect()}


@pytest.mark.parametrize("seed, similarity", [(7, 0.5), (8, 0.7), (9, 1.0)])
def test_groups_are_split_by_the_rule(spark, seed, similarity):
    pick = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "eps", K.WILDCARD, "", "#77"]
    patterns = {" ".join([pick.choice("ab"), "state"] + [pick.choice(words) for _ in range(pick.choice([1, 4, 6]))])
                for _ in range(300)} | {"", "one", "one two"}
    assert merged(spark, patterns, similarity) == split_leaves(sorted(patterns), similarity)


@pytest.mark.parametrize("small", [0, 60, 400])
def test_large_groups_are_split_in_rounds(spark, monkeypatch, small):
    """The same templates wherever a group is split, and other columns pass through."""
    monkeypatch.setattr(T, "SMALL_GROUP", small)
    pick = random.Random(3)
    words = ["alpha", "beta", "gamma", K.WILDCARD, "", "#77"]
    patterns = sorted({" ".join([pick.choice("ab"), "state"] + [pick.choice(words) for _ in range(pick.choice([1, 4, 6]))])
                       for _ in range(150)} | {"", "one", "one two"})
    df = spark.createDataFrame(list(zip(patterns, range(len(patterns)))), "pattern string, n bigint")
    rows = T.merge_similar(df).collect()
    assert {r.pattern: r.template for r in rows} == split_leaves(patterns)
    assert sorted((r.pattern, r.n) for r in rows) == list(zip(patterns, range(len(patterns))))


def test_rounds_end_with_the_large_groups(spark, monkeypatch):
    """A leaf from which every split takes one pattern: as many splits as patterns, no round for each."""
    patterns = ["t u " + " ".join(f"{'a' if i < j else 'z'}{'x' if (i * 7 + j) % 11 else ''}" for j in range(30)) for i in range(30)]
    written, write = [], T.write_table
    monkeypatch.setattr(T, "write_table", lambda df, label: written.append(label) or write(df, label))
    assert merged(spark, patterns, 1.0) == split_leaves(sorted(patterns), 1.0)
    assert len(written) <= 4


def test_a_group_may_span_batches():
    rows = [("g", f"a {w}") for w in "xyz"] + [("h", "b"), ("i", "c d e"), ("i", "c d f")]
    batches = (pd.DataFrame(rows[i:i + 2], columns=["group", "pattern"]) for i in (0, 2, 4, 6))
    got = pd.concat(split_groups(0.5, K.WILDCARD)(batches))
    assert dict(zip(got["pattern"], got["template"])) == {
        "a x": "a <*>", "a y": "a <*>", "a z": "a <*>", "b": "b", "c d e": "c d <*>", "c d f": "c d <*>"}


def test_templates_depend_neither_on_counts_nor_on_order(spark):
    pick = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    contents = [" ".join(["job", "state"] + [pick.choice(words) for _ in range(6)]) for _ in range(200)]
    want = dict(zip(contents, by_line(structured(spark, contents))))
    assert want == split_leaves(sorted(set(contents)))
    more = contents[::-1] + contents[:30] * 5
    assert dict(zip(more, by_line(structured(spark, more, 1)))) == want


def test_large_leaf_becomes_one_template(spark):
    """Thousands of patterns of one leaf, all of one statement."""
    contents = [f"task {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} has come to its end" for i in range(1500)]
    got = set(by_line(structured(spark, contents)))
    assert got == set(contents)  # the varying word leads, so each has its own leaf
    same = [f"start task {c.split()[1]} now please" for c in contents]
    assert set(by_line(structured(spark, same))) == {"start task <*> now please"}


def test_a_leaf_is_spread_over_tasks(spark):
    """Words are counted per group and position with partial aggregation, never per group alone."""
    members = spark.createDataFrame([("a b c", "g")], "pattern string, group string")
    plan = T._position_words(members)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(group" in plan and "word" in plan.split("hashpartitioning(group")[-1].split("\n")[0]
    assert "collect_set" not in plan and "partial_count" in plan


def test_fixed_digit_tokens_stay(spark):
    got = by_line(structured(spark, ["limit 300ms kept 1 time", "limit 300ms kept 2 time"]))
    assert got == ["limit 300ms kept <*> time"] * 2
    assert by_line(structured(spark, ["only 1 line"])) == ["only 1 line"]


def test_empty_and_null_content(spark):
    rows = structured(spark, ["", None, "  ", "a"]).orderBy("line_id").collect()
    assert [r.event_template for r in rows] == ["", "", "", "a"]
    assert all(r.parameters == [] for r in rows)


def test_parameters(spark):
    cases = [
        ("a b", "a b", []), ("x <*> z", "x 1 z", ["1"]), ("at <*>, end", "at 1.2.3.4, end", ["1.2.3.4"]),
        ("<*>:<*>_<*> q", "BP-1:blk_7_9 q", ["BP-1", "blk", "7_9"]), ("<*> <*>", "a b", ["a", "b"]),
        ("k <*> v", "k one two v", ["one two"]), ("p(<*>)", "p()", [""]), (r"\Q.<*>$", r"\Q.a$", ["a"]),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "t string, c string")
    got = df.select(T.parameters(F.split("c", " "), F.split("t", " "))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_counting_hashes_and_never_sorts_lines(spark):
    lines = spark.createDataFrame([(1, "a 1")], "line_id bigint, content string")
    plan = T.skeletons(T.with_shape(lines))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_count" in plan


def test_catalogue_is_broadcast_when_small(spark):
    lines = spark.createDataFrame(list(enumerate(log(50, 9))), "line_id bigint, content string")
    shaped = T.with_shape(lines)
    plan = T.assign_templates(shaped, T.mine_templates(shaped))
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_same_rows_without_broadcast(spark):
    contents = list(log(100, 6))
    want = by_line(structured(spark, contents))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert by_line(structured(spark, contents)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
