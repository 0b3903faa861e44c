"""Quality forest, hard negatives and manifest: against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderlog.llm import hard_negatives, isolation, merkle
from cinderlog.llm.oracle import ORACLE

# -- quality rules

TEXTS = [None, "", "   \n\t ", "a b c a b c a b c", "x#y *$ |<>|\nx\nx\n x \n\nx", "é ü z Ω", "A b.\nA b.\nC",
         "w " * 70, "one two\x0bthree\x1cfour\x85five"]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 3)}
    lines = text.split("\n")
    again = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))


def test_counts_equal_plain_rules():
    draw = random.Random(2)
    made = [" ".join(draw.choice("a b c d # .") for _ in range(draw.randrange(60))) for _ in range(60)]
    made += ["\n".join(draw.choice(["a b", "a  b", "c#", "", " "]) for _ in range(draw.randrange(9))) for _ in range(40)]
    for text in TEXTS + made:
        assert isolation.statistics(text)[:5] == plain_counts(text), text


def plain_path(forest, node, row, depth=0):
    if forest.left[node] == node:
        return forest.path[node]
    go = forest.left if row[forest.statistic[node]] < forest.place[node] else forest.right
    return plain_path(forest, go[node], row, depth + 1)


def test_forest_scores_equal_a_walk_and_find_outliers():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(3000, 3))
    forest = isolation.grow(rows, 20)
    ask = np.r_[rows[:50], [[9.0, 9, 9], [-8, 0, 0]]]
    scores = forest.scores(ask)
    for row, score in zip(ask, scores):
        mean = np.mean([plain_path(forest, r, row) for r in forest.roots])
        assert score == pytest.approx(2 ** (-mean / forest.usual))
    assert scores[50] > scores[:50].max()
    assert isolation.mean_path(256) == pytest.approx(10.244, abs=0.01)
    for few in (np.empty((0, 3)), rows[:1], np.zeros((5, 3))):
        assert np.isfinite(isolation.grow(few).scores(ask)).all()


def test_documents_are_judged(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefg") for _ in range(draw.randrange(2, 9)))
    some = lambda: " ".join(word() for _ in range(draw.randrange(8, 30))).capitalize() + draw.choice([".", "", " x1."])
    good = ["\n".join(some() for _ in range(10)) for _ in range(300)]
    bad = [" ".join(w + "#" * draw.randrange(2, 9) for w in text.split()) for text in good[:12]]
    rows = [(i, t, "de") for i, t in enumerate(good + bad)] + [(900, t, "x") for t in TEXTS]
    rows += [(None, good[0], "x"), (1000, "word " * 200_000, "x"), (1, good[1], "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, anomaly string").withColumn("symbols", F.lit("s"))
    labels = spark.createDataFrame(
        [(i, int(i < 300)) for i in range(0, 312, 2)] + [(1, None), (None, 1), (0, 1)], "doc_id long, quality int")
    got = isolation.judge(spark, docs, labels).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert sum(by_id[i]["kept"] for i in range(300)) >= 297
    assert sum(by_id[i]["kept"] for i in range(300, 312)) <= 2
    assert not any(by_id[i]["base_failed"] for i in range(312))
    for r in got:
        words, repeated = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (words < 50 or 100 * repeated > 50 * words)
    assert by_id[1000]["n_words"] == by_id[1000]["n_repeat_words"] == 200_000
    assert isolation.judge(spark, docs, labels.limit(0)).where("not kept and not base_failed").isEmpty()
    assert isolation.judge(spark, docs.limit(0), labels).isEmpty()


def test_threshold_keeps_the_good(spark):
    rows = [(i, 100, 0, s) for i, s in enumerate([0.9, 0.8, 0.7, 0.7, 0.6, 0.5, 0.4, 0.3])]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_repeat_words long, anomaly double")
    labels = lambda bad: spark.createDataFrame([(i, int(i not in bad)) for i in range(8)], "doc_id long, quality int")
    assert isolation.calibrate(scored, labels({0, 1}), 1.0) == pytest.approx(0.75)
    assert isolation.calibrate(scored, labels({1, 7}), 1.0) == 2.0
    assert isolation.calibrate(scored, labels({1, 2}), 0.5) == pytest.approx(0.65)


def test_held_out_quality(spark):
    """A threshold from half of the labels drops the other half's bad documents, not its good."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = isolation.judge(spark, docs, labels.where("doc_id % 2 = 0"))
    seen = got.join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in seen}
    assert kept[1] >= 0.98 and kept[0] <= 0.1


# -- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def drawn_vectors(seed, n, width, scale=1.0, repeat=False):
    draw, out = random.Random(seed), []
    for i in range(n):
        v = [draw.choice([0.5, -0.25, 1.0, draw.uniform(-1, 1)]) * scale for _ in range(width)]
        if i % 3 == 0:
            v = [0.5 * scale] * width  # a third of the rows are equal
        spoil = draw.random()
        if spoil < 0.09:
            v = None if spoil < 0.03 else [None if spoil < 0.05 else float("nan") if spoil < 0.07 else float("inf"), *v[1:]]
        out.append((draw.choice([i, i, i * 100]) if repeat else i, v, draw.choice([None, 0, 1, 2, 9])))
    return out


@pytest.mark.parametrize("seed, width, scale, repeat, wave", [
    (1, 3, 1.0, False, 1 << 20), (2, 130, 1.0, False, 130 * 8), (3, 3, 1000.0, True, 1 << 20)])
def test_negatives_equal_sql(spark, tmp_path, seed, width, scale, repeat, wave):
    vectors = spark.createDataFrame(drawn_vectors(seed, 400, width, scale, repeat), VECTORS)
    vectors = vectors.withColumn("point", F.lit(1)).withColumn("rank", F.lit("x"))
    vectors.write.parquet(str(tmp_path / "v"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/v/*.parquet'")
    want = con.execute(ORACLE["op12_hard_negatives"])
    columns = [d[0] for d in want.description]
    got = hard_negatives.mine(spark, vectors, F.col("vec_id") % 100 == 0, wave_bytes=wave)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_residues_give_exact_scores():
    draw = np.random.default_rng(5)
    for size, width in ((300, 64), (10**6, 200), (2**50, 70)):
        a, b = (np.rint(draw.uniform(-size, size, (9, width))) for _ in "ab")
        bound = int(max((m * m).sum(1).max() for m in (a, b)) * (1 + 1e-9)) + 1
        r = hard_negatives.Residues(bound)
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert r.scores(r.split(a), r.split(b)).tolist() == want
        assert all(abs(m).max() <= p // 2 for m, p in zip(r.split(a), r.primes))
    assert hard_negatives.CHUNK * (hard_negatives.LARGEST_PRIME // 2) ** 2 < 2 ** 24


def test_no_negatives_without_rows(spark):
    asked = F.col("vec_id") % 100 == 0
    for rows in ([], [(100, None, 1)], [(0, [], 1)], [(100, [1.0], 1)], [(3, [1.0], 1), (4, [1.0], 2)]):
        assert hard_negatives.mine(spark, spark.createDataFrame(rows, VECTORS), asked).isEmpty()
    odd = spark.createDataFrame([(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [1.0], 2)], VECTORS)
    assert [tuple(r) for r in hard_negatives.mine(spark, odd, asked).collect()] == [(100, 1, 1, 2, 65536, 32768)]


# -- manifest

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: digest("".join(part(v) for v in (r[0], r[1], r[2], n, r[4])))

    def grown(level):
        levels = [level]
        while len(level) > 1:
            level = [digest("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
            levels.append(level)
        return levels

    def climbed(levels, at, folded):
        proof = ""
        for level in levels[:-1]:
            other = level[at ^ 1] if at ^ 1 < len(level) else ""
            folded = digest(other + folded if at & 1 else folded + other)
            proof, at = proof + other, at >> 1
        return proof, folded

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    runs = [sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[3]))) for g in langs]
    trees = [grown([leaf(r, r[3]) for r in run]) for run in runs]
    top = grown([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for g, (run, tree) in enumerate(zip(runs, trees)):
        for i, r in enumerate(run):
            hit = r[3] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            below, folded = climbed(tree, i, leaf(r, r[3] + hit if hit else r[3]))
            above, folded = climbed(top, g, folded)
            out.append((r[0], tree[0][i], tree[-1][0], root, digest(below + above), folded, folded == root))
    return out


def drawn_documents(seed, n, langs):
    draw = random.Random(seed)
    return [(draw.choice([None, draw.randrange(n), draw.randrange(10**9), -draw.randrange(99)]), draw.choice([None, "s"]), draw.choice(langs),
             draw.choice([None, 5, 2**63 - 1]), draw.choice([None, "", "é" * 9, "x"])) for _ in range(n)]


@pytest.mark.parametrize("n, langs, span", [
    (1, ["a"], 12), (2, [None], 12), (3, ["a", "b"], 12), (300, [None, "", "a", "é", "b"], 12),
    (260, ["a"] * 9 + ["b"], 6), (300, [chr(97 + i) for i in range(80)], 6)])
def test_manifest_equals_brute_force(spark, monkeypatch, n, langs, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = drawn_documents(n, n, langs)
    rows += rows[:n // 9]  # repeated rows are leaves of their own
    docs = spark.createDataFrame(rows, FIELDS).withColumn("leaf", F.lit(1)).withColumn("tree", F.lit("t"))
    got = merkle.manifest(docs, merkle.chosen_for_tampering()).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_manifest(rows)))


def test_what_climbs_is_one_row_per_group_of_leaves(spark, monkeypatch):
    met, climb = [], merkle.climb
    monkeypatch.setattr(merkle, "climb", lambda rows, nodes: met.append(rows.count()) or climb(rows, nodes))
    rows = [(i, "s", "ab"[i % 2], 1, "t") for i in range(600)]
    assert merkle.manifest(spark.createDataFrame(rows, FIELDS)).where("verified").count() == 600
    assert met == [2 * -(-300 // 2 ** merkle.STEP)]  # before: every leaf


def test_untampered_manifest_verifies(spark):
    rows = [(i, "s", "a", 1, "long " * 200_000 if i == 3 else "t") for i in range(5)]
    got = merkle.manifest(spark.createDataFrame(rows, FIELDS)).collect()
    assert len(got) == 5 and all(r["verified"] for r in got)
    assert merkle.manifest(spark.createDataFrame([], FIELDS)).isEmpty()
