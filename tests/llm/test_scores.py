"""Language-model, toxicity, language and licence operators against plain versions."""

import itertools
import math
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cinderlog.llm import kneser_ney, languages, licences, toxicity
from cinderlog.llm.common import mix, words
from cinderlog.llm.queries import QUERIES
from cinderlog.session import scratch_root

DOCS = "doc_id long, text string"


def plain_model(texts, order):
    """Modified Kneser-Ney over dictionaries of word tuples."""
    counts = {k: Counter() for k in range(1, order + 1)}
    raw = Counter()
    for text in texts:
        seq = [b"<s>", *words(text), b"</s>"]
        for i in range(1, len(seq)):
            raw[seq[i]] += 1
            k = min(order, i + 1)
            counts[k][tuple(seq[i - k + 1: i + 1])] += 1
    for k in range(order, 1, -1):
        for gram in list(counts[k]):
            counts[k - 1][gram[1:]] += 1
    discount = {k: kneser_ney.discounts([sum(c == n for c in counts[k].values()) for n in (1, 2, 3, 4)]) for k in counts}
    vocabulary = len(raw)

    def p(gram):
        k = len(gram)
        d = discount[k]
        cut = lambda c: c - d[min(c, 3) - 1] if c else 0
        if k == 1:
            total = sum(counts[1].values())
            if not total:
                return 1 / (vocabulary + 1)
            gamma = sum(c - cut(c) for c in counts[1].values()) / total
            return cut(counts[1][gram]) / total + gamma / (vocabulary + 1)
        same = [c for g, c in counts[k].items() if g[:-1] == gram[:-1]]
        if not same:
            return p(gram[1:])
        gamma = sum(d[min(c, 3) - 1] for c in same) / sum(same)
        return cut(counts[k][gram]) / sum(same) + gamma * p(gram[1:])

    def score(text):
        seq = [b"<s>", *words(text), b"</s>"]
        return sum(math.log10(p(tuple(seq[max(0, i - order + 1): i + 1]))) for i in range(1, len(seq)))

    return score, raw


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("range_grams", [1, 10**6])
def test_kneser_ney_equals_plain_version(spark, order, range_grams):
    texts = ["the cat sat", "the cat ran", "The dog sat on the cat", "a a a a", None, "", "the cat sat", "x\ty\nz  w"] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS)
    model = kneser_ney.train(spark, rows, order, range_grams=range_grams)
    asked = texts + ["unseen words the cat", "   ", "the the the " * 50]
    got = kneser_ney.score(spark.createDataFrame(list(enumerate(asked)), DOCS), model).orderBy("doc_id").collect()
    score, raw = plain_model(texts, order)
    total, size = sum(raw.values()), len(raw)
    for row, text in zip(got, asked):
        tokens = [*words(text), b"</s>"]
        assert row["n_tokens"] == len(tokens)
        assert row["n_known"] == sum(raw[t] > 0 for t in tokens)
        assert row["score"] == pytest.approx(score(text), rel=1e-5)
        assert row["base_score"] == pytest.approx(sum(math.log10((raw[t] + 1) / (total + size + 1)) for t in tokens))


def test_kneser_ney_query_scores_with_two_words_of_context(spark, tmp_path):
    texts = ["the cat sat", "a cat ran", "the cat sat down", "a cat ran off", "the dog sat"] * 8
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op1_kneser_ney"](spark, str(tmp_path)).collect()
    held = {r["doc_id"] for r in got if r["held_out"]}
    score, _ = plain_model([t for i, t in enumerate(texts) if i not in held], 3)
    assert len(got) == len(texts)
    for r in got:
        assert r["score"] == pytest.approx(score(texts[r["doc_id"]]), rel=1e-5)


@pytest.mark.parametrize("order, range_grams", [(2, 12), (3, 12), (4, 12), (4, 1), (4, 10**6)])
def test_kneser_ney_with_hot_and_other_words(spark, order, range_grams):
    draw = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in draw.zipf(1.6, 9) % 40) for _ in range(40)]
    model = kneser_ney.train(spark, spark.createDataFrame(list(enumerate(texts)), DOCS), order, range_grams=range_grams)
    assert range_grams > 12 or 0 < model.hot < model.vocabulary or range_grams == 1
    asked = texts + ["w1 w2 new w1 w1", "w3 w1 w2 w1 w1 w5"]
    got = kneser_ney.score(spark.createDataFrame(list(enumerate(asked)), DOCS), model).orderBy("doc_id").collect()
    score, _ = plain_model(texts, order)
    for row, text in zip(got, asked):
        assert row["score"] == pytest.approx(score(text), rel=1e-9)


def test_kneser_ney_takes_few_bytes_per_trigram(spark):
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in draw.integers(0, 3000, 500)) for _ in range(120)]
    folder = scratch_root(spark).removeprefix("file:")
    size = lambda: sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())
    before = size()
    kneser_ney.train(spark, spark.createDataFrame(list(enumerate(texts)), DOCS), 3)
    assert 0 < size() - before < 40 * 120 * 500  # nearly all trigrams and bigrams are there once


def test_kneser_ney_looks_up_distinct_ngrams(spark, monkeypatch):
    texts = ["the cat sat on the mat", "a cat ran", None, "", " the  cat sat\n"] * 40 + ["some dog ran on the cat"]
    model = kneser_ney.train(spark, spark.createDataFrame(list(enumerate(texts)), DOCS), 3)
    asked, following = [], kneser_ney._Part.following
    monkeypatch.setattr(kneser_ney._Part, "following", lambda part, at, last: asked.append(len(at)) or following(part, at, last))
    rows = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    run = lambda: pd.concat([b.to_pandas() for b in kneser_ney._score_task(iter([rows]), model)], ignore_index=True)
    whole = run()
    distinct = {(k, t[i - k + 1: i + 1]) for text in texts for t in [(b"<s>", *words(text), b"</s>")]
                for k in (2, 3) for i in range(k - 1, len(t))}
    assert sum(asked) == len(distinct)
    score, _ = plain_model(texts, 3)
    assert whole["score"].tolist() == pytest.approx([score(t) for t in texts], rel=1e-9)
    monkeypatch.setattr(kneser_ney, "BATCH_BYTES", 60)
    monkeypatch.setattr(kneser_ney, "BATCH_TOKENS", 9)
    pd.testing.assert_frame_equal(run(), whole)


def test_kneser_ney_cuts_texts_into_words():
    texts = [f" A{chr(i)}Bc{chr(i)} " for i in [*range(0x3100), 0x1F600] if not 0xD800 <= i < 0xE000]
    for some in (texts, [None, "", " \t", "x"], ["", None], [" "], []):
        for kind in (pa.string(), pa.large_string()):
            hashes, codes, lengths = kneser_ney._encode(pa.array(["no", *some], kind)[1:])
            assert lengths.tolist() == [len(words(t)) for t in some]
            flat = [w for t in some for w in words(t)]
            assert (hashes[codes] == kneser_ney._word_hashes(pa.array(flat, pa.binary()))).all()
            assert len(set(hashes[codes].tolist())) == len(set(flat))


def test_hashes_of_words_depend_on_their_bytes_only():
    many = [(b"ab\0" * 40)[:n] + end for n in range(100) for end in (b"", b"\0", b"x", b"\0\0")]
    many = list(dict.fromkeys(many))
    hashes = kneser_ney._word_hashes(pa.array(many))
    assert len(set(hashes.tolist())) == len(many)
    assert (kneser_ney._word_hashes(pa.array(many[::-1])) == hashes[::-1]).all()
    assert (kneser_ney._word_hashes(pa.array(many)[7:]) == hashes[7:]).all()


@pytest.mark.parametrize("size", [1, 5000, kneser_ney.PLAIN + 5])
def test_files_of_contexts(tmp_path, size):
    draw = np.random.default_rng(size)
    keys = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
    n = draw.integers(1, 6, len(keys))
    last = np.concatenate([np.sort(draw.choice(200_000 if i % 2 else 9, k, replace=False)) for i, k in enumerate(n)])
    counts = np.where(draw.random(len(last)) < 0.01, 70_000, draw.integers(1, 4, len(last)))
    first = np.cumsum(n) - n
    sums = [np.add.reduceat(x, first) for x in (counts, (counts == 1) * 1, (counts == 2) * 1, (counts >= 3) * 1)]
    kneser_ney._save_contexts(f"file://{tmp_path}/x", keys, sums, (n, last, counts))
    part = kneser_ney._Part(f"file://{tmp_path}/x")
    hit, place = part.find(mix(np.r_[keys, keys + np.uint64(1)]))
    assert set(range(len(keys))) <= set(hit.tolist())
    hit, place = part.find(mix(keys))
    which, table = part.sums(place)
    assert all((t[which] == s).all() for t, s in zip(table, sums))
    at = np.repeat(place, n)
    assert (part.following(at, last) == counts).all()
    there = set(zip(at.tolist(), last.tolist()))
    found = part.following(at, last + 1)
    assert all(bool(f) == ((a, w + 1) in there) for f, a, w in zip(found.tolist(), at.tolist(), last.tolist()))


def test_kneser_ney_without_texts(spark):
    none = spark.createDataFrame([], DOCS)
    model = kneser_ney.train(spark, none)
    row = kneser_ney.score(spark.createDataFrame([(None, "a b")], DOCS), model).first()
    assert (row["n_tokens"], row["n_known"], row["score"], row["base_score"]) == (3, 0, 0.0, 0.0)
    assert kneser_ney.score(none, model).count() == 0


def test_block_max_search_is_exact():
    draw = np.random.default_rng(1)
    terms = {f"t{i}": i for i in range(30)}
    rows = [{int(t): int(c) for t, c in zip(draw.choice(30, 4, replace=False), draw.integers(1, 5, 4))} for _ in range(300)]
    examples = pd.DataFrame({"counts": rows, "n": draw.integers(1, 4, 300), "toxic": 0, "doc_id": range(300)})
    examples["toxic"] = (draw.random(300) < 0.3) * examples["n"]
    index = toxicity.build(terms, draw.uniform(0.5, 3, 30), examples, (10, 1), 7)
    dense = np.zeros((300, 30))
    for i, c in enumerate(rows):
        n, w = index.vector(c)
        dense[i, n] = w
    for i in range(60):
        n, w = index.vector(rows[i])
        found, cosine = index.nearest(n, w, 7)
        every = dense @ dense[i]
        order = np.argsort(-every, kind="stable")
        reach = np.cumsum(index.count[order])
        border = every[order][np.searchsorted(reach, 7)]
        assert set(found) == set(np.flatnonzero((every >= border - 1e-9) & (every > 0)))
        assert np.allclose(cosine, every[found])


def test_toxicity_learns_words_and_leaves_others(spark):
    draw = np.random.default_rng(2)
    calm = [f"w{i}{chr(97 + i % 26)}{'abcdef'[i % 6]}" for i in range(200)]
    text = lambda bad: " ".join(list(draw.choice(calm, 30)) + (["vileling", "vileness"] if bad else []))
    rows = [(i, text(i % 5 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows + [(1000, None), (1001, ""), (None, "vileness " * 3), (0, rows[0][1])], DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(1, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    index = toxicity.train(spark, docs, labels)
    got = toxicity.score(docs, index).collect()
    assert len(got) == 404
    for row in got:
        bad = row["doc_id"] is None or row["doc_id"] < 400 and row["doc_id"] % 5 == 0
        assert (row["score"] >= 0.3) == bad and 0 <= row["score"] <= 1
        assert bool(row["neighbours"]) == bad


def test_toxicity_keeps_rare_words_that_tell_labels_apart(spark):
    draw = np.random.default_rng(4)
    calm = ["".join(draw.choice(list("abcdefghij"), 3)) for _ in range(100)]
    bad = lambda i: ["zorvexa"] if i < 4 else ["vileling"] if i < 20 else []
    text = lambda more: " ".join([*draw.choice(calm, 15), *more, *draw.choice(calm, 15)])
    docs = spark.createDataFrame([(i, text(bad(i))) for i in range(200)], DOCS)
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(200)], "doc_id long, toxic int")
    index = toxicity.train(spark, docs, labels)
    assert {"zorvexa", "vileling"} <= set(index.terms)
    row = toxicity.score(spark.createDataFrame([(900, text(["zorvexa"]))], DOCS), index).first()
    assert row["score"] >= 0.3 and set(row["neighbours"]) <= set(range(4)) and row["neighbours"]


def test_toxicity_learns_from_a_bounded_sample(spark):
    own = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, f"calm words x{own(i)}" + (" vileness" if i % 4 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows + [(3, rows[3][1]), (500, rows[3][1]), (None, "x"), (7, None)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(500, 1)], "doc_id long, toxic int")
    taken = toxicity._examples(docs, labels, 50).collect()
    every = toxicity._examples(docs, labels, 1000).collect()
    assert sorted(r["digest"] for r in taken) == sorted(r["digest"] for r in every)[:50]
    assert len(every) == 301  # 300 texts and the null one, read as empty
    assert {r["text"]: (r["doc_id"], r["toxic"]) for r in every}[rows[3][1]] == (3, 1)
    index = toxicity.train(spark, docs, labels, max_examples=100)
    assert index.count.sum() <= 100 and "vileness" in index.terms


def test_isotonic_pools_equal_votes():
    x, y = toxicity.isotonic(np.array([0.5, 0.5]), np.array([0.0, 1.0]), np.ones(2))
    assert x.tolist() == [0.5] and y.tolist() == [0.5]
    x, y = toxicity.isotonic(np.array([0.1, 0.5, 0.5, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.array([1.0, 1, 3, 1]))
    assert x.tolist() == [0.1, 0.5, 0.9] and y.tolist() == [0.0, 0.25, 1.0]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], DOCS)
    index = toxicity.train(spark, docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, index).first()["score"] == 0.5


def test_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = languages.train(spark, docs.where("doc_id % 2 = 0"))
    got = languages.predict(docs.where("doc_id % 2 = 1"), profiles, ("doc_id", "lang")).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 %$ 3"), (None, "und der die")], DOCS)
    rows = {r["doc_id"]: r for r in languages.predict(odd, profiles).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert rows[None]["lang_pred"] == "de"
    empty = languages.train(spark, docs.limit(0))
    assert {r["lang_pred"] for r in languages.predict(odd, empty).collect()} == {"und"}


def test_language_mixture_finds_both_parts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) > 600")
    profiles = languages.train(spark, docs)
    part = {r["lang"]: r["text"] for r in docs.select("lang", F.substring("text", 1, 600).alias("text")).collect()}
    mixed = spark.createDataFrame([(1, part["de"] + " " + part["fr"])], DOCS)
    row = languages.predict(mixed, profiles).first()
    assert set(row["langs"]) >= {"de", "fr"} and 0.3 < row["score"] < 0.7


def test_em_likelihood_never_falls():
    draw = np.random.default_rng(3)
    chance = draw.dirichlet(np.ones(50), 3).T
    count = draw.integers(1, 9, 50)
    share, best = languages.shares(count, chance)
    grid = [(a / 20, b / 20, 1 - (a + b) / 20) for a in range(21) for b in range(21 - a)]
    assert best >= max(float(count @ np.log(chance @ np.array(g) + 1e-300)) for g in grid) - 0.05
    assert share.sum() == pytest.approx(1)


def test_language_sets_are_the_best_of_all():
    """Against every set, with one language close to two others."""
    draw = np.random.default_rng(8)
    base = draw.dirichlet(np.full(400, 0.3), 4) + 1e-4
    base = np.vstack([base, 0.5 * base[0] + 0.5 * base[1]])
    chances = (base / base.sum(axis=1, keepdims=True)).T
    profiles = languages.Profiles(list("abcde"), chances)
    worse = 0
    for trial in range(120):
        chosen = draw.choice(5, draw.integers(1, 4), replace=False)
        mixed = chances[:, chosen] @ draw.dirichlet(np.ones(len(chosen)))
        buckets = draw.choice(400, draw.integers(30, 400), p=mixed / mixed.sum())
        seen, count = np.unique(buckets, return_counts=True)

        def cost(own):
            _, likelihood = languages.shares(count, chances[np.ix_(seen, list(own))])
            return -2 * likelihood + (len(own) - 1) * np.log(len(buckets))

        every = [cost(own) for n in range(1, 6) for own in itertools.combinations(range(5), n)]
        found, share = languages.infer(buckets, profiles)
        assert share.sum() == pytest.approx(1) and list(share) == sorted(share, reverse=True)
        worse += cost(sorted(found)) > min(every) + 0.2
    assert worse == 0


def test_licences(spark):
    model = licences.fit(["Plain words about the weather of today.", "Another line of an invented story."] * 20)
    texts = {
        1: "Intro line\nLicensed under the Apache License, Version 2.0.\nmore", 2: "All rights reserved.",
        3: "Licensed under CC BY-SA 4.0.", 4: "He lost his driving license in May.", 5: None, 6: "", 7: " \n\n ",
        8: "Released under the MIT Licence\nThis work is licensed under the GNU General Public License, version 3 only",
    }
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(list(texts.items()), DOCS), model).collect()}
    assert [got[i]["families"] for i in (1, 2, 3, 4, 5, 6, 7)] == ["apache", "proprietary", "cc-by-sa", "", "", "", ""]
    assert (got[1]["places"], got[1]["n_paragraphs"], got[7]["n_paragraphs"]) == ([1], 3, 0)
    assert "gpl" in got[8]["families"]


def test_licence_wordings_held_out_accuracy():
    model = licences.fit([])
    draw, right, n = np.random.default_rng(99), 0, 0
    for family, wordings in licences.TEMPLATES.items():
        for wording in wordings:
            worn = " ".join(licences._worn(licences.WORD.findall(wording), draw))
            _, ((found),) = licences.judge(model, [worn], licences.WordHashes())
            right += any(f[1] == family for f in found)
            n += 1
    assert right / n > 0.85
