"""Language ID by mixtures: expectation-maximisation over letter 3-gram likelihoods.

Spark counts the 3-grams of all training texts per language in a fixed number of hash
buckets, which bounds the model whatever the corpus. A text is a mixture of languages: EM
estimates the share of each from its 3-grams, for sets of languages found by adding, removing
and swapping, and the set with the best penalised likelihood (BIC) stands.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import mix, receive, send

BUCKETS = 1 << 16
# EM ends when no mixture can have a log-likelihood higher by GAP, or after ROUNDS.
SMOOTHING, ROUNDS, GAP = 0.5, 500, 0.05
BATCH_CHARS = 1_000_000
SPACE = 32


class Letters:
    """Lower-case code point of each letter, a space for all else."""

    def __init__(self):
        self.known = {}
        self.map = np.zeros(0x110000, np.uint32)
        self.done = np.zeros(0x110000, bool)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        new = np.unique(points[~self.done[points]])
        for p in new:
            low = chr(p).lower()
            self.map[p] = ord(low) if len(low) == 1 and low.isalpha() else p if chr(p).isalpha() else SPACE
        self.done[new] = True
        return self.map[points]


def grams(texts, letters: Letters):
    """(text number per 3-gram, bucket per 3-gram) of some texts: words of letters with a
    space on either side. A text without a letter has none."""
    points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) if isinstance(t, str) else np.empty(0, np.uint32) for t in texts]
    flat = np.concatenate([np.r_[np.uint32(SPACE), p, np.uint32(SPACE)] for p in points])
    owner = np.repeat(np.arange(len(points)), [len(p) + 2 for p in points])
    flat = letters(flat).astype(np.uint64)
    keep = (flat != SPACE) | np.r_[True, flat[:-1] != SPACE] | np.r_[True, owner[1:] != owner[:-1]]
    flat, owner = flat[keep], owner[keep]
    if len(flat) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = (flat[:-2] << np.uint64(42)) | (flat[1:-1] << np.uint64(21)) | flat[2:]
    # Within one text, and around a letter: "  x" of an empty run is no 3-gram.
    good = (owner[:-2] == owner[2:]) & (flat[1:-1] != SPACE)
    return owner[:-2][good], (mix(code[good]) >> np.uint64(48)).astype(np.int64)


def _batches(texts):
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if isinstance(t, str) else 0
        if size >= BATCH_CHARS:
            yield start, texts[start: i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


@dataclass
class Profiles:
    names: list
    chances: np.ndarray  # [bucket, language]


def _count(frames):
    letters = Letters()
    for frame in frames:
        names, which = np.unique(frame["lang"].to_numpy(str), return_inverse=True)
        texts = frame["text"].tolist()
        total = np.zeros(len(names) * BUCKETS, np.int64)
        for start, part in _batches(texts):
            owner, bucket = grams(part, letters)
            total += np.bincount(which[owner + start] * BUCKETS + bucket, minlength=len(total))
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"lang": names[hit // BUCKETS], "bucket": hit % BUCKETS, "n": total[hit]})


def train(spark: SparkSession, documents: DataFrame) -> Profiles:
    """From text and lang of all rows; rows without lang or without text teach nothing."""
    counts = documents.where("lang is not null and text is not null").select("lang", "text").mapInPandas(
        _count, "lang string, bucket long, n long"
    ).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows a language at most
    names = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(names)))
    table[counts["bucket"].astype(int), [names.index(x) for x in counts["lang"]]] = counts["n"]
    return Profiles(names, (table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * BUCKETS))


def shares(count: np.ndarray, chance: np.ndarray, share=None, enough=None):
    """EM: shares of the languages and the log-likelihood. count, chance: per distinct 3-gram.

    With D the sums of count * chance / mixture, no mixture has a log-likelihood that is higher by
    more than total * log(max(D) / total). EM goes on until that is under GAP, or until enough,
    called with the likelihood and this bound, is true."""
    total, k = count.sum(), chance.shape[1]
    share = np.full(k, 1 / k) if share is None else share
    for turn in range(ROUNDS):
        mixed = chance @ share
        gain = ((count / mixed) @ chance) / total
        if turn % 5 == 0:
            gap = total * np.log(max(gain.max(), 1.0))
            if gap < GAP or k == 1 or enough and enough(float(count @ np.log(mixed)), gap):
                break
        share = share * gain
    return share, float(count @ np.log(chance @ share))


def infer(buckets: np.ndarray, profiles: Profiles):
    """Language numbers and shares of a text, the largest share first.

    BIC is -2 * log-likelihood + log(3-grams) per language beyond the first. No mixture of m
    languages is better than the best of all languages but for that penalty: sizes beyond what
    can pay by this bound are not looked at. Within them the search starts from the best single
    language and from the largest shares of the full mixture, and adds, removes and swaps
    languages until no such move pays. Equal sets go to the one met first."""
    seen, count = np.unique(buckets, return_counts=True)
    chance = profiles.chances[seen]
    price, k = np.log(len(buckets)), chance.shape[1]
    single = count @ np.log(chance)
    first = int(np.argmax(single))
    best = -2 * float(single[first]), (first,), np.ones(1)
    if k == 1:
        return np.array([first]), best[2]
    upper = np.inf

    def certain(likelihood, gap):
        nonlocal upper
        upper = min(upper, likelihood + gap)
        return -2 * upper + price >= best[0]

    begin = np.full(k, 0.1 / (k - 1))
    begin[first] = 0.9
    full, _ = shares(count, chance, begin, certain)
    if -2 * upper + price >= best[0]:
        return np.array([first]), best[2]

    known = {best[1]: best}

    def judged(chosen):
        chosen = tuple(sorted(int(c) for c in chosen))
        if chosen not in known:
            share, likelihood = shares(count, chance[:, list(chosen)])
            known[chosen] = -2 * likelihood + (len(chosen) - 1) * price, chosen, share
        return known[chosen]

    def can_pay(size):
        return -2 * upper + (size - 1) * price < best[0]

    nested = [best]
    order = np.argsort(-full, kind="stable")
    for size in range(2, k + 1):
        if not can_pay(size):
            break
        nested.append(judged(order[:size]))
        best = min(best, nested[-1], key=lambda x: x[0])
    for state in (nested[0], min(nested, key=lambda x: x[0])):
        while True:
            _, chosen, share = state
            gain = (count / (chance[:, list(chosen)] @ share)) @ chance / len(buckets)
            # One more language raises the likelihood by this at most.
            more = [j for j in range(k) if j not in chosen and len(buckets) * np.log(gain[j]) > price / 2]
            others = [j for j in range(k) if j not in chosen and gain[j] > 1]
            moves = [(*chosen, j) for j in more] if can_pay(len(chosen) + 1) else []
            moves += [[c for c in chosen if c != out] for out in chosen if len(chosen) > 1]
            moves += [[*(c for c in chosen if c != out), j] for out in chosen for j in others]
            step = min(map(judged, moves), key=lambda x: x[0], default=state)
            if step[0] >= state[0]:
                break
            state = step
            best = min(best, state, key=lambda x: x[0])
    _, chosen, share = best
    chosen = np.array(chosen)
    order = np.lexsort((chosen, -share))
    return chosen[order], share[order]


def _predict(frames, shared, keys):
    profiles, letters = receive(shared), Letters()
    for frame in frames:
        rows = []
        for _, part in _batches(frame["text"].tolist()):
            owner, bucket = grams(part, letters)
            bounds = np.searchsorted(owner, np.arange(len(part) + 1))
            for i in range(len(part)):
                own = bucket[bounds[i]: bounds[i + 1]]
                if not len(own) or not profiles.names:
                    rows.append(("und", 0.0, [], []))
                    continue
                which, share = infer(own, profiles)
                names = [profiles.names[w] for w in which]
                rows.append((names[0], float(min(share[0], 1.0)), names, share.tolist()))
        out = frame[list(keys)].reset_index(drop=True)
        out["lang_pred"], out["score"], out["langs"], out["shares"] = (list(c) for c in zip(*rows)) if rows else ([],) * 4
        yield out


def predict(documents: DataFrame, profiles: Profiles, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns, lang_pred (language with the largest share), score (that
    share), langs and shares of the selected set. A null text, one without a letter, and
    any text when nothing was learned are und with score 0. Equal shares go to the first
    name. Repeated rows are predicted each."""
    shared = send(documents.sparkSession, profiles)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keys).schema)
    return documents.select(*dict.fromkeys([*keys, "text"])).mapInPandas(
        lambda it: _predict(it, shared, keys),
        f"{kinds}, lang_pred string, score double, langs array<string>, shares array<double>",
    )
