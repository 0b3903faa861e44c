"""License scans: a trained paragraph classifier, confirmed by template comparison.

Paragraphs (lines) are sparse sets of word 1- and 2-grams. A multinomial logistic regression
over the licence families and a class "unknown" is trained on the driver from the licence
wordings, worn by random edits, and on a bounded sample of other paragraphs of the corpus; its
temperature is fitted on held-out examples, so that probabilities are calibrated. A
prediction counts where its probability is high enough and the paragraph's n-grams agree with
a template of that family, in a 2-gram at least. Workers hold every paragraph of every text
against the words and 2-grams of the templates, and score those that share a 2-gram.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.llm.common import WordHashes, chain, receive, send
from cinderlog.llm.licence_texts import OTHERS, TEMPLATES

# Documented bounds of the training: sampled paragraphs of the corpus, worn copies of a template.
OTHER_PARAGRAPHS, COPIES = 2000, 30
ROUNDS, RATE, DECAY = 150, 0.5, 1e-4
# What a confirmed paragraph needs: probability, and share of n-grams in common with a template.
PROBABILITY, AGREEMENT = 0.5, 0.6
BATCH_WORDS = 400_000
UNKNOWN = "unknown"
WORD = re.compile(r"[^\W_]+")


def paragraphs(text) -> list:
    """The non-blank lines of a text."""
    return [p for p in text.split("\n") if p and not p.isspace()] if isinstance(text, str) else []


def features(word_lists, hashes: WordHashes):
    """(row, hash) of the distinct 1- and 2-grams of each list of words."""
    sizes = np.array([len(w) for w in word_lists], np.int64)
    flat = hashes.array([w.encode() for ws in word_lists for w in ws])
    row = np.repeat(np.arange(len(sizes)), sizes)
    together = row[1:] == row[:-1] if len(row) else np.empty(0, bool)
    rows = np.concatenate([row, row[:-1][together]]) if len(row) else row
    grams = np.concatenate([flat, chain(flat[:-1], flat[1:])[together]]) if len(row) else flat
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.r_[True, (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])] if len(rows) else np.empty(0, bool)
    return rows[new], grams[new]


@dataclass
class Classifier:
    names: list           # families and UNKNOWN, sorted
    vocabulary: np.ndarray  # sorted hashes of known n-grams
    weights: np.ndarray   # [n-gram, class]
    bias: np.ndarray
    temperature: float
    templates: list       # (class number, set of hashes)
    words: dict           # word of a template -> hash
    pairs: np.ndarray     # sorted hashes of the 2-grams of the templates

    def candidates(self, word_lists) -> np.ndarray:
        """Numbers of the lists that share a 2-gram with a template, or are a single word of one."""
        sizes = np.array([len(w) for w in word_lists], np.int64)
        flat = np.fromiter((self.words.get(w, 0) for ws in word_lists for w in ws), np.uint64, int(sizes.sum()))
        row = np.repeat(np.arange(len(sizes)), sizes)
        side = np.flatnonzero((flat[1:] != 0) & (flat[:-1] != 0) & (row[1:] == row[:-1])) if len(flat) else np.empty(0, int)
        grams = chain(flat[side], flat[side + 1])
        at = np.minimum(np.searchsorted(self.pairs, grams), len(self.pairs) - 1)
        alone = np.flatnonzero((sizes == 1) & (np.bincount(row, flat != 0, len(sizes)) > 0))
        return np.union1d(row[side[self.pairs[at] == grams]], alone)

    def logits(self, n: int, rows, grams):
        """Scores of n paragraphs; weights are shared out by the root of their n-grams."""
        at = np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == grams
        size = np.maximum(np.bincount(rows, minlength=n), 1)
        out = np.zeros((n, len(self.names)))
        np.add.at(out, rows[known], self.weights[at[known]] / np.sqrt(size[rows[known]])[:, None])
        return out + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _worn(words: list, draw) -> list:
    """A copy of a wording with some words lost, doubled or from elsewhere, or cut short."""
    out = []
    for w in words:
        p = draw.random()
        if p > 0.04:
            out.append(w)
        if p > 0.97:
            out.append(f"w{draw.integers(1000)}")
    if len(out) > 12 and draw.random() < 0.3:
        cut = draw.integers(8, len(out))
        out = out[:cut] if draw.random() < 0.5 else out[-cut:]
    if draw.random() < 0.3:
        out = [f"w{draw.integers(1000)}" for _ in range(draw.integers(1, 4))] + out
    return out


def fit(others: list, copies: int = COPIES) -> Classifier:
    """others: paragraphs of no licence. One fifth of all examples sets the temperature."""
    draw, hashes = np.random.default_rng(11), WordHashes()
    names = sorted([*TEMPLATES, UNKNOWN])
    examples = []
    templates = []
    for family, wordings in TEMPLATES.items():
        for wording in wordings:
            words = WORD.findall(wording.lower())
            templates.append((names.index(family), set(features([words], hashes)[1].tolist())))
            examples += [(words, family)] * 5 + [(_worn(words, draw), family) for _ in range(copies)]
    for text in OTHERS:
        words = WORD.findall(text.lower())
        examples += [(words, UNKNOWN)] * 5 + [(_worn(words, draw), UNKNOWN) for _ in range(copies)]
    # Words of the wordings in no order: what a licence is not.
    bag = [w for ws in TEMPLATES.values() for x in ws for w in WORD.findall(x.lower())]
    examples += [([bag[i] for i in draw.integers(0, len(bag), draw.integers(3, 15))], UNKNOWN) for _ in range(400)]
    examples += [(WORD.findall(t.lower()), UNKNOWN) for t in others]
    order = draw.permutation(len(examples))
    lists = [examples[i][0] for i in order]
    label = np.array([names.index(examples[i][1]) for i in order])
    rows, grams = features(lists, hashes)
    vocabulary = np.unique(grams[np.isin(label[rows], [names.index(f) for f in TEMPLATES])])
    words = {w: hashes[w.encode()] for ws in TEMPLATES.values() for x in ws for w in WORD.findall(x.lower())}
    pairs = np.setdiff1d(np.array([g for _, own in templates for g in own], np.uint64), np.array(list(words.values()), np.uint64))
    model = Classifier(
        names, vocabulary, np.zeros((len(vocabulary), len(names))), np.zeros(len(names)), 1.0, templates, words, pairs)
    at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
    known = vocabulary[at] == grams
    size = np.maximum(np.bincount(rows, minlength=len(lists)), 1)
    r, c = rows[known], at[known]
    value = (1 / np.sqrt(size[r]))[:, None]
    by_column = np.argsort(c, kind="stable")
    columns, first = np.unique(c[by_column], return_index=True)
    train = np.arange(len(lists)) % 5 != 0
    target = np.eye(len(names))[label]
    square, square_b = np.full_like(model.weights, 1e-8), np.full_like(model.bias, 1e-8)
    for _ in range(ROUNDS):
        score = np.zeros((len(lists), len(names)))
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        score[r[starts]] = np.add.reduceat(model.weights[c] * value, starts)
        wrong = (softmax(score + model.bias) - target) * train[:, None]
        gradient = np.zeros_like(model.weights)
        gradient[columns] = np.add.reduceat((wrong[r] * value)[by_column], first)
        gradient = gradient / train.sum() + DECAY * model.weights
        slope = wrong.sum(axis=0) / train.sum()
        square += gradient ** 2
        square_b += slope ** 2
        model.weights -= RATE * gradient / np.sqrt(square)
        model.bias -= RATE * slope / np.sqrt(square_b)
    held = model.logits(len(lists), rows, grams)[~train]
    loss = {t: -np.log(softmax(held / t)[np.arange(len(held)), label[~train]] + 1e-12).mean()
            for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)}
    model.temperature = min(loss, key=loss.get)
    return model


def train(documents: DataFrame, others: int = OTHER_PARAGRAPHS) -> Classifier:
    """The classifier, with a bounded sample of paragraphs of the corpus (those whose hashes
    come first) as further examples of no licence. Paragraphs with a word of legal notices
    are not taken as such."""
    legal = r"(?i)licen[cs]|copyright|rights reserved|permission|public domain|redistribut|warrant|unlicense|creative commons|cc0"
    lines = documents.select(F.explode(F.split("text", "\n")).alias("line")).where(
        (F.length("line").between(20, 400)) & ~F.col("line").rlike(legal))
    drawn = lines.orderBy(F.xxhash64("line"), "line").limit(others).collect()
    return fit([r["line"] for r in drawn])


def _confirm(model: Classifier, number: int, grams: set) -> float:
    """Best agreement with a template of the class: n-grams in common over those of the
    shorter side, as long as the shorter side is no mere scrap of the longer one."""
    best = 0.0
    for owner, own in model.templates:
        if owner == number and own and grams:
            common = len(own & grams)
            best = max(best, common / max(min(len(own), len(grams)), 0.5 * max(min(len(own), 40), min(len(grams), 40))))
    return min(best, 1.0)


def judge(model: Classifier, texts, hashes: WordHashes):
    """For each text its paragraphs and the confirmed ones: (place, family, probability, agreement)."""
    lists, owner, place, counts = [], [], [], []
    for i, text in enumerate(texts):
        lines = paragraphs(text)
        counts.append(len(lines))
        for j, line in enumerate(lines):
            lists.append(WORD.findall(line.lower()))
            owner.append(i), place.append(j)
    found = [[] for _ in texts]
    picked = model.candidates(lists) if lists else []
    if len(picked):
        lists, owner, place = ([x[i] for i in picked] for x in (lists, owner, place))
        rows, grams = features(lists, hashes)
        chance = softmax(model.logits(len(lists), rows, grams) / model.temperature)
        best = chance.argmax(axis=1)
        bounds = np.searchsorted(rows, np.arange(len(lists) + 1))
        unknown = model.names.index(UNKNOWN)
        for p in np.flatnonzero((best != unknown) & (chance.max(axis=1) >= PROBABILITY)):
            own = set(grams[bounds[p]: bounds[p + 1]].tolist())
            agreement = _confirm(model, int(best[p]), own)
            if agreement >= AGREEMENT:
                found[owner[p]].append((place[p], model.names[best[p]], float(chance[p, best[p]]), agreement))
    return counts, found


def _scan(frames, shared, keys):
    model, hashes = receive(shared), WordHashes()
    for frame in frames:
        texts = frame["text"].tolist()
        rows, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < BATCH_WORDS * 6:
                size += len(texts[end] or "")
                end += 1
            for n, found in zip(*judge(model, texts[at:end], hashes)):
                rows.append((
                    n, len(found), ",".join(sorted({f[1] for f in found})), [f[0] for f in found],
                    max((f[2] for f in found), default=0.0), max((f[3] for f in found), default=0.0),
                ))
            at = end
        out = pd.DataFrame(rows, columns=["n_paragraphs", "n_licensed", "families", "places", "probability", "agreement"])
        yield pd.concat([frame[list(keys)].reset_index(drop=True), out], axis=1)


def scan(documents: DataFrame, model: Classifier, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns, n_paragraphs (non-blank lines), n_licensed (confirmed ones),
    families (names of their families, comma-joined; empty without any), places (numbers of
    these paragraphs, from 0), and the highest probability and agreement (0 without any).
    Null and empty texts have no paragraphs. Repeated rows are scanned each."""
    shared = send(documents.sparkSession, model)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keys).schema)
    return documents.select(*dict.fromkeys([*keys, "text"])).mapInPandas(
        lambda it: _scan(it, shared, keys),
        f"{kinds}, n_paragraphs long, n_licensed long, families string, places array<int>, "
        "probability double, agreement double",
    )
