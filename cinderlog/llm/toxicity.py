"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

A bounded sample of the labelled texts, by digest, becomes the examples. Spark counts in how
many of them, of either label, each word and each beginning of a word occurs (inflected forms
share beginnings); those that tell the labels apart are the terms. Copies of one text must not
make a term: of the candidates, the distinct surroundings are counted, which copies share.
The examples' vectors are TF-IDF over the terms, equal vectors joined into one that counts for all. The index keeps postings per term, cut into blocks of examples with the largest
weight of each block; a search adds up these maxima per block, visits blocks from the best
bound down and stops where no block can hold anything nearer. Neighbours vote with weights
that fall with distance; votes become probabilities through an isotonic fit on leave-one-out
votes of the examples themselves. All terms that tell the labels apart are kept; terms, index
and fit are bounded by the sample. They are sent to the workers, which score all texts without a shuffle.
"""

import hashlib
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import receive, send, tidy
from cinderlog.session import write_table
from cinderlog.sources.files import spread

# Documented bounds of the classifier: examples (a sample of the labelled rows by hash of the
# text), neighbours that vote, examples per block.
MAX_EXAMPLES, NEIGHBOURS, BLOCK = 20000, 25, 64
# A term's odds must differ by such a factor between the labels, whatever the size of the
# corpus, and its log-likelihood ratio must rule chance out (one in a thousand).
MIN_ODDS, MIN_RATIO = 2.0, 10.83
STEMS = (4, 8)  # letters of the beginnings of words that may be terms
REPEATS = (2, 4)
NEAR = 0.05  # added to the distance in a vote's weight 1 / (distance + NEAR)
WORD = re.compile(r"[^\W\d_]+")


def text_words(text) -> list:
    """Runs of letters, lower-cased."""
    return WORD.findall(text.lower()) if isinstance(text, str) else []


class Features(dict):
    """Word -> the word and its beginnings; with terms, the numbers of those that are terms.
    Remembered up to a bound."""

    def __init__(self, terms=None, limit=500_000):
        super().__init__()
        self.terms, self.limit = terms, limit

    def __missing__(self, word):
        all_of = (word, *[word[:n] + "-" for n in range(STEMS[0], min(STEMS[1], len(word) - 1) + 1)])
        found = all_of if self.terms is None else tuple(self.terms[x] for x in all_of if x in self.terms)
        if len(self) >= self.limit:
            self.clear()
        self[word] = found
        return found


def repeated(counts: Counter, size: int) -> dict:
    """Term counts, with further terms that say which ones occur twice and four times at
    least: a cosine by itself would not tell once from often."""
    out = dict(counts)
    for step, least in enumerate(REPEATS, 1):
        out.update((n + step * size, 1) for n, c in counts.items() if c >= least)
    return out


@tidy
def _word_counts(frames):
    features = Features()
    for frame in frames:
        texts, toxic = Counter(), Counter()
        for text, label in zip(frame["text"], frame["toxic"]):
            own = set().union(*map(features.__getitem__, set(text_words(text))))
            texts.update(own)
            if label:
                toxic.update(own)
        yield pd.DataFrame({"word": list(texts), "texts": list(texts.values()), "toxic": [toxic[w] for w in texts]})


@tidy
def _surroundings(frames, terms: dict):
    """(term, toxic, hash of the words before and after its first place) of each text."""
    features = Features(terms)
    for frame in frames:
        rows = []
        for text, label in zip(frame["text"], frame["toxic"]):
            tokens = text_words(text)
            seen = set()
            for i, word in enumerate(tokens):
                for term in features[word]:
                    if term not in seen:
                        seen.add(term)
                        around = "\x00".join(tokens[max(0, i - 1): i + 2]).encode()
                        rows.append((term, int(label), zlib.crc32(around)))
        yield pd.DataFrame(rows, columns=["term", "toxic", "around"]).drop_duplicates()


@dataclass
class Index:
    terms: dict          # word -> number
    idf: np.ndarray
    count: np.ndarray    # texts behind an example vector
    toxic: np.ndarray    # of them toxic
    ids: np.ndarray      # smallest doc_id behind it
    cells: np.ndarray    # term -> first of its cells, one per block that holds the term
    block: np.ndarray    # cells: block, largest weight, first posting
    block_max: np.ndarray
    offsets: np.ndarray
    example: np.ndarray  # postings
    weight: np.ndarray
    prior: float         # score of a text without any term
    votes: np.ndarray    # isotonic fit: vote -> probability
    chances: np.ndarray
    features: Features | None = None

    def vector(self, counts: dict):
        """Term numbers and unit TF-IDF weights of term counts."""
        numbers = np.array(sorted(counts), np.int64)
        w = (1 + np.log([counts[n] for n in numbers])) * self.idf[numbers]
        return numbers, w / np.sqrt((w * w).sum())

    def counts(self, text) -> dict:
        if self.features is None:
            self.features = Features(self.terms)
        found = Counter(chain.from_iterable(map(self.features.__getitem__, text_words(text))))
        return repeated(found, len(self.terms))

    def nearest(self, numbers, weights, k: int, less=None):
        """Example numbers and cosines of the k nearest texts and all that tie with the last.
        less: (example number) with one of its texts left out."""
        blocks = max(1, -(-len(self.count) // BLOCK))
        bounds, place = np.zeros(blocks), np.full((len(numbers), blocks), -1)
        for own, n, w in zip(place, numbers, weights):
            at = slice(self.cells[n], self.cells[n + 1])
            own[self.block[at]] = np.arange(at.start, at.stop)
            bounds[self.block[at]] += w * self.block_max[at]
        scores, found = [], []
        held, worst = 0, 0.0
        for block in np.argsort(-bounds, kind="stable"):
            # bounds are sums of rounded products: a hair of room keeps the search exact
            if bounds[block] <= 0 or held >= k and bounds[block] < worst - 1e-6:
                break
            exact = np.zeros(BLOCK)
            for cell, w in zip(place[:, block].tolist(), weights):
                if cell < 0:
                    continue
                at = slice(self.offsets[cell], self.offsets[cell + 1])
                exact[self.example[at] - block * BLOCK] += w * self.weight[at]
            hit = np.flatnonzero(exact > 0)
            found.append(hit + block * BLOCK)
            scores.append(exact[hit])
            all_found, all_scores = np.concatenate(found), np.concatenate(scores)
            have = self.count[all_found] - (all_found == less if less is not None else 0)
            order = np.argsort(-all_scores, kind="stable")
            reach = np.cumsum(have[order])
            held = int(reach[-1]) if len(reach) else 0
            if held >= k:
                worst = all_scores[order][np.searchsorted(reach, k)]
                keep = order[all_scores[order] >= worst - 1e-9]
                found, scores = [all_found[keep]], [all_scores[keep]]
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        found, scores = np.concatenate(found), np.concatenate(scores)
        order = np.lexsort((found, -scores))
        return found[order], scores[order]

    def vote(self, numbers, weights, k: int, less=None, less_toxic=0):
        """Share of toxic among the neighbours' votes; None if there are none."""
        found, cosine = self.nearest(numbers, weights, k, less)
        n, t = self.count[found].astype(float), self.toxic[found].astype(float)
        if less is not None:
            n, t = n - (found == less), t - less_toxic * (found == less)
        w = 1 / (1 - np.minimum(cosine, 1) + NEAR)
        total = (w * n).sum()
        return (float((w * t).sum() / total) if total > 0 else None), found, cosine

    def chance(self, vote) -> float:
        return self.prior if vote is None else float(np.interp(vote, self.votes, self.chances))


def isotonic(x, y, weight):
    """Non-decreasing fit of y on x: block centres and values. Equal x are one point."""
    centres, at = np.unique(x, return_inverse=True)
    heavy = np.bincount(at, weight)
    blocks = []
    for a, b, w in zip(centres, np.bincount(at, weight * y) / heavy, heavy):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    out = np.array(blocks)
    return out[:, 0] / out[:, 2], out[:, 1] / out[:, 2]


def build(terms, idf, examples: pd.DataFrame, empty, neighbours: int = NEIGHBOURS) -> Index:
    """examples: counts (dict term -> count), n, toxic, doc_id; one row per distinct vector.
    empty: (texts, toxic) without any term."""
    n, t = empty
    base = (examples["toxic"].sum() + t + 1) / (examples["n"].sum() + n + 2)
    size, blocks = len(idf), max(1, -(-len(examples) // BLOCK))
    index = Index(
        terms, idf, examples["n"].to_numpy(np.int64), examples["toxic"].to_numpy(np.int64),
        examples["doc_id"].to_numpy(), np.zeros(size + 1, np.int64), np.empty(0, np.int64), np.empty(0),
        np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0), (t + 2 * base) / (n + 2), np.array([0.0, 1.0]), np.array([base, base]),
    )
    if not len(examples):
        return index
    vectors = [index.vector(c) for c in examples["counts"]]
    term = np.concatenate([v[0] for v in vectors])
    weight = np.concatenate([v[1] for v in vectors])
    example = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
    order = np.lexsort((example, term))
    term, index.example, index.weight = term[order], example[order], weight[order]
    cell, first = np.unique(term * blocks + index.example // BLOCK, return_index=True)
    index.block, index.offsets = cell % blocks, np.r_[first, len(term)]
    index.block_max = np.maximum.reduceat(index.weight, first)
    index.cells = np.searchsorted(cell, np.arange(size + 1) * blocks)
    votes, labels, heavy = [], [], []
    for i, (numbers, w) in enumerate(vectors):
        for label, many in ((1, index.toxic[i]), (0, index.count[i] - index.toxic[i])):
            if many:
                vote, _, _ = index.vote(numbers, w, neighbours, i, label)
                if vote is not None:
                    votes.append(vote), labels.append(label), heavy.append(many)
    if votes:
        centres, chances = isotonic(np.array(votes), np.array(labels, float), np.array(heavy, float))
        # Pulled a little towards the base rate, so that no chance is exactly 0 or 1.
        index.votes, index.chances = centres, np.clip(chances, 0.002, 0.998)
    return index


def _examples(documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """digest, toxic, doc_id, text of at most so many distinct labelled texts. Digests are chosen
    first, by a threshold and then in order, so that neither texts nor all digests meet in a task."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = write_table(documents.select("doc_id", digest).join(marks, "doc_id").groupBy("digest").agg(
        F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")), "marked")
    total = marked.count()
    if total > most:
        share = 1.2 * most / total + 1000 / total
        if share < 1:
            marked = marked.where(F.col("digest") < f"{int(share * (1 << 64)):016x}")
        marked = write_table(marked.orderBy("digest").limit(most), "chosen")
    own = documents.select("doc_id", digest, F.coalesce("text", F.lit("")).alias("text"))
    found = own.join(F.broadcast(marked) if total > most else marked, ["doc_id", "digest"])  # at most `most` rows
    return spread(write_table(found.groupBy("digest", "toxic", "doc_id").agg(F.any_value("text").alias("text")), "labelled"))


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES,
          neighbours: int = NEIGHBOURS) -> Index:
    """Learns from the documents that have a label (joined by doc_id; toxic 0 or 1, a null is
    no label; of several labels the largest counts). Equal texts are one text. Where there are
    more than max_examples, those with the smallest digests are taken, and all that follows
    (terms, weights, index, calibration) is learnt from them."""
    texts = _examples(documents, labels, max_examples)
    total, positive = texts.agg(F.count("*"), F.sum("toxic")).first()
    positive = positive or 0
    if not positive or positive == total:
        return build({}, np.empty(0), pd.DataFrame({"counts": [], "n": [], "toxic": [], "doc_id": []}), (total, positive), neighbours)
    counted = texts.select("text", "toxic").mapInPandas(_word_counts, "word string, texts long, toxic long").groupBy(
        "word").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
    a, n = F.col("toxic"), F.col("texts")

    def part(k, of, p):
        p = F.greatest(F.least(p, F.lit(1 - 1e-12)), F.lit(1e-12))
        return k * F.log(p) + (of - k) * F.log(1 - p)

    na, nb = F.lit(float(positive)), F.lit(float(total - positive))
    both = n / (na + nb)
    ratio = 2 * (part(a, na, a / na) + part(n - a, nb, (n - a) / nb) - part(a, na, both) - part(n - a, nb, both))
    odds = F.log((a + 0.5) * (nb - (n - a) + 0.5) / ((na - a + 0.5) * (n - a + 0.5)))
    leading = (ratio >= MIN_RATIO) & (F.abs(odds) >= float(np.log(MIN_ODDS)))
    candidates = counted.where(leading).orderBy("word").toPandas()
    numbered = {w: i for i, w in enumerate(candidates["word"])}
    apart = texts.select("text", "toxic").mapInPandas(
        lambda it: _surroundings(it, numbered), "term int, toxic long, around long"
    ).distinct().groupBy("term").agg(F.count("*").alias("texts"), F.sum("toxic").alias("toxic"))
    steady = apart.where(leading).orderBy("term").toPandas()
    chosen = candidates.iloc[steady["term"]]
    terms = {w: i for i, w in enumerate(chosen["word"])}
    idf = np.tile(np.log((total + 1) / (chosen["texts"].to_numpy(float) + 1)) + 1, 1 + len(REPEATS))

    def vectors(frames):
        features = Features(terms)
        for frame in frames:
            rows = [
                repeated(Counter(chain.from_iterable(map(features.__getitem__, text_words(x)))), len(terms))
                for x in frame["text"]
            ]
            yield pd.DataFrame({
                "vector": [" ".join(f"{n}:{c}" for n, c in sorted(r.items())) for r in rows],
                "toxic": frame["toxic"].astype("int64"), "doc_id": frame["doc_id"],
            })

    grouped = texts.select("text", "toxic", "doc_id").mapInPandas(
        vectors, "vector string, toxic long, doc_id long"
    ).groupBy("vector").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")
    ).orderBy("vector").toPandas()  # at most max_examples rows
    bare = grouped["vector"] == ""
    empty = int(grouped.loc[bare, "n"].sum()), int(grouped.loc[bare, "toxic"].sum())
    examples = grouped[~bare].reset_index(drop=True)
    examples["counts"] = [
        {int(n): int(c) for n, c in (p.split(":") for p in v.split())} for v in examples["vector"]
    ]
    return build(terms, idf, examples, empty, neighbours)


@tidy
def _score(frames, shared, keys, neighbours):
    index = receive(shared)
    names = sorted(index.terms, key=index.terms.get)
    remembered = {}
    for frame in frames:
        rows = []
        for text in frame["text"]:
            counts = index.counts(text)
            # A digest: the counts themselves would be as large as the texts.
            key = hashlib.blake2b(np.array(sorted(counts.items()), np.int64).tobytes(), digest_size=16).digest()
            if key not in remembered:
                if len(remembered) >= 50_000:
                    remembered.clear()
                if counts:
                    numbers, w = index.vector(counts)
                    vote, found, _ = index.vote(numbers, w, neighbours)
                    told = [names[n] for n in numbers[np.argsort(-w, kind="stable")] if n < len(names)][:5]
                    remembered[key] = index.chance(vote), index.ids[found[:3]].tolist(), told
                else:
                    remembered[key] = index.prior, [], []
            rows.append(remembered[key])
        out = frame[list(keys)].reset_index(drop=True)
        out["score"] = np.array([r[0] for r in rows], float)
        out["neighbours"], out["terms"] = [r[1] for r in rows], [r[2] for r in rows]
        yield out


def score(documents: DataFrame, index: Index, keys=("doc_id",), neighbours: int = NEIGHBOURS) -> DataFrame:
    """Per row: its key columns, score (probability of label 1), and as evidence the ids of
    the nearest examples and the heaviest terms of the text. Null and empty texts and texts
    without any term get the rate of such training texts. Repeated rows are scored each;
    no labelled rows give one half for every text."""
    shared = send(documents.sparkSession, index)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keys).schema)
    return documents.select(*dict.fromkeys([*keys, "text"])).mapInPandas(
        lambda it: _score(it, shared, keys, neighbours),
        f"{kinds}, score double, neighbours array<long>, terms array<string>",
    )
