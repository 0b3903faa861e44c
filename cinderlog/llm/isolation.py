"""Quality rules judged by an isolation forest.

Statistics of rules are taken from every whole text. A forest of random trees is grown from a
bounded draw of the rows that the base rules pass, DRAWN per tree as the method asks: each split takes a random statistic
and a random place within its range. Unusual documents are cut off after few splits, so a short
mean path makes a high score. From which score on a document is dropped is set by the labelled
rows, all of them: their scores are counted in Spark, and the threshold is taken that tells bad
from good best while the share of good documents asked for is kept.
"""

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import receive, send
from cinderlog.session import write_table

# Documented bounds of the forest: trees, and rows that each is grown from.
TREES, DRAWN = 100, 256
DEPTH = 8  # ceil(log2(DRAWN)): beyond it the mean path of an unsplit rest stands in
KEPT_GOOD = 0.995  # share of the labelled good documents that a threshold keeps
STEPS = 10_000  # scores are told apart in steps of 1 / STEPS
LEAST_WORDS, MOST_REPEATED = 50, 50

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
CUT = re.compile(f"[{SPACES}]+")
LETTER, UPPER, DIGIT, SYMBOL = 1, 2, 4, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# What the forest splits on. Repeated lines repeat their words, so one share stands for both.
SHARES = ("word_length", "symbols", "repeated", "upper", "marks", "line_words", "distinct", "open_lines")
STATISTICS = "".join(f"{c} long, " for c in COUNTS) + ", ".join(f"{s} double" for s in SHARES)


def repeated_words(words: list) -> int:
    """Words in windows of three words that occur twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    count = Counter(windows)
    total, reach = 0, 0
    for i, window in enumerate(windows):
        if count[window] > 1:
            total += i + 3 - max(reach, i)
            reach = i + 3
    return total


_kinds = None


def kinds(text: str) -> np.ndarray:
    """Per character its LETTER, UPPER, DIGIT and SYMBOL bits, by a table made once."""
    global _kinds
    if _kinds is None:
        every = map(chr, range(0x110000))
        _kinds = np.fromiter(
            (LETTER * c.isalpha() | UPPER * c.isupper() | DIGIT * c.isdigit() | SYMBOL * (c in SYMBOLS) for c in every),
            np.uint8, 0x110000)
    return _kinds[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def statistics(text) -> tuple:
    """The counts and shares of one text; a null text has no words."""
    text = text if isinstance(text, str) else ""
    # str.split() would cut at further characters; these six are the separators of a word.
    words = [w for w in CUT.split(text) if w]
    n, chars = len(words), sum(map(len, words))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    of = np.bincount(kinds(text), minlength=16)
    letters, upper, digits, symbols = (
        int(of[[k for k in range(16) if k & bit]].sum()) for bit in (LETTER, UPPER, DIGIT, SYMBOL))
    repeats, again = len(lines) - len(set(lines)), repeated_words(words)
    rows = max(1, len(lines))
    return (
        n, chars, symbols, repeats, again,
        chars / max(1, n), symbols / max(1, n), again / max(1, n), upper / max(1, letters),
        (chars - letters - digits) / max(1, chars), np.log1p(n / rows),
        np.log1p(len(set(words))) / max(1.0, np.log1p(n)),
        sum(line.rstrip(SPACES)[-1].isalnum() for line in lines) / rows,
    )


def measure(documents: DataFrame, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns, the counts and the shares that the forest splits on."""
    def run(frames):
        for frame in frames:
            found = pd.DataFrame([statistics(t) for t in frame["text"]], columns=[*COUNTS, *SHARES])
            found[list(COUNTS)] = found[list(COUNTS)].astype("int64")
            found[list(SHARES)] = found[list(SHARES)].astype("float64")
            yield pd.concat([frame[list(keys)].reset_index(drop=True), found], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keys).schema)
    return documents.select(*dict.fromkeys([*keys, "text"])).mapInPandas(run, f"{kinds}, {STATISTICS}")


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 2:
        return float(max(0, n - 1))
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees one after another in flat arrays; a leaf links to itself."""

    roots: np.ndarray
    statistic: np.ndarray
    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray   # at a leaf: its depth, and the mean path of the rows left in it
    usual: float       # mean path among DRAWN rows
    threshold: float = 2.0  # scores from here on are anomalous; scores are below 1

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / usual path): near 1 for rows that are cut off at once."""
        total, at = np.zeros(len(rows)), np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                lower = rows[at, self.statistic[node]] < self.place[node]
                node = np.where(lower, self.left[node], self.right[node])
            total += self.path[node]
        return 2.0 ** -(total / max(1, len(self.roots)) / max(self.usual, 1e-9))


def grow(rows: np.ndarray, trees: int = TREES, seed: int = 11) -> Forest:
    """A forest from rows of statistics; each tree draws its own DRAWN of them."""
    draw = np.random.default_rng(seed)
    statistic, place, left, right, path, roots = [], [], [], [], [], []

    def node(own, depth):
        me = len(statistic)
        statistic.append(0), place.append(0.0), left.append(me), right.append(me)
        path.append(depth + mean_path(len(own)))
        if depth == DEPTH or len(own) <= 1:
            return me
        low, high = own.min(0), own.max(0)
        varied = np.flatnonzero(high > low)
        if len(varied):
            s = int(draw.choice(varied))
            cut = draw.uniform(low[s], high[s])
            below = own[:, s] < cut
            if below.any() and not below.all():
                statistic[me], place[me] = s, cut
                left[me], right[me] = node(own[below], depth + 1), node(own[~below], depth + 1)
        return me

    size = min(DRAWN, len(rows))
    for _ in range(trees if size else 0):
        roots.append(node(rows[draw.choice(len(rows), size, replace=False)], 0))
    return Forest(*map(np.array, (roots, statistic, place, left, right, path)), mean_path(size))


def base_failed():
    words = F.col("n_words")
    return (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)


def drawn(measured: DataFrame, trees: int = TREES) -> np.ndarray:
    """At most trees * DRAWN rows, by hash: a threshold first, so that few rows are sorted."""
    wanted, total = trees * DRAWN, measured.count()
    order = F.xxhash64("*")
    some = measured.withColumn("_at", order)
    if total > 2 * wanted:
        share = 1.2 * wanted / total + 1e-6
        some = some.where(F.col("_at") < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return some.orderBy("_at", *SHARES).limit(wanted).select(*SHARES).toPandas().to_numpy(np.float64)


def score(measured: DataFrame, forest: Forest) -> DataFrame:
    """Adds anomaly, the forest's score in steps of 1 / STEPS."""
    shared = send(measured.sparkSession, forest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in measured.schema)

    def run(frames):
        own = receive(shared)
        for frame in frames:
            scores = own.scores(frame[list(SHARES)].to_numpy(np.float64)) if len(own.roots) else np.zeros(len(frame))
            yield frame.assign(anomaly=np.rint(scores * STEPS) / STEPS)

    return measured.mapInPandas(run, f"{schema}, anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, kept_good: float = KEPT_GOOD) -> float:
    """The threshold: of those that keep the share kept_good of the labelled good documents which
    the base rules pass, the one with the most of the bad ones caught less the good ones lost
    (shares; ties: the highest), halfway down to the next labelled score. Above 1 (nothing is
    dropped) where no bad document can be caught so."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    seen = scored.where(~base_failed()).join(marks, "doc_id").groupBy("anomaly").agg(
        F.count_if(F.col("quality") > 0).alias("good"), F.count_if(F.col("quality") <= 0).alias("bad"),
    ).orderBy(F.desc("anomaly")).toPandas()  # at most STEPS rows
    lost = seen["good"].cumsum() / max(1, seen["good"].sum())
    gain = (seen["bad"].cumsum() / max(1, seen["bad"].sum()) - lost).where(lost <= 1 - kept_good, 0)
    if not (gain > 0).any():
        return 2.0
    at = int(gain.to_numpy().argmax())
    border = seen["anomaly"].tolist() + [seen["anomaly"].iloc[-1]]
    return (border[at] + border[at + 1]) / 2


def train(spark: SparkSession, measured: DataFrame, labels: DataFrame, trees: int = TREES,
          kept_good: float = KEPT_GOOD) -> tuple:
    """(forest with its threshold, measured rows with their anomaly). measured: what measure()
    gives, stored."""
    forest = grow(drawn(measured.where(~base_failed()), trees), trees)
    scored = write_table(score(measured, forest), "scored")
    forest.threshold = calibrate(scored, labels, kept_good)
    return forest, scored


def judge(spark: SparkSession, documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row of documents: doc_id, the counts, base_failed, kept, anomaly, threshold and the
    shares.

    documents: doc_id, text; labels: doc_id, quality (0 or 1; of several the smallest counts, a
    null is none); other columns are not read. A null or empty text has no words and fails the
    base rules. Texts of any length are read whole. Repeated rows are judged each, alike. Without
    labelled documents the forest drops nothing. An empty table gives no row."""
    measured = write_table(measure(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "measured")
    forest, scored = train(spark, measured, labels, **options)
    anomalous = F.col("anomaly") >= F.lit(forest.threshold)
    return scored.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & ~anomalous).alias("kept"),
        "anomaly", F.lit(forest.threshold).alias("threshold"), *SHARES)
