"""LM scoring: interpolated modified Kneser-Ney, counted in Spark.

Words. Arrow cuts the texts and numbers their distinct words, so all that follows is done once per
distinct word or n-gram of a batch, on arrays of numbers.

Counting. A first pass counts words and numbers them, frequent ones first. Then each task reduces its
n-grams to distinct ones with counts and hands them out as packed blobs of word numbers, by range of
the hash of their next to last word. An n-gram, its context and the shorter n-gram that it ends in
then share a range, so one group adds up all orders and writes them: nothing but unigrams goes
on from it. A next to last word that would make a range too large (a hot one) has its n-grams
dealt out by their contexts instead, and their shorter ends are shuffled once more per order. A
frequent n-gram is one entry per batch, and a range is a bounded group however skewed the corpus.

Stored are sorted 64-bit hashes of the contexts, the first 16 bits as places in the rest, and the
numbers and counts of the words that follow each; counts take a byte, with a list of the larger
ones, and a context refers to one of the distinct sums in its file.

Scoring. Workers map the files into memory and look the distinct n-grams of a batch up by binary
search, in the order of the files; no document is shuffled. Files are replaced whole, so lost tasks
repeat safely.
"""

import hashlib
import json
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import FOLD, chain, map_array, mix, put_array, smallest, tidy, tidy_group
from cinderlog.session import scratch_path, write_table

END = np.uint64(0x2545F4914F6CDD1D)
# Numbers of words: BEGIN is before all texts, the others count from 1, and UNKNOWN is in no n-gram.
BEGIN, UNKNOWN = 0, 1 << 40
BLOB = "level int, kind string, shard int, blob binary"
# Bytes of texts whose words are numbered together, tokens a task works on at a time, words it holds
# counts of, and n-grams of a hash range at most, before equal ones of different tasks are added up.
BATCH_BYTES, BATCH_TOKENS, HELD_WORDS, RANGE_GRAMS = 1 << 25, 1_000_000, 500_000, 2_000_000
# A longer word is hashed by a digest.
LONG_WORD = 64
# A word is hot from this share of a range on. Fewer hashes than PLAIN are stored whole.
HOT_SHARE, PLAIN = 1 / 8, 1 << 17


@dataclass
class Model:
    """Where the files are and the few numbers that go with them."""

    path: str
    order: int
    bits: int = 0
    hot: int = -1  # words up to this number are hot
    train_tokens: int = 0
    vocabulary: int = 0
    unigram_total: int = 0
    discounts: dict = field(default_factory=dict)  # order -> (D1, D2, D3+)
    unigram_gamma: float = 1.0

    def file(self, level: int, kind: str, hot, shard) -> str:
        return f"{self.path}/{level}/{kind}-{'hot' if hot else 'cold'}-{int(shard):06d}"


# -- texts as numbers of words, n-grams as columns of them

def _runs(sizes: np.ndarray, budget: int):
    """Bounds of consecutive rows of about budget in all."""
    first = _starts((np.cumsum(sizes) - sizes) // budget)
    return zip(first.tolist(), [*first[1:].tolist(), len(sizes)])


def _text_batches(batches):
    """Rows of Arrow batches, with about BATCH_BYTES of text at a time."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for a, b in _runs(size.astype(np.int64), BATCH_BYTES):
            yield batch.slice(a, b - a)


def _encode(texts):
    """Hashes of the distinct words, where among them each word of the texts is, and words per text.
    The words are those of common.words: Arrow lowers A-Z only and cuts at the same six bytes."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    encoded, lengths = pc.dictionary_encode(lists.flatten()), pc.list_value_length(lists).to_numpy().astype(np.int64)
    codes, distinct = encoded.indices.to_numpy(), encoded.dictionary
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:  # before the first and after the last word
        there = codes != empty
        lengths = np.diff(np.r_[0, np.cumsum(there)][np.r_[0, np.cumsum(lengths)]])
        codes = codes[there]
    del lists
    pa.default_memory_pool().release_unused()
    return _word_hashes(distinct), codes, lengths


def _word_hashes(words) -> np.ndarray:
    """Hashes of the words of an Arrow array, 8 bytes at a time."""
    words = pa.concat_arrays([words.cast(pa.large_binary())])  # without an offset
    if not len(words):
        return np.empty(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
    data = np.r_[np.frombuffer(words.buffers()[2] or b"", np.uint8)[:ends[-1]], np.zeros(8, np.uint8)]
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the 8 bytes from each place on
    start, size = ends[:-1], np.diff(ends)
    hashes = mix(size.astype(np.uint64) + np.uint64(FOLD))
    long = size > LONG_WORD
    at, done = np.flatnonzero(~long & (size > 0)), 0
    while len(at):
        unused = np.maximum(done + 8 - size[at], 0).astype(np.uint64) * np.uint64(8)
        hashes[at] = chain(hashes[at], eights[start[at] + done] << unused >> unused)
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(long):
        hashes[i] = int.from_bytes(hashlib.blake2b(words[i].as_py(), digest_size=8).digest(), "little")
    return hashes


def _flat(codes, lengths):
    """The words' numbers, text by text, with 0 before and 1 after each text and 2 and more for the words; how
    many there are before each of them in its text."""
    lengths = lengths + 2
    starts = np.cumsum(lengths) - lengths
    inside = np.ones(lengths.sum(), bool)
    inside[starts] = inside[starts + lengths - 1] = False
    flat = np.zeros(len(inside), np.int32)
    flat[starts + lengths - 1] = 1
    flat[inside] = codes + 2
    return flat, np.arange(len(flat), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)


def _slices(codes, lengths, budget: int):
    """(first text, end of texts, their words by _flat and how many are before each), about budget tokens at a time."""
    ends = np.r_[0, np.cumsum(lengths)]
    for a, b in _runs(lengths + 1, budget):
        yield a, b, *_flat(codes[ends[a]:ends[b]], lengths[a:b])


def _known(files, hashes) -> list:
    """What files have for the words of _flat (their number first, UNKNOWN where there is none)."""
    found = [np.r_[0, x] for x in files.of_words(np.r_[END, hashes])]
    found[0][1:][found[0][1:] == 0] = UNKNOWN
    return found


def _repeated(first, size: int) -> np.ndarray:
    """Which run each row is in; first: where runs begin."""
    return np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.r_[first, size]))


def _pairs(left, right):
    """Distinct pairs of numbers under 2 ** 31, in order, and which of them each row has."""
    packed = left.astype(np.int64) << 32 | right
    order = np.argsort(packed)
    packed = packed[order]
    first, which = _starts(packed), np.empty(len(packed), np.int32)
    which[order] = _repeated(first, len(packed))
    packed = packed[first]
    return (packed >> 32).astype(np.int32), packed.astype(np.int32), which


def _hashes(numbers: np.ndarray) -> np.ndarray:
    return mix(numbers.astype(np.uint64) * np.uint64(FOLD) + np.uint64(1))


def _gram_hash(columns) -> np.ndarray:
    h = _hashes(columns[0])
    for w in columns[1:]:
        h = chain(h, _hashes(w))
    return h


def _starts(*columns) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _ranks(columns):
    """The sorted distinct numbers, and where they are among them."""
    top = max(int(c.max()) for c in columns) + 1
    if top > 1 << 24:
        known, places = np.unique(np.concatenate(columns), return_inverse=True)
        return known, np.split(places.astype(np.int64), len(columns))
    used = np.zeros(top, bool)
    for c in columns:
        used[c] = True
    rank = np.cumsum(used, dtype=np.int32) - 1
    return np.flatnonzero(used), [rank[c].astype(np.int64) for c in columns]


def _distinct(columns, *values):
    """Distinct n-grams by their next to last word, then the others from the left, and the sums
    of values, or else how often each is there."""
    keys = [columns[-2], *columns[:-2], columns[-1]]
    width = max(1, max(int(c.max()) for c in keys).bit_length())
    if width * len(keys) >= 64:  # places among the words at hand are smaller
        known, places = _ranks(columns)
        if len(known).bit_length() * len(keys) < 64:
            columns, *sums = _distinct(places, *values)
            return [known[c] for c in columns], *sums
        at = np.lexsort(keys[::-1])
        keys = [c[at] for c in keys]
        first, n = _starts(*keys), len(at)
        keys = [c[first] for c in keys]
    else:
        packed = keys[0].astype(np.int64)
        for c in keys[1:]:
            packed = packed << width | c
        at = np.argsort(packed) if values else None
        packed = packed[at] if values else np.sort(packed)
        first, n = _starts(packed), len(packed)
        left, keys = packed[first], []
        for _ in columns:
            keys.insert(0, left & ((1 << width) - 1))
            left = left >> width
    columns = [*keys[1:-1], keys[0], keys[-1]]
    sums = [np.add.reduceat(v[at], first) for v in values] or [np.diff(np.r_[first, n])]
    return columns, *sums


def _sum_by(keys: np.ndarray, *values):
    """Distinct sorted keys and the sums of values per key."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = _starts(k)
    return k[first], *[np.add.reduceat(v[order], first) if len(k) else v[:0] for v in values]


# -- hash ranges

def _shards(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _route(model: Model, columns, context=False):
    """Per n-gram (context: per n-gram without its last word): is it dealt as one of a hot word, its range."""
    v = columns[-1] if context else columns[-2]
    shards, hot = _shards(_hashes(v), model.bits), v <= model.hot
    at = np.flatnonzero(hot)
    if len(at):  # bigrams of a hot word have one context: they are dealt out as a whole
        by = columns if context or len(columns) == 2 else columns[:-1]
        shards[at] = _shards(_gram_hash([c[at] for c in by]), model.bits)
    return hot, shards


def _groups(codes: np.ndarray):
    """(code, rows that have it) for each code."""
    order = np.argsort(codes, kind="stable")
    first = _starts(codes[order])
    for a, b in zip(first, np.r_[first[1:], len(order)]):
        yield int(codes[order[a]]), order[a:b]


def _squeeze(*arrays) -> bytes:
    """Arrays of unsigned integers as one compressed value, byte by byte of the integers."""
    arrays = [smallest(a) for a in arrays]
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, len(a))]], np.int64)
    body = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    whole = b"".join([head.tobytes(), *body])
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _open(blob: bytes) -> list:
    whole = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(whole, np.int64, 1)[0])
    head = np.frombuffer(whole, np.int64, 2 * n, 8).reshape(n, 2)
    out, at = [], 8 + 16 * n
    for width, length in head.tolist():
        planes = np.frombuffer(whole, np.uint8, width * length, at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(f"u{width}").reshape(length))
        at += width * length
    return out


def _frame(rows) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["level", "kind", "shard", "blob"])


def _gram_blobs(columns, counts, model: Model):
    """Blobs of distinct n-grams by range. The next to last word is written once for all n-grams in a row
    that have it."""
    hot, shards = _route(model, columns)
    for code, part in _groups(shards * 2 + hot):
        own = [c[part] for c in columns]
        first = _starts(own[-2])
        blob = _squeeze(own[-2][first], np.diff(np.r_[first, len(part)]), *own[:-2], own[-1], counts[part])
        yield len(columns), "hot" if code & 1 else "cold", code >> 1, blob


def _word_blobs(kind: str, words, model: Model, *values):
    """Blobs of numbers per word, by range of the word."""
    for shard, part in _groups(_shards(_hashes(words), model.bits)):
        yield 1, kind, shard, _squeeze(words[part], *[v[part] for v in values])


def _merge(frame) -> dict:
    """For each level of the blobs, columns and counts."""
    found = {}
    for level, blob in zip(frame["level"], frame["blob"]):
        heads, runs, *more = [a.astype(np.int64) for a in _open(blob)]
        more.insert(int(level) - 2, np.repeat(heads, runs))
        found.setdefault(int(level), []).append(more)
    return {k: [np.concatenate(x) for x in zip(*v)] for k, v in found.items()}


# -- files

def _keys(hashes: np.ndarray):
    """How to sort the hashes, and the arrays to find them by."""
    keys = mix(hashes)  # a range has hashes of equal first bits
    order = np.argsort(keys)
    keys = keys[order]
    if len(keys) < PLAIN:
        return order, [keys]
    tops = np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)
    return order, [np.r_[np.searchsorted(keys, tops), len(keys)].astype(np.uint32),
                   (keys >> np.uint64(32)).astype(np.uint16), keys.astype(np.uint32)]


def _column(values: np.ndarray) -> list:
    """A byte per number, and the places and numbers of those of 255 and more; or, if they are many, all whole."""
    more = np.flatnonzero(values >= 255)
    if len(more) > len(values) / 8:
        return [values.astype(np.uint32 if values.max() < 1 << 32 else np.uint64), more[:0], more[:0]]
    return [np.minimum(values, 255).astype(np.uint8), more.astype(np.uint32), values[more].astype(np.int64)]


def _write(uri: str, arrays) -> None:
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, len(a))]], np.int64)
    padded = [a.tobytes() + b"\0" * (-a.nbytes % 8) for a in [head, *arrays]]
    put_array(uri, np.frombuffer(b"".join(padded), np.uint8))


def _save(uri: str, hashes: np.ndarray, *columns) -> None:
    """Numbers per hash."""
    order, arrays = _keys(hashes)
    _write(uri, arrays + [a for c in columns for a in _column(c[order])])


def _sums_column(sums):
    """Total and numbers of continuations seen once, twice and more often, per context, as a reference
    to the distinct ones: most contexts have equal ones."""
    _, first, which, n = np.unique(
        _gram_hash(sums), return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    return _column(rank[which]), [s[first[order]].astype(np.int64) for s in sums]


def _save_contexts(uri: str, hashes: np.ndarray, sums, follow=None) -> None:
    """Sums per context; follow: for each one, how many n-grams, and their last words and counts."""
    order, arrays = _keys(hashes)
    which, table = _sums_column([s[order] for s in sums])
    arrays += which + table
    if follow:
        n, last, counts = follow
        start, n = (np.cumsum(n) - n)[order], n[order]
        place = np.cumsum(n) - n
        at = np.repeat(start - place, n) + np.arange(len(last))
        last = last[at]
        arrays += [np.r_[place, len(last)].astype(np.uint32), last.astype(np.uint16), smallest(last >> 16), *_column(counts[at])]
    _write(uri, arrays)


def _pick(column, at: np.ndarray) -> np.ndarray:
    """Numbers of a _column."""
    codes, places, large = column
    out = codes[at].astype(np.int64)
    more = np.flatnonzero(out == 255) if codes.itemsize == 1 else []
    if len(more):
        out[more] = large[np.searchsorted(places, at[more])]
    return out


class _Part:
    """A mapped file of hashes with numbers, or of contexts."""

    def __init__(self, uri: str):
        whole = map_array(uri, np.uint8)
        n = int(np.frombuffer(whole, np.int64, 1)[0])
        head = np.frombuffer(whole, np.int64, 2 * n, 8).reshape(n, 2).tolist()
        arrays, at = [], 8 + 16 * n
        for width, length in head:
            arrays.append(np.frombuffer(whole, f"u{width}", length, at))
            at += -(-width * length // 8) * 8
        keys = 1 if head[0][0] == 8 else 3
        self.keys, self.rest = arrays[:keys], arrays[keys:]
        self.steps = int(np.diff(self.keys[0].astype(np.int64)).max()).bit_length() if keys == 3 else 0

    def find(self, keys: np.ndarray):
        """Which keys are there, and at which places."""
        if len(self.keys) == 1:
            (known,) = self.keys
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = np.flatnonzero(known[at] == keys)
            return hit, at[hit]
        tops, middle, low = self.keys
        top = (keys >> np.uint64(48)).astype(np.int64)
        rest = (keys & np.uint64((1 << 48) - 1)).astype(np.int64)
        value = lambda i: middle[i].astype(np.int64) << 32 | low[i]
        at, end = tops[top].astype(np.int64), tops[top + 1].astype(np.int64)
        for _ in range(self.steps):
            half = (at + end) >> 1
            right = (at < end) & (value(np.minimum(half, len(low) - 1)) < rest)
            at, end = np.where(right, half + 1, at), np.where(right, end, half)
        inside = np.minimum(at, len(low) - 1)
        hit = np.flatnonzero((at < tops[top + 1]) & (value(inside) == rest))
        return hit, at[hit]

    def column(self, i: int, at: np.ndarray) -> np.ndarray:
        return _pick(self.rest[3 * i:3 * i + 3], at)

    def sums(self, at: np.ndarray):
        """Which sums the contexts have, and the distinct sums as floating numbers."""
        return self.column(0, at), [x.astype(np.float64) for x in self.rest[3:7]]

    def following(self, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Counts of the n-grams of contexts and last words, 0 where there is none."""
        places, low, high, *counts = self.rest[7:]
        start = places[at].astype(np.int64)
        many = places[at + 1].astype(np.int64) - start
        value = lambda i: high[i].astype(np.int64) << 16 | low[i]
        steps = np.frexp(many - 1)[1].astype(np.int8)
        order = np.argsort(-steps, kind="stable")  # those that take most steps stand in front
        going = np.cumsum(np.bincount(steps, minlength=1)[::-1])[::-1]
        left, many, wanted = start[order], many[order], last[order]
        for n in going[1:].tolist():  # the last one that is not larger
            half = many[:n] >> 1
            probe = left[:n] + half
            left[:n] = np.where(value(probe) <= wanted[:n], probe, left[:n])
            many[:n] -= half
        start[order] = left
        hit = np.flatnonzero(value(start) == last)
        out = np.zeros(len(at), np.int64)
        out[hit] = _pick(counts, start[hit])
        return out


# -- training

def _count_words(batches):
    """Hashes and counts of words, ends of texts included."""
    held = []

    def rows():
        found, n = held.pop()
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in _text_batches(batches):
        hashes, codes, lengths = _encode(batch.column("text"))
        held.append((np.r_[hashes, END], np.r_[np.bincount(codes, minlength=len(hashes)), len(lengths)]))
        held = [_sum_by(*[np.concatenate(x) for x in zip(*held)])]
        if len(held[0][0]) >= HELD_WORDS:
            yield rows()
    if held:
        yield rows()


def _number_words(texts: DataFrame, model: Model, range_grams: int) -> None:
    """Counts the words, numbers them from the most frequent on, and writes number and count per word."""
    counts = texts.mapInArrow(tidy(_count_words), "word long, n long")
    words = write_table(counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "words")
    model.train_tokens, model.vocabulary, hot = (int(x or 0) for x in words.agg(
        F.sum("n"), F.count("*"), F.count_if(F.col("n") > HOT_SHARE * range_grams)).first())
    # More ranges than the tokens ask for cost little.
    model.bits = max(0, math.ceil(math.log2(max(1, model.train_tokens / range_grams))))
    model.hot = hot if model.bits else -1
    ranked = write_table(words.orderBy(F.desc("n"), "word").withColumn("at", F.monotonically_increasing_id()), "ranked")
    sizes = ranked.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect()
    ends = np.cumsum([0, *[r["count"] for r in sizes]])
    before = texts.sparkSession.createDataFrame([(r["part"], int(n)) for r, n in zip(sizes, ends)], "part long, before long")
    numbered = ranked.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(before), "part").select(
        "word", "n", (F.col("at").bitwiseAND((1 << 33) - 1) + F.col("before") + 1).alias("number"),
        (F.shiftrightunsigned("word", 64 - model.bits) if model.bits else F.lit(0)).cast("int").alias("shard"))

    def save(key, frame):
        _save(model.file(0, "word", False, key[0]), frame["word"].to_numpy(np.int64).view(np.uint64),
              frame["number"].to_numpy(np.int64), frame["n"].to_numpy(np.int64))
        return pd.DataFrame({"entries": [len(frame)]})

    numbered.groupBy("shard").applyInPandas(save, "entries long").agg(F.sum("entries")).first()  # writes the files


def _count_task(batches, model: Model):
    numbers, order = _Files(model, 0, "word"), model.order
    for batch in _text_batches(batches):
        hashes, codes, lengths = _encode(batch.column("text"))
        (known,) = _known(numbers, hashes)
        for _, _, flat, depth in _slices(codes, lengths, BATCH_TOKENS):
            columns = [flat]
            for back in range(1, order):
                columns.insert(0, np.r_[np.zeros(back, np.int32), flat[:-back]])
                columns[0][depth < back] = 0
            rows = []
            # The longest n-gram at a token; a shorter one starts a text and has no left side.
            for level in range(2, order + 1):
                pick = np.flatnonzero(depth >= order - 1 if level == order else depth == level - 1)
                own = [c[pick] for c in columns[order - level:]]
                if len(pick):
                    own, n = _distinct(own)
                    rows += _gram_blobs([known[c] for c in own], n, model)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.int32(), pa.binary()))],
                ["level", "kind", "shard", "blob"])


def _sizes(adjusted) -> np.ndarray:
    return np.array([(adjusted == c).sum() for c in (1, 2, 3, 4)], np.int64)


def _add_up(model: Model, shard: int, hot: bool, frame, down_to: int):
    """Adds the n-grams of a range up, from the largest order to down_to, and writes them. Returns
    the rows that go on."""
    found = _merge(frame)
    rows, carried = [], None
    for level in range(max(found), down_to - 1, -1):
        parts = [x for x in (found.get(level), carried) if x is not None]
        *columns, counts = [np.concatenate(x) for x in zip(*parts)]
        columns, counts = _distinct(columns, counts)
        rows.append((level, "sizes", 0, _squeeze(_sizes(counts))))
        first = _starts(*columns[:-1])  # contexts stand in a row
        sums = [np.add.reduceat(x, first) for x in (
            counts, *[x.astype(np.int64) for x in (counts == 1, counts == 2, counts >= 3)])]
        context = [c[first] for c in columns[:-1]]
        follow = np.diff(np.r_[first, len(counts)]), columns[-1], counts
        _save_contexts(model.file(level, "gram", hot, shard), _gram_hash(context), sums, follow)
        if hot and level == 2:  # other ranges have more of them
            rows += _word_blobs("context", context[0], model, *sums)
        if level == 2:
            last, kinds = np.unique(columns[1], return_counts=True)
            rows += _word_blobs("word", last, model, kinds)
        else:
            columns, kinds = _distinct(columns[1:])
            carried = [*columns, kinds]
    if down_to > 2:
        rows += _gram_blobs(carried[:-1], carried[-1], model)
    return rows


def _reduce_grams(level: int, model: Model):
    """Adds up the n-grams of a range: those of hot words of one order, and all others at the first step."""

    @tidy_group
    def run(key, frame):
        rows, hot = [], frame["kind"] == "hot"
        now = hot & (frame["level"] == level)
        if now.any():
            rows += _add_up(model, int(key[0]), True, frame[now], level)
        if level == model.order:
            if not hot.all():
                rows += _add_up(model, int(key[0]), False, frame[~hot], 2)
            rows += frame[hot & ~now].itertuples(index=False, name=None)
        return _frame(rows)

    return run


def _reduce_words(model: Model):
    @tidy_group
    def run(key, frame):
        shard, rows = int(key[0]), []
        of = lambda kind: [np.concatenate(x).astype(np.int64) for x in zip(*map(_open, frame["blob"][frame["kind"] == kind]))]
        if context := of("context"):
            found, *sums = _sum_by(*context)
            _save_contexts(model.file(2, "context", True, shard), _hashes(found), sums)
        if word := of("word"):
            found, kinds = _sum_by(*word)
            _save(model.file(1, "word", False, shard), _hashes(found), kinds)
            total = np.array([kinds.sum(), (kinds >= 3).sum()], np.int64)
            rows = [(1, "sizes", 0, _squeeze(_sizes(kinds))), (1, "total", 0, _squeeze(total))]
        return _frame(rows)

    return run


def discounts(n) -> tuple:
    """D1, D2, D3+ from the numbers of n-grams counted once to four times. Where a number
    is 0 the estimate does not exist and 0.5, 1, 1.5 stand in."""
    n1, n2, n3, n4 = (int(x) for x in n)
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))


def _sums(rows: DataFrame, kind: str) -> dict:
    """Sums of the small number arrays of one kind by level, one array per range and level."""
    total = {}
    for row in rows.where(F.col("kind") == kind).select("level", "blob").toLocalIterator():
        total[row["level"]] = total.get(row["level"], 0) + _open(bytes(row["blob"]))[0].astype(np.int64)
    return total


def train(spark: SparkSession, texts: DataFrame, order: int = 2, path: str | None = None,
          range_grams: int = RANGE_GRAMS) -> Model:
    """Counts the column text of all rows and writes the model to a shared folder.

    A null or empty text counts as a text of no words, that is one end token. Repeated rows
    count each time. No rows give a model that calls every token equally likely. Other columns
    are not read. order is 2 or more."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    texts = texts.select("text")
    model = Model(path or scratch_path(spark, "ngrams"), order)
    _number_words(texts, model, range_grams)
    grams = texts.mapInArrow(tidy(lambda it: _count_task(it, model)), BLOB)
    done = None
    for level in range(order, 1 if model.bits else order - 1, -1):
        now = grams if done is None else done.where((F.col("kind") == "hot") & (F.col("level") == level))
        more = write_table(now.groupBy("shard").applyInPandas(_reduce_grams(level, model), BLOB), f"order{level}")
        done = more if done is None else done.unionByName(more)
    last = done.where(F.col("kind").isin("word", "context")).groupBy("shard").applyInPandas(_reduce_words(model), BLOB)
    done = done.unionByName(write_table(last, "order1"))
    sizes, none = _sums(done, "sizes"), np.zeros(4, np.int64)
    model.discounts = {level: discounts(sizes.get(level, none)) for level in range(order, 0, -1)}
    adjusted, heavy = (int(x) for x in _sums(done, "total").get(1, none)[:2])
    ones, twos = (int(x) for x in sizes.get(1, none)[:2])
    model.unigram_total = adjusted
    d1, d2, d3 = model.discounts[1]
    model.unigram_gamma = (d1 * ones + d2 * twos + d3 * heavy) / adjusted if adjusted else 1.0
    return model


# -- scoring

class _Files:
    """The mapped files of one level and kind."""

    def __init__(self, model: Model, level: int, kind: str, columns: int = 1):
        self.model, self.level, self.kind, self.columns, self.open = model, level, kind, columns, {}

    def _part(self, hot: int, shard: int):
        if (hot, shard) not in self.open:
            try:
                self.open[hot, shard] = _Part(self.model.file(self.level, self.kind, hot, shard))
            except FileNotFoundError:  # nothing falls into this range
                self.open[hot, shard] = None
        return self.open[hot, shard]

    def _found(self, hashes, hot, shards):
        """Distinct hashes by file and place: for each file that has some, the file, which hashes, and where."""
        keys, codes, width = mix(hashes), (shards * 2 + hot).astype(np.uint64), np.uint64(self.model.bits + 1)
        order = np.argsort(codes << np.uint64(64) - width | keys >> width)
        keys, codes = keys[order], codes[order]
        bounds = np.r_[_starts(codes), len(codes)]
        for a, b in zip(bounds, bounds[1:]):
            if part := self._part(int(codes[a]) & 1, int(codes[a]) >> 1):
                hit, place = part.find(keys[a:b])
                yield part, order[a:b][hit], place

    def of_words(self, hashes) -> list:
        """For each hash of a word, the numbers stored for it, 0 where there are none."""
        out = [np.zeros(len(hashes), np.int64) for _ in range(self.columns)]
        for part, at, place in self._found(hashes, np.zeros(len(hashes), bool), _shards(hashes, self.model.bits)):
            for i, column in enumerate(out):
                column[at] = part.column(i, place)
        return out

    def contexts(self, hashes, hot, shards, of=None, last=None):
        """Total and weight of the lower order, 0 for a context not seen, and the counts of n-grams, given by
        which context they are of and their last words."""
        total, gamma = np.zeros(len(hashes)), np.zeros(len(hashes))
        d1, d2, d3 = self.model.discounts[self.level]
        rank, found, parts = np.full(len(hashes), -1), [], []
        for part, at, place in self._found(hashes, hot, shards):
            which, (t, n1, n2, n3) = part.sums(place)
            total[at], gamma[at] = t[which], ((d1 * n1 + d2 * n2 + d3 * n3) / t)[which]
            start = parts[-1][2] if parts else 0
            rank[at] = np.arange(start, start + len(at))
            found.append(place)
            parts.append((part, start, start + len(at)))
        if of is None:
            return total, gamma
        count, width = np.zeros(len(of), np.int64), self.model.vocabulary.bit_length()
        packed = rank[of]
        asked = np.flatnonzero((packed >= 0) & (last != UNKNOWN))
        packed = packed[asked] << width | last[asked]
        order = np.argsort(packed)
        packed, asked = packed[order], asked[order]
        del order  # memory
        for (part, start, end), place in zip(parts, found):
            a, b = np.searchsorted(packed, [start << width, end << width])
            own = packed[a:b]
            count[asked[a:b]] = part.following(place[(own >> width) - start], own & ((1 << width) - 1))
        return total, gamma, count


def _discounted(count: np.ndarray, d) -> np.ndarray:
    return count - np.array([0, *d])[np.minimum(count, 3)]


def _probabilities(model: Model, known, p, flat, depth, grams, hot_words) -> np.ndarray:
    """log10 of the probability of each of _flat; known and p have the numbers of its words and their
    probabilities alone. Orders go up: an n-gram is the one before without its last word, and that word."""
    logs, bits, of_words = np.log10(p)[flat], model.bits, _hashes(known)
    which, hashes, tail = flat, of_words, np.arange(len(known))  # n-grams: which is where, hashes, last words
    for k in range(2, model.order + 1):
        at = np.flatnonzero(depth >= k - 1)
        if not len(at):
            break
        before, last, own = _pairs(which[at - 1], flat[at])
        first = _starts(before)
        context, of = before[first], _repeated(first, len(before))
        v = tail[context]
        hot, lead, grown = known[v] <= model.hot, hashes[context], chain(hashes[before], of_words[last])
        shards = _shards(np.where(hot, lead, of_words[v]), bits)
        if k == 2 and hot.any():  # the bigrams of a hot word are in all ranges
            spread, some = np.flatnonzero(hot[of]), np.flatnonzero(hot)
            pair, shard, again = _pairs(of[spread], _shards(grown[spread], bits))
            part_of = of.copy()
            part_of[spread] = len(context) + again
            total, gamma, count = grams[k].contexts(
                np.r_[lead, lead[pair]], np.r_[hot, hot[pair]], np.r_[shards, shard], part_of, known[last])
            total[some], gamma[some] = hot_words.contexts(lead[some], hot[some], shards[some])
        else:
            total, gamma, count = grams[k].contexts(lead, hot, shards, of, known[last])
        lower = np.empty(len(last))
        lower[own] = p[which[at]]
        total, gamma, seen = total[of], gamma[of], _discounted(count, model.discounts[k])
        p = np.where(total > 0, seen / np.where(total > 0, total, 1) + gamma * lower, lower)
        which = np.zeros(len(flat), np.int32)
        which[at] = own
        hashes, tail = grown, last
        logs[at] = np.log10(p)[own]
    return logs


def _score_task(batches, model: Model):
    numbers = _Files(model, 0, "word", 2)
    unigrams, hot_words = _Files(model, 1, "word"), _Files(model, 2, "context")
    grams = {k: _Files(model, k, "gram") for k in range(2, model.order + 1)}
    places = 1 / (model.vocabulary + 1)
    for batch in _text_batches(batches):
        hashes, codes, lengths = _encode(batch.column("text"))
        known, raw = _known(numbers, hashes)
        (count,) = unigrams.of_words(_hashes(known))
        p = np.full(len(known), places) if not model.unigram_total else (
            _discounted(count, model.discounts[1]) / model.unigram_total + model.unigram_gamma * places
        )
        base = np.log10((raw + 1) / (model.train_tokens + 1.0 * (model.vocabulary + 1)))
        for a, b, flat, depth in _slices(codes, lengths, BATCH_TOKENS):
            logs = _probabilities(model, known, p, flat, depth, grams, hot_words)
            at = np.flatnonzero(depth)
            words, n = flat[at], lengths[a:b] + 1
            first = np.cumsum(n) - n
            score = np.add.reduceat(logs[at], first)
            found = [
                n, np.add.reduceat((raw > 0)[words].astype(np.int64), first), np.add.reduceat(base[words], first),
                score, 10 ** (-score / n),
            ]
            own = batch.slice(a, b - a).drop_columns("text")
            yield pa.RecordBatch.from_arrays(
                [*own.columns, *map(pa.array, found)], [*own.schema.names, *(x.split()[0] for x in SCORES.split(", "))])


SCORES = "n_tokens long, n_known long, base_score double, score double, perplexity double"


def score(texts: DataFrame, model: Model, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns, tokens (end included), known tokens, log10 probability by
    add-one unigrams and by the model, and perplexity per token. A null or empty text is one
    end token. Repeated rows are scored each; other columns are left out."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keys).schema)
    return texts.select(*keys, "text").mapInArrow(
        tidy(lambda it: _score_task(it, model)), f"{kinds}, {SCORES}" if kinds else SCORES
    )


def describe(model: Model) -> str:
    """The model's few numbers as JSON."""
    return json.dumps({k: v for k, v in vars(model).items() if k != "path"})
