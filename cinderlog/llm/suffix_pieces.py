"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid out as one text. Its suffixes are sorted by as many
characters as the longest piece has; every piece is looked up by binary search, which gives
the range of all its occurrences; the ranges become edges (start, length, piece), laid out
by position. Then the edges are relaxed: for a unigram model along positions to the path
with the best sum of scores, for a byte-pair model in order of merging, where two neighbours
join if an edge spans them, the best-scored edge first, then the leftmost. Ids are those of
the sentencepiece library for models without normalisation rules (tested).

A word is a run of spaces with what follows up to the next space: no piece has a space after
another character, so nothing spans two words. Workers keep words they have met, up to a bound.
"""

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import receive, send, slices, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Words of a batch, characters of a text that is indexed at a time, words kept, and the length
# from which a word is merged by itself.
BATCH_UNITS, BATCH_CHARS, KEPT, LONG = 50_000, 250_000, 100_000, 64
FREE = np.iinfo(np.int64).max


@dataclass
class Vocabulary:
    pieces: list         # text of the ordinary pieces
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray  # of the 256 bytes; -1 where the model has none
    unknown: int
    merges: bool         # byte-pair model
    shown: list          # id -> bytes when decoded
    longest: int


def load(path: str = MODEL) -> Vocabulary:
    """Reads a model file on the driver. Byte-pair models are known by their scores, which are
    negative places in the order of merging; unigram models have log-probabilities."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    everything = range(sp.vocab_size())
    plain = [i for i in everything if not (
        sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = [sp.id_to_piece(i) for i in plain]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece spans two words")
    bytes_of = np.full(256, -1)
    shown = [b""] * sp.vocab_size()
    for i in everything:
        if sp.is_byte(i):
            value = int(sp.id_to_piece(i)[3:5], 16)
            bytes_of[value], shown[i] = i, bytes([value])
        elif sp.is_unknown(i):
            shown[i] = " ⁇ ".encode()
    for i, p in zip(plain, pieces):
        shown[i] = p.replace(SPACE, " ").encode()
    scores = np.array([sp.get_score(i) for i in plain])
    return Vocabulary(
        pieces, np.array(plain, np.int32), scores, bytes_of, sp.unk_id(),
        bool(np.all(scores == np.round(scores))), shown, max(map(len, pieces)),
    )


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Numbers(dict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        letters = np.unique(_points("".join(v.pieces)))
        # 0 ends a word, 1 is any character that no piece has
        self.letter = np.ones(0x110000, np.uint16)
        self.letter[letters] = np.arange(2, len(letters) + 2)
        self.width = 4 * -(-v.longest // 4)
        first, last = [], []
        for p in v.pieces:
            code = self.letter[_points(p)].astype(">u2").tobytes()
            first.append(code)
            last.append(code + b"\xff" * (2 * self.width - len(code)))
        kind = f"S{2 * self.width}"
        self.first, self.last = np.array(first, kind), np.array(last, kind)
        self.lengths = np.array([len(p) for p in v.pieces])
        # place of a piece in the order of merging: better scores first
        _, self.turn = np.unique(-v.scores, return_inverse=True)
        self._forget()

    def _forget(self):
        self.known, self.flat, self.offsets = Numbers(), [np.empty(0, np.int32)], [np.zeros(1, np.int64)]

    def suffix_array(self, codes: np.ndarray) -> np.ndarray:
        """Starts of the suffixes in order of their first characters (as many as the longest
        piece has), by ranks of doubled length: 4, 8, 16 ..."""
        n = len(codes)
        padded = np.concatenate([codes.astype(np.uint64), np.zeros(4, np.uint64)])
        key = sum(padded[i: n + i] << np.uint64(48 - 16 * i) for i in range(4))
        reach = 4
        while True:
            order = np.argsort(key)
            if reach >= self.width:
                return order
            k = key[order]
            rank = np.empty(n, np.uint64)
            rank[order] = np.cumsum(np.r_[True, k[1:] != k[:-1]], dtype=np.uint64)
            shifted = np.concatenate([rank[reach:], np.zeros(min(reach, n), np.uint64)])
            key = (rank << np.uint64(32)) | shifted
            reach *= 2

    def edges(self, codes: np.ndarray):
        """Occurrences of all pieces: start, length, number of the piece."""
        order = self.suffix_array(codes)
        padded = np.concatenate([codes, np.zeros(self.width, np.uint16)]).astype(">u2")
        heads = np.lib.stride_tricks.sliding_window_view(padded, self.width)[order]
        heads = np.ascontiguousarray(heads).view(f"S{2 * self.width}").ravel()
        low, high = np.searchsorted(heads, self.first, "left"), np.searchsorted(heads, self.last, "right")
        count = high - low
        piece = np.repeat(np.arange(len(count)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = order[np.repeat(low, count) + inside]
        return start, self.lengths[piece], piece

    def _relax_path(self, codes, bounds, start, length, piece):
        """Best sum of scores along positions, all words side by side: (start, length, piece)
        of the chosen edges in order. Characters without an edge cost ten below the worst."""
        n = len(codes)
        by_place = np.argsort(start * (self.width + 1) + length)
        start, length, piece = start[by_place], length[by_place], piece[by_place]
        worst = self.vocabulary.scores.min() - 10
        best, back_len, back_piece = np.full(n + 1, -np.inf), np.zeros(n + 1, np.int64), np.full(n + 1, -1)
        best[bounds[:-1]] = 0.0
        at = np.searchsorted(start, np.arange(n + 1))
        for depth in range(int((np.diff(bounds) - 1).max(initial=0))):
            here = bounds[:-1][np.diff(bounds) - 1 > depth] + depth
            for step in range(self.width):
                e = at[here] + step
                here_e = e < at[here + 1]
                e, h = e[here_e], here[here_e]
                if not len(e):
                    break
                to, value = h + length[e], best[h] + self.vocabulary.scores[piece[e]]
                gain = value > best[to]
                best[to[gain]], back_len[to[gain]], back_piece[to[gain]] = value[gain], length[e[gain]], piece[e[gain]]
            value = best[here] + worst
            gain = (value > best[here + 1]) & ((at[here] == at[here + 1]) | (length[np.minimum(at[here], len(length) - 1)] > 1))
            best[here[gain] + 1], back_len[here[gain] + 1], back_piece[here[gain] + 1] = value[gain], 1, -1
        out = []
        spot, begin = bounds[1:] - 1, bounds[:-1]
        while len(spot):
            live = spot > begin
            spot, begin = spot[live], begin[live]
            out.append((spot - back_len[spot], back_piece[spot]))
            spot = spot - back_len[spot]
        begin, number = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(begin)
        return begin[order], number[order]

    def _relax_merges(self, codes, bounds, start, length, piece):
        """Merging in order of score, then place, all words side by side and long ones by
        themselves: (start, piece) of what is left, in order."""
        span = self.width + 1
        # A place for every start and length sorts the edges by position at once.
        at_edge = np.full((len(codes) + 1) * span, -1, np.int32)
        at_edge[start * span + length] = piece
        sizes = np.diff(bounds) - 1
        symbol = np.flatnonzero(codes)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        heavy = sizes > LONG
        done_at, done_len = [], []
        for u in np.flatnonzero(heavy):
            a, b = self._merge_alone(at_edge, bounds[u], sizes[u])
            done_at.append(a), done_len.append(b)
        keep = ~heavy[unit]
        symbol, unit = symbol[keep], unit[keep]
        size = np.ones(len(symbol), np.int64)
        while len(symbol):
            pair = np.empty(len(symbol), np.int64)
            both = size[:-1] + size[1:]
            fits = (unit[:-1] == unit[1:]) & (both < span)
            found = at_edge[symbol[:-1] * span + np.where(fits, both, 0)]
            ok = fits & (found >= 0)
            pair[:-1] = np.where(ok, (self.turn[found].astype(np.int64) << 32) + np.arange(len(found)), FREE)
            pair[-1] = FREE
            first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            best = np.minimum.reduceat(pair, first)
            ended = best == FREE
            merge = (best[~ended] & 0xFFFFFFFF)
            size[merge] += size[merge + 1]
            stay = np.ones(len(symbol), bool)
            stay[merge + 1] = False
            over = np.repeat(ended, np.diff(np.r_[first, len(symbol)]))
            done_at.append(symbol[over]), done_len.append(size[over])
            stay &= ~over
            symbol, unit, size = symbol[stay], unit[stay], size[stay]
        begin = np.concatenate(done_at) if done_at else np.empty(0, np.int64)
        width = np.concatenate(done_len) if done_len else np.empty(0, np.int64)
        order = np.argsort(begin)
        begin, width = begin[order], width[order]
        return begin, at_edge[begin * span + width]

    def _merge_alone(self, at_edge, begin: int, n: int):
        """The same for one long word, with a heap."""
        span = self.width + 1
        size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = after[i]
            if i >= 0 and j < n and size[i] + size[j] < span:
                found = at_edge[(begin + i) * span + size[i] + size[j]]
                if found >= 0:
                    heapq.heappush(heap, (int(self.turn[found]), i, size[i], size[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if size[i] != a or j >= n or size[j] != b:
                continue  # one of the two has changed since
            size[i], size[j] = a + b, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        left = [i for i in range(n) if size[i]]
        return begin + np.array(left), np.array([size[i] for i in left])

    def encode_units(self, units):
        """Ids of all words one after the other, and where each begins."""
        points = _points("\x00".join(units) + "\x00").copy()
        lengths = np.array([len(u) for u in units]) + 1
        bounds = np.r_[0, np.cumsum(lengths)]
        codes = self.letter[points]
        codes[bounds[1:] - 1] = 0
        codes[(codes == 0) & ~np.isin(np.arange(len(codes)), bounds[1:] - 1)] = 1
        relax = self._relax_merges if self.vocabulary.merges else self._relax_path
        begin, number = relax(codes, bounds, *self.edges(codes))
        ids = np.where(number >= 0, self.vocabulary.ids[number], -1).astype(np.int32)
        count = np.ones(len(ids), np.int64)
        strange = np.flatnonzero(number < 0)
        spelled = {i: self._spell(int(points[begin[i]])) for i in strange}
        for i, s in spelled.items():
            count[i] = len(s)
        out = np.repeat(ids, count)
        place = np.cumsum(count) - count
        for i, s in spelled.items():
            out[place[i]: place[i] + len(s)] = s
        unit = np.searchsorted(bounds, begin, "right") - 1
        return out, np.r_[0, np.cumsum(np.bincount(unit, count, len(units)).astype(np.int64))]

    def _spell(self, point: int):
        """Ids of the bytes of a character that no piece has."""
        ids = [self.vocabulary.byte_ids[b] for b in chr(point).encode()]
        return ids if min(ids) >= 0 else [self.vocabulary.unknown]

    def _learn(self, fresh):
        at = 0
        while at < len(fresh):
            end, size = at, 0
            while end < len(fresh) and size < BATCH_CHARS:
                size += len(fresh[end]) + 1
                end += 1
            flat, offsets = self.encode_units(fresh[at:end])
            self.flat.append(flat)
            self.offsets.append(offsets[1:] + self.offsets[-1][-1])
            at = end
        self.flat, self.offsets = [np.concatenate(self.flat)], [np.concatenate(self.offsets)]

    def encode(self, unit_lists):
        """Ids of each text, given as its words."""
        if len(self.known) > KEPT:
            self._forget()
        known = self.known
        before = len(known)
        number = np.fromiter(
            map(known.__getitem__, chain.from_iterable(unit_lists)), np.int64, sum(map(len, unit_lists)))
        if len(known) > before:
            self._learn(list(islice(known, before, None)))  # in the order in which they came
        offsets, flat = self.offsets[0], self.flat[0]
        begin, size = offsets[number], offsets[number + 1] - offsets[number]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(begin, size)
        ids = flat[place]
        cut = np.r_[0, ends][np.cumsum([0] + [len(x) for x in unit_lists])]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]


def units(text) -> list:
    """Words of a text with the space that stands before every text."""
    return UNIT.findall(SPACE + text.replace(" ", SPACE)) if isinstance(text, str) and text else []


def decode(ids, shown: list) -> str:
    """Text of ids, without the space in front. Bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(shown.__getitem__, ids)).decode("utf-8", "replace")[1:]


@tidy
def _encode(texts, shared):
    encoder = Encoder(receive(shared))
    for batch in texts:
        # Taken and handed on by parts: the strings, words and ids of a batch are never held all at once.
        for _, lists in slices((text.as_py() for text in batch), BATCH_UNITS, units):
            yield _lists(encoder.encode(lists))


def _lists(arrays) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int32)))


def _kinds(frame: DataFrame, keys) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(*keys).schema)


def encode(documents: DataFrame, vocabulary: Vocabulary, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns and ids. Null and empty texts have no ids; every other text
    gets one space in front. Repeated rows are encoded each."""
    shared = send(documents.sparkSession, vocabulary)

    @F.arrow_udf("array<int>")
    def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _encode(texts, shared)

    # Workers see texts alone; the other columns of a row wait in the JVM, which can spill them.
    return documents.select(*keys, ids("text").alias("ids"))


def _decode(frames, shared, keys):
    shown = receive(shared)
    for frame in frames:
        texts = [decode(x, shown) if x is not None else None for x in frame["ids"]]
        yield frame[list(keys)].assign(text=pd.Series(texts, index=frame.index, dtype=object))


def decoded(encoded: DataFrame, vocabulary: Vocabulary, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns and the text of its ids (null for null ids). What comes back
    is the text that was encoded, with U+2581 as a space; null texts come back empty."""
    shared = send(encoded.sparkSession, vocabulary.shown)
    return encoded.select(*keys, "ids").mapInPandas(
        lambda it: _decode(it, shared, keys), f"{_kinds(encoded, keys)}, text string")


@tidy
def _summary(frames, shared, keys):
    vocabulary = receive(shared)
    encoder, spelled = Encoder(vocabulary), np.zeros(len(vocabulary.shown), bool)
    spelled[vocabulary.byte_ids[vocabulary.byte_ids >= 0]] = True
    for frame in frames:
        rows = []
        at = 0
        for _, lists in slices(frame["text"], BATCH_UNITS, units):
            for ids, text in zip(encoder.encode(lists), frame["text"].iloc[at: at + len(lists)]):
                same = decode(ids, vocabulary.shown) == (text or "").replace(SPACE, " ")
                rows.append((len(ids), int(spelled[ids].sum()), zlib.crc32(ids.astype("<i4").tobytes()), same))
            at += len(lists)
        out = pd.DataFrame(rows, columns=["n_tokens", "n_bytes", "ids_crc32", "round_trip"], index=frame.index)
        yield pd.concat([frame[list(keys)], out], axis=1)


def summary(documents: DataFrame, vocabulary: Vocabulary, keys=("doc_id",)) -> DataFrame:
    """Per row: its key columns, tokens, byte tokens among them, crc32 of the ids as 32-bit
    little-endian numbers, and whether decoding them gives the text back."""
    shared = send(documents.sparkSession, vocabulary)
    return documents.select(*dict.fromkeys([*keys, "text"])).mapInPandas(
        lambda it: _summary(it, shared, keys),
        f"{_kinds(documents, keys)}, n_tokens long, n_bytes long, ids_crc32 long, round_trip boolean")
