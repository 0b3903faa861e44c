"""Helpers shared by the operators: words, hashes, splits, table access, array files."""

import ctypes
import functools
import gc
import hashlib
import os
import pickle
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Odd multipliers of a 64-bit finaliser (splitmix64), and of the fold that chains words.
MIX_A, MIX_B, FOLD = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(ids, modulus: int, remainder: int):
    """True where crc32 of the id as text leaves the remainder; a null id counts as ''."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def set_apart(docs: DataFrame, keep=("doc_id", "text")) -> tuple:
    """(docs with generated names for all columns but keep, function that restores the names):
    an operator then adds columns that clash with none of its input."""
    own = {name: name if name in keep else f"in_{i}" for i, name in enumerate(docs.columns)}

    def restore(df: DataFrame, *more) -> DataFrame:
        return df.select(*[F.col(new).alias(name) for name, new in own.items() if name not in more], *more)

    return docs.toDF(*own.values()), restore


def words(text) -> list:
    """Words [^\\x20\\x09-\\x0D]+ of a text with A-Z lower-cased, as UTF-8. bytes.lower()
    changes A-Z only and bytes.split() cuts at exactly these six bytes."""
    return text.encode("utf-8").lower().split() if isinstance(text, str) else []


def _give_back():
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def tidy(task):
    """The generator of a task that hands freed memory back to the system at its end. Workers are
    kept for later tasks, which may be JVM work alone: they should not sit on a peak meanwhile."""

    @functools.wraps(task)
    def run(*args, **kwargs):
        try:
            yield from task(*args, **kwargs)
        finally:
            _give_back()

    return run


def tidy_group(reduce):
    """The function of a group (key and frame) that hands freed memory back to the system at its end."""

    def run(key, frame):
        try:
            return reduce(key, frame)
        finally:
            _give_back()

    return run


class WordHashes(dict):
    """64-bit hash of each word met, remembered up to a bound."""

    def __init__(self, limit=1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word):
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def array(self, tokens) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX_A)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of all but its last item and of that item."""
    return mix(left * np.uint64(FOLD) + right)


def slices(texts, budget: int, cut):
    """(first row, token lists) of consecutive rows, with about budget tokens at a time."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        tokens = cut(text)
        held.append(tokens)
        size += len(tokens)
        if size >= budget:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def smallest(values: np.ndarray) -> np.ndarray:
    """Unsigned values in the narrowest type that holds them."""
    top = int(values.max()) if len(values) else 0
    for kind in (np.uint8, np.uint16, np.uint32):
        if top <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype(np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value, each with its type and length in front."""
    parts = []
    for a in arrays:
        head = f"{a.dtype.str}:{len(a)};".encode()
        parts += [head, a.tobytes()]
    return b"".join(parts)


def unpack(blob: bytes) -> list:
    out, at = [], 0
    while at < len(blob):
        end = blob.index(b";", at)
        kind, n = blob[at:end].decode().split(":")
        kind = np.dtype(kind)
        out.append(np.frombuffer(blob, kind, int(n), end + 1))
        at = end + 1 + int(n) * kind.itemsize
    return out


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put_array(uri: str, array: np.ndarray) -> None:
    """Writes an array file whole or not at all: a repeated task replaces it by an equal one."""
    store, path = _store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(array).data)
    store.move(draft, path)


def map_array(uri: str, kind, length: int | None = None) -> np.ndarray:
    """The array of a file, mapped into memory: pages are read as they are touched. A file
    of a store that cannot be mapped is copied to an unnamed file of the worker first. Kind
    "u" stands for unsigned integers of the width that the length tells."""
    from pyarrow import fs

    store, path = _store(uri)
    if isinstance(store, fs.LocalFileSystem):
        return _mapped(path, os.path.getsize(path), kind, length)
    with store.open_input_stream(path) as src, tempfile.TemporaryFile() as own:
        while block := src.read(1 << 22):
            own.write(block)
        own.flush()
        return _mapped(own, own.tell(), kind, length)


def _mapped(source, size: int, kind, length):
    if not size:
        return np.empty(0, np.uint8 if kind == "u" else kind)
    return np.memmap(source, f"u{size // length}" if kind == "u" else kind, "r")


def send(spark: SparkSession, value):
    """A broadcast of a value of bounded size, classes of this package included."""
    from pyspark import cloudpickle

    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def receive(shared):
    return pickle.loads(shared.value)
