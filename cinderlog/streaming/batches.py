"""Folders of micro-batches, and snapshots of what they amount to.

A batch is written beside its folder and moved into place when it is complete: readers of the
folder, other streams among them, see a batch whole or not at all, and a replayed batch finds
its name taken. A snapshot holds the state up to some batch; a pointer names the newest one.
Pointers are files that rise by number and appear by rename, so a reader keeps to the one it
has read. Compaction deletes what only readers of older pointers than the last but one need.
"""

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cinderlog.session import children, move, path_exists, put_text, read_text, remove


@dataclass(frozen=True)
class Pointer:
    number: int
    folder: str  # of the snapshot
    upto: int    # the last batch in it


def batch_folder(path, batch_id) -> str:
    return f"{path}/batch_id={batch_id}"


def _beside(path, kind) -> str:
    return f"{str(path).rstrip('/')}.{kind}"


def batch_ids(spark: SparkSession, path) -> list:
    found = (re.fullmatch(r"batch_id=(\d+)", name) for name in children(spark, str(path)))
    return sorted(int(m.group(1)) for m in found if m)


def published(spark: SparkSession, path, batch_id: int) -> bool:
    """Whether a batch is there, or was and is part of a snapshot."""
    if path_exists(spark, batch_folder(path, batch_id)):
        return True
    at = pointer(spark, path)
    return at is not None and batch_id <= at.upto


def publish(spark: SparkSession, path, batch_id: int, write: Callable) -> bool:
    """write(folder) a batch and move it into place; False if it was published before."""
    if published(spark, path, batch_id):
        return False
    draft = f"{_beside(path, 'staging')}/{batch_id}-{uuid.uuid4().hex}"
    write(draft)
    done = move(spark, draft, batch_folder(path, batch_id))
    if not done:
        remove(spark, draft)
    return done


def pointer(spark: SparkSession, path, number: int | None = None) -> Pointer | None:
    """The newest pointer, or the one of a number; None without snapshots."""
    home = _beside(path, "versions")
    names = [n for n in children(spark, home) if re.fullmatch(r"pointer-\d{12}", n)]
    if number is not None:
        names = [n for n in names if int(n[8:]) == number]
    if not names:
        return None
    held = json.loads(read_text(spark, f"{home}/{names[-1]}"))
    return Pointer(int(names[-1][8:]), f"{home}/{held['folder']}", held["upto"])


def read_batches(spark: SparkSession, path, at: Pointer | None, read: Callable, before: int | None = None):
    """read(folders) over the batches behind a pointer and before a batch; None if there are none."""
    after = -1 if at is None else at.upto
    ids = [b for b in batch_ids(spark, path) if b > after and (before is None or b < before)]
    return read([batch_folder(path, b) for b in ids]) if ids else None


def compact(spark: SparkSession, path, state: DataFrame, upto: int) -> Pointer:
    """Publish state as the snapshot of all batches up to upto, and clean up: batches that the
    pointer before it already held, and snapshots older than that. Two compactions at once: one of
    them is refused."""
    home, last = _beside(path, "versions"), pointer(spark, path)
    number = 0 if last is None else last.number + 1
    name = f"data-{number:012d}-{uuid.uuid4().hex[:12]}"
    state.write.parquet(f"{home}/{name}")
    if not put_text(spark, f"{home}/pointer-{number:012d}", json.dumps({"folder": name, "upto": upto})):
        remove(spark, f"{home}/{name}")
        raise RuntimeError("another compaction has published its snapshot first")
    if last is not None:
        for batch in batch_ids(spark, path):
            if batch <= last.upto:
                remove(spark, batch_folder(path, batch))
        keep = {name, last.folder.rpartition("/")[2], f"pointer-{number:012d}", f"pointer-{last.number:012d}"}
        for old in children(spark, home):
            if re.match(r"(data|pointer)-(\d{12})", old) and old not in keep and int(old.split("-")[1]) < number:
                remove(spark, f"{home}/{old}")
    return Pointer(number, f"{home}/{name}", upto)
