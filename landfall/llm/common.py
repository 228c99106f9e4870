"""Helpers shared by the operators of this subpackage: scratch tables in the
cluster's shared folder, Arrow text buffers, integer mixing."""

from __future__ import annotations

import ctypes
import os
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.upsert import BITMAP_BITS, broadcast_budget, split_by_bitmap
from landfall.session import ensure_checkpoint_dir

#: Texts are worked on in slices of about so many bytes, which bounds the
#: memory of a Python worker whatever the Arrow batch holds. A longer text is
#: a slice of its own.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, deleted when the
    driver's JVM ends, if not before."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landfall-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    target.getFileSystem(conf).deleteOnExit(target)
    return path


_SCOPES = threading.local()


@contextmanager
def scope() -> Iterator[None]:
    """What is staged inside is deleted at the end, but for tables that
    outlive it. Nothing that reads the others may be left to run."""
    held = _SCOPES.held = getattr(_SCOPES, "held", [])
    held.append([])
    try:
        yield
    finally:
        discard(*held.pop())


def staged(df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the
    lineage, so that a lost executor never reruns what stands before, and
    lets several consumers share one pass. ``outlives``: it belongs to the
    scope around the innermost one."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    scopes = getattr(_SCOPES, "held", [])
    if len(scopes) > outlives:
        scopes[-1 - outlives].append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables whose last reader has run."""
    for t in tables:
        if path := getattr(t, "staged_at", None):
            target = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def split_asked(docs: DataFrame, wanted: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``docs`` that may have the ``keys`` of ``wanted``, and the
    others if they could be told apart: by a bitmap of hashes, where it is
    small enough to be broadcast. Texts that nothing is asked of don't move."""
    n = wanted.count()
    if n * BITMAP_BITS // 8 > broadcast_budget(docs.sparkSession):
        return docs, None
    return split_by_bitmap(docs, wanted.select(*keys), keys, n)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


# ------------------------------------------------------------ integer mixing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


# ------------------------------------------------------------ Arrow text

_HELD: dict = {"stage": None, "objects": {}}

#: The C library's call that returns free memory to the system, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def give_back() -> None:
    """Return freed memory to the system. A worker counts with what it holds,
    and freed arrays of some MB, or a library's small blocks, else stay with it."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def _this_stage() -> dict:
    """What this worker keeps from task to task of a stage. A worker lives on
    for other stages, which need its memory for themselves."""
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if stage != _HELD["stage"]:
        _HELD["objects"].clear()
        _POWERS.clear()
        _HELD["stage"] = stage
        give_back()
    return _HELD["objects"]


def kept(key, make: Callable):
    """``make()``, once for the tasks of a stage that a worker runs."""
    held = _this_stage()
    if key not in held:
        held[key] = make()
    return held[key]


@dataclass
class TextSlice:
    """Some consecutive texts of a batch: rows ``start`` to ``stop``, their
    UTF-8 bytes back to back, and where each text begins in them."""

    start: int
    stop: int
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, one more than there are texts

    def __len__(self) -> int:
        return self.stop - self.start


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS) -> Iterator[TextSlice]:
    """The texts of an Arrow string column in bounded slices, without copying
    them into Python strings. Null counts as empty."""
    _this_stage()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), n, at + max_rows)
        base = int(offsets[at])
        yield TextSlice(at, to, data[base:int(offsets[to])], offsets[at:to + 1] - base)
        at = to


# ------------------------------------------------------------ words

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Two independent ways to hash: a random number for each byte, an odd base.
_BYTE = [mix(np.arange(1 + 256 * k, 257 + 256 * k, dtype=np.uint64) * GOLD) for k in (0, 1)]
_BASE = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
_POWERS: dict[tuple[int, int], np.ndarray] = {}
_POWERS_STEP = SLICE_BYTES // 4


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept for a stage."""
    if len(_POWERS.get((which, 1), ())) < n:
        size = -(-(n - 1) // _POWERS_STEP) * _POWERS_STEP + 1
        for sign in (1, -1):
            a = np.full(size, pow(_BASE[which], sign, 1 << 64), dtype=np.uint64)
            a[0] = 1
            _POWERS[which, sign] = np.multiply.accumulate(a)
    return _POWERS[which, 1], _POWERS[which, -1]


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over the bytes;
    ``second`` gives another, independent one."""
    up, down = _powers(int(second), len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[second][data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * GOLD)


@dataclass
class Words:
    """The whitespace-separated words of a slice, in order."""

    hash: np.ndarray      # uint64 for each word
    start: np.ndarray     # byte position of each word
    end: np.ndarray
    first: np.ndarray     # for each text, its first word; one more than there are texts

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(s: TextSlice) -> Words:
    """Words are runs of bytes other than ASCII white space (the tab to
    carriage return, and space), taken as they stand."""
    inside = ~_SPACE[s.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = s.offsets[:-1][np.diff(s.offsets) > 0]
    begins[cut] |= inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = s.offsets[1:][np.diff(s.offsets) > 0] - 1
    ends[last] |= inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(span_hash(s.data, start, end), start, end, np.searchsorted(start, s.offsets))


class Runs:
    """Hashes of runs of words, from one running sum over the words."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = _powers(0, len(hashes) + 1)
        self.total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=self.total[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * GOLD)


_PLACE = mix(np.arange(101, 165, dtype=np.uint64) * GOLD) | np.uint64(1)


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of ``size`` words; a text of fewer
    words, but one at least, has the one shingle of all its words."""
    n = len(w.hash)
    text = w.text_of()
    stop = w.first[1:][text]
    at = np.arange(n)
    starts = np.flatnonzero((at + size <= stop) | (at == w.first[:-1][text]))
    total = np.zeros(len(starts), dtype=np.uint64)
    for j in range(size):
        there = starts + j < stop[starts]
        part = np.zeros(len(starts), dtype=np.uint64)
        part[there] = w.hash[starts[there] + j] * _PLACE[j]
        total += part
    return mix(total), text[starts]
