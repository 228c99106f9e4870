"""Operator 1, packing: bounded-space online packing of token ids.

Every partition streams over its documents and keeps a fixed number of open
windows. A document's ids (and the end id) are cut at multiples of the
capacity; full pieces are sequences at once, the rest goes into the open
window that it leaves least room in (best fit). When no window has room and
all are open, the fullest is emitted. The windows that are still open when a
partition ends are its leftovers: they are merged, whole windows best-fit
into one another, ``fan_in`` partitions to a task and round after round, until
one group is left. A task never holds more than ``windows * fan_in`` windows.

Defined results: a null text counts as empty and still has its end id; a null
id stays null; repeated rows are packed each; an empty table gives no rows;
other columns are ignored. Which documents share a sequence depends on the
partitions; each piece's own columns do not.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from landfall.llm.common import SLICE_BYTES, give_back, staged, text_slices
from landfall.llm.segments import encoder

CAPACITY = 2048
WINDOWS = 64
FAN_IN = 32
END_ID = 1

#: Slices after which a task returns freed memory to the system.
GIVE_BACK = 8

#: A sequence's number: the round, the group in it, and a count in the group.
_ROUND, _GROUP = 1 << 59, 1 << 36


class Windows:
    """Open windows of one task, found by their room. ``put`` yields the
    windows that it emits, each a list of (payload, length)."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.rooms: list[tuple[int, int]] = []   # (room, window), sorted
        self.items: dict[int, list] = {}
        self.made = 0

    def put(self, items: list, length: int) -> Iterator[list]:
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.most:
                yield self.items.pop(self.rooms.pop(0)[1])
            room, window, self.made = self.capacity, self.made, self.made + 1
            self.items[window] = []
        self.items[window] += items
        if room == length:
            yield self.items.pop(window)
        else:
            insort(self.rooms, (room - length, window))

    def rest(self) -> Iterator[list]:
        for _, window in self.rooms:
            yield self.items.pop(window)


class _Out:
    """Rows of emitted windows, as Arrow batches of a bounded size."""

    def __init__(self, schema: pa.Schema, round_: int, group: int):
        self.schema, self.rows, self.group = schema, [], group
        self.next = round_ * _ROUND + group * _GROUP

    def add(self, window: list, is_open: bool) -> None:
        offset = 0
        for piece in window:
            self.rows.append((*piece, self.next, offset, is_open, self.group))
            offset += piece[2]
        self.next += 1

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
            self.rows = []


def _schema(id_type: T.DataType, with_ids: bool) -> T.StructType:
    fields = [("doc_id", id_type), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()),
              ("doc_tokens", T.LongType()), *([("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
              ("sequence_id", T.LongType()), ("offset", T.LongType()), ("open", T.BooleanType()), ("group", T.LongType())]
    return T.StructType([T.StructField(*f) for f in fields])


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, windows: int = WINDOWS, fan_in: int = FAN_IN,
         end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``, with the piece's ids as ``ids`` if
    asked for. ``tokenizer`` is the path of a byte-level BPE .json file that
    every worker can read."""
    if capacity < 1 or windows < 1 or fan_in < 2:
        raise ValueError("capacity and windows must be positive, fan_in at least 2")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spec = _schema(docs.schema["doc_id"].dataType, with_ids)
    arrow = to_arrow_schema(spec)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        held = Windows(capacity, windows)
        out = _Out(arrow, 0, TaskContext.get().partitionId())
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for k, s in enumerate(text_slices(batch.column(1), SLICE_BYTES // 4), 1):
                flat, begins = encode(s)
                begins = begins.tolist()
                for i in range(len(s)):
                    ids = np.append(flat[begins[i]:begins[i + 1]], np.uint32(end_id))
                    total = len(ids)
                    for start in range(0, total, capacity):
                        part = ids[start:start + capacity]
                        piece = (doc_ids[s.start + i], start, len(part), zlib.crc32(part.astype("<u4").tobytes()), total,
                                 *([part.astype(np.int32)] if with_ids else []))
                        for window in held.put([piece], len(part)):
                            out.add(window, False)
                yield from out.flush(5000)
                if k % GIVE_BACK == 0:
                    give_back()
        for window in held.rest():
            out.add(window, True)
        yield from out.flush()

    parts = [staged(docs.mapInArrow(first_pass, spec), "pack")]
    groups = _groups(parts[0])
    round_ = 0
    while groups:
        round_ += 1
        last = groups <= fan_in
        groups = -(-groups // fan_in)
        parts.append(staged(_merge(parts[-1].where("open"), spec, arrow, round_, fan_in, capacity, windows, last), "pack"))
        if last:
            break
    done = parts[0].where(~F.col("open"))
    for part in parts[1:]:
        done = done.unionByName(part.where(~F.col("open")))
    return done.drop("open", "group")


def _groups(part: DataFrame) -> int:
    return (part.where("open").agg(F.max("group")).first()[0] or 0) + 1 if not part.where("open").isEmpty() else 0


def _merge(left: DataFrame, spec: T.StructType, arrow: pa.Schema, round_: int, fan_in: int, capacity: int, windows: int,
           last: bool) -> DataFrame:
    """One round: the leftovers of ``fan_in`` groups, largest first, best-fit
    into at most that many windows; up to ``windows`` stay open for the next
    round, none in the last one."""
    names = [f.name for f in arrow][:-4]

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        pieces = list(zip(*(rows.column(n).to_pylist() for n in names)))
        sequence = rows.column("sequence_id").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(sequence)) + 1).tolist(), len(pieces)]
        found = [pieces[a:b] for a, b in zip(cuts, cuts[1:])]
        found.sort(key=lambda w: -sum(p[2] for p in w))
        held = Windows(capacity, len(found))
        out = _Out(arrow, round_, key[0].as_py())
        for window in found:
            for full in held.put(window, sum(p[2] for p in window)):
                out.add(full, False)
        rest = list(held.rest())
        for k, window in enumerate(reversed(rest)):  # the roomiest stay open
            out.add(window, not last and k < windows)
        return pa.Table.from_batches(out.flush(), schema=arrow)

    grouped = left.withColumn("to", (F.col("group") / fan_in).cast("long"))
    return grouped.groupBy("to").applyInArrow(lambda key, table: merge(key, table), spec)


def op1(spark, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 2048 ids."""
    import public_tokenizers

    from landfall.llm.common import read
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
