"""Runs of equal keys in sorted rows, found by comparing neighbours.

Rows are sorted by ranges of all their keys and places, so a run of equal keys
is dealt over as many tasks as it needs. Each task streams over its rows and
compares each with the one before; where a run crosses the bounds of a task,
the facts are carried over: two rows of each task reach the driver, nothing
else. No run is gathered, and no row is joined."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import discard, staged


def _differs(table: pa.Table, names: list[str]) -> np.ndarray:
    """For each row whether it differs in ``names`` from the one before; true for the first."""
    out = np.ones(table.num_rows, bool)
    out[1:] = False
    for n in names:
        c = table.column(n).combine_chunks()
        if table.num_rows > 1:
            out[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return out


def sorted_runs(rows: DataFrame, coarse: list[str], fine: list[str], place: list[str], keep: str | None = None) -> DataFrame:
    """``rows``, without repeats of one row, and for each: ``first_<place>``,
    the least place of the rows with its ``coarse`` and ``fine`` keys;
    ``several``, whether there are others; ``turn``, whether it begins a run of
    ``fine`` keys that is not the first within its ``coarse`` ones. Rows whose
    ``coarse`` keys no other row has are left out, unless the column ``keep``
    is true. Keys and places are not null."""
    order = [*coarse, *fine, *place]
    names = rows.columns
    firsts = [f"first_{p}" for p in place]
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    added = [*(T.StructField(f"first_{p}", kinds[p]) for p in place), *(T.StructField(n, T.BooleanType()) for n in ("several", "shared", "turn"))]
    spec = T.StructType([*rows.schema.fields, *added, T.StructField("task", T.IntegerType()), T.StructField("top", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: pa.Table | None = None   # the last row, with its first place
        facts = np.zeros(3, bool)      # of the held row: whether it continues a fine run, a coarse run, and is the top one

        def out(table: pa.Table, new_fine: np.ndarray, new_coarse: np.ndarray, top: np.ndarray, next_fine: np.ndarray, next_coarse: np.ndarray, force: bool) -> Iterator[pa.RecordBatch]:
            several, shared = ~new_fine | next_fine, ~new_coarse | next_coarse
            wanted = shared | top
            if keep:
                wanted |= table.column(keep).to_numpy(zero_copy_only=False).astype(bool)
            if force:
                wanted[-1] = True   # the bottom row may belong to the next task's run
            flags = [pa.array(x) for x in (several, shared, new_fine & ~new_coarse)]
            full = pa.Table.from_arrays([*(table.column(n) for n in [*names, *firsts]), *flags, pa.array(np.full(table.num_rows, task, np.int32)), pa.array(top)], names=spec.names)
            yield from full.filter(pa.array(wanted)).to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not batch.num_rows:
                continue
            plain = pa.concat_tables([held.select(names), table]) if held is not None else table
            distinct = _differs(plain, order)
            begins = held is None
            plain = plain.filter(pa.array(distinct))
            new_coarse, new_fine = _differs(plain, coarse), _differs(plain, [*coarse, *fine])
            top = np.zeros(plain.num_rows, bool)
            if begins:
                top[0] = True
            else:
                new_fine[0], new_coarse[0], top[0] = facts
            starts = new_fine.copy()
            starts[0] = True
            at = pa.array(np.maximum.accumulate(np.where(starts, np.arange(plain.num_rows), 0)))
            for p, f in zip(place, firsts):
                value = plain.column(p)
                if not begins:   # the first row's run may have begun before it
                    value = pa.chunked_array([held.column(f).combine_chunks(), *value.slice(1).chunks], type=value.type)
                plain = plain.append_column(f, value.take(at))
            last = plain.num_rows - 1
            yield from out(plain.slice(0, last), new_fine[:last], new_coarse[:last], top[:last], ~new_fine[1:], ~new_coarse[1:], False)
            held, facts = plain.slice(last), np.array([new_fine[last], new_coarse[last], top[last]])
        if held is not None:
            no = np.zeros(1, bool)
            yield from out(held, facts[:1], facts[1:2], facts[2:], no, no, True)

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = staged(ranged.mapInArrow(run, spec), "runs")
    ends = found.groupBy("task").agg(F.min(F.struct(*order)).alias("top"), F.max(F.struct(*order, *firsts)).alias("bottom")).orderBy("task").collect()
    # what the task before and the task after a task know of its first and last run
    before: dict[int, tuple] = {}
    after: dict[int, tuple] = {}
    key = lambda r: tuple(r[n] for n in [*coarse, *fine])
    first = None
    for i, r in enumerate(ends):
        if i:
            before[r["task"]] = (key(ends[i - 1]["bottom"]), first)
            after[ends[i - 1]["task"]] = key(r["top"])
        whole = key(r["top"]) == key(r["bottom"])   # one run only
        if not (i and whole and key(ends[i - 1]["bottom"]) == key(r["bottom"])):
            first = tuple(r["bottom"][f] for f in firsts)
    if not before:
        return _result(found, found, keep)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            task = columns["task"].to_numpy()
            flag = {n: columns[n].to_numpy(zero_copy_only=False).copy() for n in ("several", "shared", "turn")}
            top = columns["top"].to_numpy(zero_copy_only=False)
            values = [columns[n].to_numpy(zero_copy_only=False) for n in [*coarse, *fine]]

            def equal(mine: np.ndarray, keys: tuple) -> np.ndarray:
                for v, k in zip(values, keys):
                    mine = mine & (v == k)
                return mine

            for t in np.unique(task).tolist():
                here = task == t
                if t in before:
                    keys, start = before[t]
                    same, near = equal(here, keys), equal(here, keys[:len(coarse)])
                    flag["several"] |= same
                    flag["shared"] |= near
                    flag["turn"] = (flag["turn"] & ~same) | (near & top & ~same)
                    if same.any():
                        for f, value in zip(firsts, start):
                            columns[f] = pc.if_else(pa.array(same), pa.scalar(value, columns[f].type), columns[f])
                if t in after:
                    flag["several"] |= equal(here, after[t])
                    flag["shared"] |= equal(here, after[t][:len(coarse)])
            columns |= {n: pa.array(x) for n, x in flag.items()}
            yield pa.RecordBatch.from_arrays([columns[n] for n in spec.names], names=spec.names)

    return _result(found, found.mapInArrow(carry, spec), keep)


def _result(found: DataFrame, rows: DataFrame, keep: str | None) -> DataFrame:
    wanted = F.col("shared") | F.col(keep) if keep else F.col("shared")
    out = staged(rows.where(wanted).drop("task", "top", "shared"), "shared")
    discard(found)
    return out
