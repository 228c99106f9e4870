"""Load dispatcher: write the batch once, then create or upsert the target.

* batch has no rows -> nothing is kept; an absent target stays absent
  (the next run is a full load again);
* target absent -> the batch becomes the first snapshot (key uniqueness is
  checked first unless ``check_unique=False``);
* target present, unpartitioned -> the batch becomes the first files of the
  next snapshot, the target rows it does not replace are appended, and the
  table is repointed;
* target present, partitioned -> only the partitions the batch touches are
  merged, rewritten and repointed; so with a target laid out in ranges of its
  key (``range_rows``), whose partitions are those ranges.

Columns that only the batch has are left out and logged; columns that it lacks
raise. A load that fails, is rejected or finds no rows leaves no folder behind.

``movements`` is the number of rows in the batch (rows selected by the
extract, not rows that changed), counted in the same pass that wrote it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import (align_to_target, extra_columns, fits_broadcast, kept_rows,
                               normalize_keys, variable_key_bytes)
from ..operators.validate import any_null, assert_unique, col
from ..session import scratch_path
from ..sources import key_ranges
from ..sources.tables import (RANGE_COLUMN, create_partitioned_table, delete_path,
                              expire_snapshots, few_listing_tasks, max_records, new_snapshot, partition_columns,
                              partition_filter, partition_values, rebalanced, register_snapshot,
                              swap_partitions, table_exists, write_batch, write_batch_observed,
                              written_partitions)

_log = logging.getLogger("landfall")

CONF_RANGE_ROWS = "landfall.load.rangeRows"


@dataclass(frozen=True)
class LoadResult:
    """What one load did: ``mode`` and the batch's row count."""
    table: str
    mode: str  # "created" | "merged" | "skipped"
    movements: int
    ignored: tuple[str, ...] = ()  # columns of the batch that the target lacks


def _clustered(df: DataFrame, cluster_by: Sequence[str] | None) -> DataFrame:
    """Sort each task's rows by ``cluster_by`` (no shuffle). Row groups then
    cover narrow ranges of that column, so a later change-window predicate on
    it skips most of each file (with non-INT96 timestamps)."""
    if not cluster_by:
        return df
    present = {c.lower() for c in df.columns}
    cols = [c for c in cluster_by if c and c.lower() in present]
    return df.sortWithinPartitions(*cols) if cols else df


def load_into(spark: SparkSession, batch: DataFrame | None, target: str,
              keys: Sequence[str] | Mapping[str, str], *, root: str | None = None,
              check_unique: bool = True, cluster_by: Sequence[str] | None = None,
              partition_by: Sequence[str] | None = None,
              stable_partitions: bool = False,
              retain_snapshots: int | None = None,
              range_rows: int | None = None) -> LoadResult:
    """``cluster_by``: columns to sort each written file by (typically the
    column of the change predicate).

    ``partition_by``: lay the target out in partitions of these columns (on
    the first load; later loads follow the table's own partitioning). A batch
    then rewrites only the partitions it touches. ``stable_partitions``
    declares that a key's partition value never changes, which skips the
    probe for rows that moved partition.

    ``range_rows``: lay the target out in ranges of its first key column, of
    about so many rows each (on the first load; later loads follow the table's
    property). A batch rewrites only the ranges that its keys fall in, and a
    range that outgrows twice that number is split. The first load writes its
    batch twice: the ranges come from the rows. Readers use ``read_table``,
    which leaves the layout's column out. By default the session's
    ``landfall.load.rangeRows``; if that is unset, there is no such layout.

    ``retain_snapshots``: after a merge, delete snapshot folders beyond this
    many (folders the table still uses are kept); ``None`` keeps them all."""
    if batch is None:
        raise ValueError(f"no batch for {target}: its source was not read")
    batch, key_list = normalize_keys(batch, keys)
    exists = table_exists(spark, target)
    cols = partition_columns(spark, target) if exists else list(partition_by or [])
    ignored: list[str] = []
    ranges = key_ranges.ranges_of(spark, target) if exists else None
    if ranges and ranges.leaving:   # a writer died while it split a range
        key_ranges.finish_split(spark, target, root)
    if exists:
        current = spark.table(target)
        current = current.drop(RANGE_COLUMN) if ranges else current
        ignored = extra_columns(current, batch)
        if ignored:
            _log.warning("%s has no columns %s: they are not loaded", target, ignored)
        batch = align_to_target(current, batch)
    range_rows = int(spark.conf.get(CONF_RANGE_ROWS, "0")) if range_rows is None else range_rows
    new_layout = not exists and range_rows > 0 and not partition_by
    if new_layout:
        if RANGE_COLUMN in {c.lower() for c in batch.columns}:
            raise ValueError(f"a target in key ranges can't have its own column {RANGE_COLUMN}")
        cols = [RANGE_COLUMN]
    with (few_listing_tasks(spark), _dealt(spark, batch, key_list[0], range_rows, ranges, new_layout) as (batch, ranges),
          new_snapshot(spark, target, root) as path):   # deleted unless the table is pointed at it
        arranged = rebalanced(batch, cols) if cols else batch
        # byte sizes of string keys, and empty partition values, are observed in the pass that writes
        metrics = variable_key_bytes(batch.select(*[col(k) for k in key_list])) | _empty_values(batch, cols)
        staged, n, measured = write_batch_observed(_clustered(arranged, cluster_by), path, cols, metrics)
        if n == 0:
            return LoadResult(target, "skipped", 0)
        empty = [k.removeprefix("empty_") for k, v in measured.items() if k.startswith("empty_") and v]
        if empty:
            raise ValueError(f"{target}: partition columns {empty} hold empty strings, which a folder name can't tell from NULL")
        if check_unique:
            assert_unique(staged, key_list, what=f"batch for {target}")
        if not exists:
            if cols:
                create_partitioned_table(spark, target, path, batch.schema, cols, root, key_ranges.properties(ranges) if ranges else None)
            else:
                register_snapshot(spark, target, path, root)
            return LoadResult(target, "created", n)
        if cols:
            touched = _merge_partitions(spark, target, staged, n, measured, key_list, cols, path, cluster_by, stable_partitions or bool(ranges))
        else:
            kept = kept_rows(current, staged, key_list, source_rows=n, measured=measured)
            kept.write.option("maxRecordsPerFile", max_records(spark)).mode("append").parquet(path)
            register_snapshot(spark, target, path, root)
    if ranges:
        with few_listing_tasks(spark):
            key_ranges.split_large(spark, target, [int(v) for (v,) in touched], root)
    if retain_snapshots is not None:
        expire_snapshots(spark, target, retain_snapshots)
    return LoadResult(target, "merged", n, tuple(ignored))


@contextmanager
def _dealt(spark: SparkSession, batch: DataFrame, key: str, range_rows: int | None,
           ranges: key_ranges.KeyRanges | None, first: bool) -> Iterator[tuple]:
    """The batch with its rows' key ranges, and these. Those of a new table come
    from the batch, which is written once for it, and that copy deleted again."""
    if not first:
        yield (ranges.assign(batch) if ranges else batch), ranges
        return
    copy = scratch_path(spark, "batches")
    try:
        batch, n = write_batch(batch, copy)
        ranges = key_ranges.first_ranges(batch, key, n, range_rows)
        yield ranges.assign(batch), ranges
    finally:
        delete_path(spark, copy)


def _empty_values(batch: DataFrame, cols: Sequence[str]) -> dict:
    text = {f.name.lower() for f in batch.schema.fields if f.dataType.simpleString() == "string"}
    return {f"empty_{c}": F.count_if(col(c) == "") for c in cols if c.lower() in text}


def _merge_partitions(spark: SparkSession, target: str, staged: DataFrame, n: int, measured: dict, key_list: Sequence[str],
                      cols: Sequence[str], path: str, cluster_by, stable: bool) -> set[tuple]:
    """Upsert confined to the partitions the batch touches, writing each row
    once. The batch already stands in the next snapshot folder. The touched
    partitions are the batch's own plus, unless ``stable``, those that
    currently hold its keys (a narrow key-column probe against the batch keys).
    Only those partitions are read; the rows the batch does not replace are
    appended next to it, and each touched partition is repointed. Returns the
    touched partitions."""
    current = spark.table(target)
    touched = partition_values(staged, cols)
    if not stable:
        probe = staged.select(*[col(k) for k in key_list]).where(~any_null(key_list))
        probe = F.broadcast(probe) if fits_broadcast(probe, n, measured) else probe
        holders = (current.select(*[col(c) for c in list(key_list) + list(cols)])
                          .join(probe, key_list, "left_semi"))
        touched |= partition_values(holders, cols)
    part = current.where(partition_filter(current, cols, touched))
    kept = kept_rows(part, staged, key_list, source_rows=n, measured=measured)
    (_clustered(rebalanced(kept, cols), cluster_by).write
     .option("maxRecordsPerFile", max_records(spark)).mode("append")
     .partitionBy(*cols).parquet(path))
    written = written_partitions(spark, path, cols)
    swap_partitions(spark, target, cols, touched, written, path)
    return touched
