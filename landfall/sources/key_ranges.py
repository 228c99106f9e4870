"""Tables laid out in ranges of their key.

A target without a natural partition column can be laid out in ranges of its
first key column: each range is a partition, so that a batch rewrites only the
ranges that it touches, whatever the table's size. The column ``_key_range``
numbers a row's range; :func:`~landfall.sources.tables.read_table` leaves it
out. Where the ranges begin (approximate quantiles of the key) stands in the
table's properties, as text in pieces that a metastore takes.

A range that outgrows twice the rows asked for is split: first the property names
the new ranges, and the old one as *leaving*, then the old partition's rows are
written to the new ones and the catalog is repointed. A writer that dies
between the two leaves rows in a partition that no key leads to any more; the
next load sees it among the leaving ones and moves its rows first.

Rows with a null first key column have a range of their own (-1). The others
are compared as their column's type compares.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import carried, restored_array
from ..operators.validate import col
from . import tables

RANGE_COLUMN = tables.RANGE_COLUMN
NULL_RANGE = -1
#: Ranges of a table at most, and keys looked at for each when the type has no quantiles.
MOST_RANGES, SAMPLED = 20_000, 64
_PROPERTY, _PIECE = "landfall.keyRanges", 3500
_WITH_QUANTILES = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class KeyRanges:
    """``starts[i]`` is the least key of range ``ids[i + 1]``, as text; range
    ``ids[0]`` holds what is less. ``leaving``: ranges that were split and whose
    rows may not have moved yet."""
    column: str
    kind: str
    starts: tuple[str, ...]
    ids: tuple[int, ...]
    rows: int
    leaving: tuple[int, ...] = ()

    def to_text(self) -> str:
        return json.dumps({"column": self.column, "kind": self.kind, "starts": self.starts, "ids": self.ids, "rows": self.rows, "leaving": self.leaving}, separators=(",", ":"))

    @classmethod
    def from_text(cls, text: str) -> KeyRanges:
        d = json.loads(text)
        return cls(d["column"], d["kind"], tuple(d["starts"]), tuple(d["ids"]), d["rows"], tuple(d["leaving"]))

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with the range of each row, found by halving the starts."""
        key, at = col(self.column), "_at_range"
        starts = restored_array(list(self.starts), self.kind)
        size = 1
        while size <= len(self.starts):
            size *= 2
        out = df.withColumn(at, F.lit(0))
        while size > 1:
            size //= 2
            past = (F.col(at) + size <= len(self.starts)) & (F.get(starts, F.col(at) + (size - 1)) <= key)
            out = out.withColumn(at, F.col(at) + F.when(past, size).otherwise(0))
        number = F.get(F.expr(f"array({', '.join(map(str, self.ids))})"), F.col(at))
        return out.withColumn(RANGE_COLUMN, F.when(key.isNull(), NULL_RANGE).otherwise(number).cast("int")).drop(at)


def kind_of(df: DataFrame, column: str) -> str:
    return df.select(col(column)).schema[0].dataType.simpleString()


def quantiles(df: DataFrame, column: str, n_rows: int, parts: int) -> list[str]:
    """Keys that cut ``df`` (``n_rows`` rows) into about ``parts`` equal parts,
    ascending, as text."""
    parts = min(parts, MOST_RANGES)
    if parts < 2:
        return []
    kind = kind_of(df, column)
    keys = df.select(col(column).alias("k")).where(F.col("k").isNotNull())
    if kind in _WITH_QUANTILES:
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        cuts = keys.agg(F.percentile_approx("k", shares, max(10_000, 20 * parts)).alias("q")).select(F.transform("q", lambda x: carried(x, kind).cast("string")).alias("q")).first()["q"] or []
    else:
        # a sample by hash, of a bounded size, tells where to cut; every row is placed
        share = min(1.0, SAMPLED * parts / max(1, n_rows))
        some = keys.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < int(1_000_000 * share)).select(F.col("k"), carried(F.col("k"), kind).cast("string").alias("t"))
        found = [r["t"] for r in some.distinct().orderBy("k").select("t").collect()]
        cuts = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    return list(dict.fromkeys(cuts))


def first_ranges(df: DataFrame, column: str, n_rows: int, rows: int) -> KeyRanges:
    """Ranges of about ``rows`` rows each for the rows of a new table."""
    starts = quantiles(df, column, n_rows, -(-n_rows // rows))
    return KeyRanges(column, kind_of(df, column), tuple(starts), tuple(range(len(starts) + 1)), rows)


def properties(ranges: KeyRanges) -> dict[str, str]:
    text = ranges.to_text()
    pieces = [text[i:i + _PIECE] for i in range(0, len(text), _PIECE)]
    return {f"{_PROPERTY}.n": str(len(pieces))} | {f"{_PROPERTY}.{i}": p for i, p in enumerate(pieces)}


def ranges_of(spark: SparkSession, name: str) -> KeyRanges | None:
    """The ranges that table ``name`` is laid out in, None if it isn't."""
    if RANGE_COLUMN not in tables.partition_columns(spark, name):
        return None
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {tables._quote_name(name)}").collect()}
    n = int(held.get(f"{_PROPERTY}.n", "0"))
    return KeyRanges.from_text("".join(held[f"{_PROPERTY}.{i}"] for i in range(n))) if n else None


def store(spark: SparkSession, name: str, ranges: KeyRanges) -> None:
    """Set the property: one catalog call, so readers see all of it or none."""
    pairs = ", ".join(f"{tables._sql_literal(k)} = {tables._sql_literal(v)}" for k, v in properties(ranges).items())
    spark.sql(f"ALTER TABLE {tables._quote_name(name)} SET TBLPROPERTIES ({pairs})")


def range_rows(spark: SparkSession, name: str, ids: Sequence[int]) -> dict[int, int]:
    """Rows of some ranges of a table: a count over partition values, which
    reads no column."""
    rows = spark.table(name).where(F.col(RANGE_COLUMN).isin(*ids)).groupBy(RANGE_COLUMN).count().collect() if ids else []
    return {r[RANGE_COLUMN]: r["count"] for r in rows}


def split_large(spark: SparkSession, name: str, touched: Sequence[int], root: str | None = None) -> tuple[int, ...]:
    """Split those of the ``touched`` ranges that hold over twice the rows
    asked for; returns the ranges that went. Only they are read and written."""
    ranges = ranges_of(spark, name)
    large = [i for i, n in range_rows(spark, name, [i for i in touched if i in ranges.ids]).items() if n > 2 * ranges.rows]
    sizes = range_rows(spark, name, large)
    starts, ids, went = list(ranges.starts), list(ranges.ids), []
    for i in large:
        rows = spark.table(name).where(F.col(RANGE_COLUMN) == i).drop(RANGE_COLUMN)
        cuts = quantiles(rows, ranges.column, sizes[i], -(-sizes[i] // ranges.rows))
        at = ids.index(i)
        least = starts[at - 1] if at else None
        cuts = [c for c in cuts if c != least]   # a range of one key can't be split
        if cuts:
            new = max(*ids, *ranges.leaving, *went, NULL_RANGE) + 1
            ids[at:at + 1] = range(new, new + len(cuts) + 1)
            starts[at:at] = cuts
            went.append(i)
    if went:
        store(spark, name, KeyRanges(ranges.column, ranges.kind, tuple(starts), tuple(ids), ranges.rows, tuple(went)))
        finish_split(spark, name, root)
    return tuple(went)


def finish_split(spark: SparkSession, name: str, root: str | None = None) -> None:
    """Move the rows of ranges that are leaving to the ranges that their keys
    belong to now."""
    ranges = ranges_of(spark, name)
    if not ranges or not ranges.leaving:
        return
    current = spark.table(name)
    held = current.where(F.col(RANGE_COLUMN).isin(*ranges.leaving)).drop(RANGE_COLUMN)
    moved = ranges.assign(held)
    with tables.new_snapshot(spark, name, root) as path:
        (tables.rebalanced(moved, [RANGE_COLUMN]).write.option("maxRecordsPerFile", tables.max_records(spark))
         .partitionBy(RANGE_COLUMN).parquet(path))
        written = tables.written_partitions(spark, path, [RANGE_COLUMN])
        if written:   # the new ones stand before the old ones go: a row may be there twice for a moment, never not at all
            tables.swap_partitions(spark, name, [RANGE_COLUMN], set(written), written, path)
    tables.drop_partitions(spark, name, [RANGE_COLUMN], [(str(i),) for i in ranges.leaving])
    store(spark, name, KeyRanges(ranges.column, ranges.kind, ranges.starts, ranges.ids, ranges.rows))


def lay_out(spark: SparkSession, name: str, key: str, rows: int, root: str | None = None) -> KeyRanges:
    """Lay an existing unpartitioned table out in ranges of ``key``, of about
    ``rows`` rows each: its rows are written once more, as a table beside it
    that then takes its name. A writer that dies in between leaves one of the
    two, whole; run it again. The old snapshots are no longer the table's."""
    beside = f"{name}__ranges"
    if not tables.table_exists(spark, name) and tables.table_exists(spark, beside):
        _take_name(spark, beside, name)
        return ranges_of(spark, name)
    if tables.partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned already")
    spark.sql(f"DROP TABLE IF EXISTS {tables._quote_name(beside)}")
    df = spark.table(name)
    ranges = first_ranges(df, key, df.count(), rows)
    dealt = ranges.assign(df)
    with tables.new_snapshot(spark, name, root) as path:
        (tables.rebalanced(dealt, [RANGE_COLUMN]).write.option("maxRecordsPerFile", tables.max_records(spark))
         .partitionBy(RANGE_COLUMN).parquet(path))
        tables.create_partitioned_table(spark, beside, path, dealt.schema, [RANGE_COLUMN], root, properties(ranges))
    spark.sql(f"DROP TABLE {tables._quote_name(name)}")
    _take_name(spark, beside, name)
    return ranges


def _take_name(spark: SparkSession, beside: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {tables._quote_name(beside)} RENAME TO {tables._quote_name(name)}")
    spark.catalog.refreshTable(name)
