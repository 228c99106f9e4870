"""Key constraints, checked with queries (Parquet tables do not enforce them).

All checks are distributed: uniqueness is a ``groupBy(keys).count()`` (partial
aggregation on the map side, so a key holding a large share of the rows is
collapsed before the shuffle), or, for a read that is split by disjoint ranges
of the key, a comparison of neighbours in each task; NULL counts are one global aggregate.  The
``assert_*`` helpers run a single bounded action (``isEmpty``/one row).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lists import split_list_col


class KeyViolation(ValueError):
    """A declared key constraint does not hold."""


def col(name: str) -> Column:
    """A column by its literal name (dots and other characters are not parsed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_unique_rows(rows, key: Sequence[str], what: str) -> None:
    """Key uniqueness over rows already on the driver (metadata lists)."""
    seen, dups = set(), set()
    for r in rows:
        k = tuple(r[c] for c in key)
        (dups if k in seen else seen).add(k)
    if dups:
        raise KeyViolation(f"{what} repeats key {list(key)}: {sorted(dups, key=repr)[:3]}")


def any_null(keys: Sequence[str]) -> Column:
    cond = col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | col(k).isNull()
    return cond


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their count ``n``.
    NULL keys never match each other in the upsert, so they are not
    duplicates here (they are reported by :func:`null_violations`)."""
    keys = list(keys)
    return (df.where(~any_null(keys))
              .groupBy(*[col(k) for k in keys])
              .agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def _run_lengths(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal rows begin in a sorted table, and their lengths."""
    n = table.num_rows
    differs = np.zeros(max(0, n - 1), bool)
    for c in table.columns:
        c = c.combine_chunks()
        a, b = c.slice(1), c.slice(0, n - 1)
        one = pc.not_equal(a, b)
        if pa.types.is_floating(c.type):   # NaN keys are equal, as in GROUP BY
            one = pc.and_(one, pc.invert(pc.and_(pc.is_nan(a), pc.is_nan(b))))
        differs |= one.to_numpy(zero_copy_only=False).astype(bool)
    begins = np.concatenate([[0], np.flatnonzero(differs) + 1])
    return begins, np.diff(np.append(begins, n))


def duplicate_keys_ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`duplicate_keys` of a frame whose tasks hold disjoint ranges of
    the key (a JDBC read split by the first key column, say): each task sorts
    its keys and compares neighbours, so nothing is shuffled. On any other
    frame it misses duplicates that lie in different tasks."""
    keys = list(keys)
    ordered = df.where(~any_null(keys)).select(*[col(k) for k in keys]).sortWithinPartitions(*[col(k) for k in keys])
    plain = [f"k{i}" for i in range(len(keys))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0   # the last key, and how often it has come
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            begins, sizes = _run_lengths(table)
            sizes[0] += n - 1 if held is not None else 0
            done = np.flatnonzero(sizes[:-1] > 1)
            held, n = table.slice(int(begins[-1]), 1), int(sizes[-1])
            yield from table.take(pa.array(begins[done])).append_column("n", pa.array(sizes[done])).to_batches()
        if n > 1:
            yield from held.append_column("n", pa.array([n], pa.int64())).to_batches()

    spec = T.StructType([*(T.StructField(p, f.dataType) for p, f in zip(plain, ordered.schema.fields)), T.StructField("n", T.LongType())])
    return ordered.toDF(*plain).mapInArrow(run, spec).toDF(*keys, "n")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise :class:`KeyViolation` if a non-NULL key repeats (a few examples
    are quoted)."""
    dups = duplicate_keys(df, keys)
    if not dups.isEmpty():
        sample = dups.limit(3).collect()
        raise KeyViolation(f"{what} repeats key {list(keys)}: e.g. {[tuple(r) for r in sample]}")


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: the number of NULLs in each required column, ``null_<col>``."""
    return df.agg(*[F.count_if(col(c).isNull()).alias(f"null_{c}") for c in required])


def assert_not_null(df: DataFrame, required: Sequence[str], what: str = "table") -> None:
    """Raise :class:`KeyViolation` if a required column holds NULLs."""
    if not required:
        return
    bad = df.where(any_null(list(required)))
    if not bad.isEmpty():
        counts = null_violations(df, required).first().asDict()
        raise KeyViolation(f"{what} has NULLs in required columns: "
                           f"{ {k: v for k, v in counts.items() if v} }")


def key_length_mismatches(control: DataFrame, primary_key: str = "primary_key",
                          stg_primary_key: str = "stg_primary_key") -> DataFrame:
    """Control rows whose staging key list does not have as many names as the
    source key list (the positional key rename would fail on them)."""
    return control.where(
        F.col(stg_primary_key).isNotNull()
        & (F.size(split_list_col(primary_key)) != F.size(split_list_col(stg_primary_key))))
