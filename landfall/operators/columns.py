"""Column-level operators: projection, predicate, drop, renames, transform chain.

All of these are metadata-only (they change the logical plan, never the data
layout), so Catalyst prunes columns and pushes predicates into the scan below
them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ..functions.naming import pascal_to_snake

Transform = Callable[[DataFrame], DataFrame]


def select_listed(df: DataFrame, selected: Sequence[str] | None) -> DataFrame:
    """Keep the listed columns in the listed order; ``None`` keeps all."""
    if selected is None:
        return df
    return df.select(*selected)


def where_filter(df: DataFrame, predicate: str | Column | None) -> DataFrame:
    """Filter by SQL text or a ``Column``; ``None`` keeps every row."""
    if predicate is None:
        return df
    return df.where(predicate)


def scan(df: DataFrame, selected: Sequence[str] | None = None,
         predicate: str | Column | None = None) -> DataFrame:
    """Filter, then project: the predicate may name a column that is not
    selected, so it is applied first."""
    return select_listed(where_filter(df, predicate), selected)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Drop one column; the others keep their order."""
    return df.drop(name)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def _check_unique_names(names: Sequence[str], what: str) -> None:
    seen: dict[str, str] = {}
    for n in names:
        low = n.lower()
        if low in seen:
            raise ValueError(f"{what} gives two columns the name {n!r} (from {seen[low]!r})")
        seen[low] = n


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Every column name to snake_case. Two columns that would end up with the
    same name raise ``ValueError`` instead of silently colliding."""
    new = [pascal_to_snake(c) for c in df.columns]
    _check_unique_names(new, "snake_case")
    if new == df.columns:
        return df
    return df.toDF(*new)


def rename_positional(df: DataFrame, previous: Sequence[str] | None,
                      new: Sequence[str] | None) -> DataFrame:
    """Rename ``previous[i]`` to ``new[i]``. ``new`` of ``None`` leaves the
    frame unchanged; lists of different length raise ``ValueError``."""
    if new is None:
        return df
    previous = list(previous or [])
    new = list(new)
    if len(previous) != len(new):
        raise ValueError("previous and new column lists must have the same length")
    return df.withColumnsRenamed(dict(zip(previous, new)))


def apply(df: DataFrame | None, fn: Transform | None) -> DataFrame:
    """Apply a ``DataFrame -> DataFrame`` function (``None`` = identity)."""
    if df is None:
        raise ValueError("there is no frame to transform")
    if fn is None:
        return df
    return df.transform(fn)


def chain(*fns: Transform | None) -> Transform:
    """Compose transforms left to right, skipping ``None``."""
    def run(df: DataFrame) -> DataFrame:
        for fn in fns:
            df = apply(df, fn)
        return df
    return run
