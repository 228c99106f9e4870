"""Column values that travel: to the driver and back as literals, or into a
table property as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def carried(c: Column, kind: str) -> Column:
    """A value in a form that comes back from the driver unchanged."""
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        return c.cast("string")
    return F.unix_date(c) if kind == "date" else c


def restored(value, kind: str) -> Column:
    """A literal of type ``kind`` from what :func:`carried` gave, or its text."""
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(value).cast("bigint"))
    if kind == "date":
        return F.date_from_unix_date(F.lit(value).cast("int"))
    return F.lit(value).cast(kind)


def restored_array(texts: list[str], kind: str) -> Column:
    """A constant array of type ``kind`` from texts of what :func:`carried`
    gave: one expression, however long."""
    made = {"timestamp": "timestamp_micros(CAST({} AS BIGINT))", "date": "date_from_unix_date(CAST({} AS INT))"}.get(kind, f"CAST({{}} AS {kind})")
    quoted = ["'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts]
    return F.expr(f"CAST(array({', '.join(made.format(q) for q in quoted)}) AS array<{kind}>)")
