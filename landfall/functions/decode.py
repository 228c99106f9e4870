"""Typed decode of text rows.

Result sets that travel as text (one string per cell, plus a declared type per
column) are turned back into typed columns: ``INT`` becomes an integer (bad
text raises), ``BOOLEAN`` is true exactly when the text is
``"true"``, NULL stays NULL, and every other declared type stays text.
The decode is one ``select`` of casts, so it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode_value(col: Column, type_text: str | None) -> Column:
    t = (type_text or "").strip().upper()
    if t == "INT":
        # raises on text that is not an integer, whatever the session's ANSI mode
        as_int = col.try_cast("int")
        return F.when(col.isNotNull() & as_int.isNull(),
                      F.raise_error(F.concat(F.lit("not an INT: "), col))
                      ).otherwise(as_int).cast("int")
    if t == "BOOLEAN":
        return F.when(col.isNull(), F.lit(None).cast("boolean")).otherwise(col == F.lit("true"))
    return col


def decode_typed(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Decode each column of ``df`` (all strings) by its declared type."""
    return df.select(*[decode_value(F.col(c), declared.get(c)).alias(c) for c in df.columns])


def as_text(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The text form of ``df`` and its declared types (Spark type names)."""
    declared = {f.name: f.dataType.simpleString().upper() for f in df.schema.fields}
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), declared
