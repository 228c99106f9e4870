"""Run window and incremental predicates.

A run for ``run_date`` reads rows changed since ``run_date - 1 day`` (the
one-day overlap makes a re-run or a late row harmless: the upsert is
idempotent). The control table stores the predicate as a template with a
``:start_date`` placeholder; the placeholder is replaced by a date literal in
the dialect of whatever evaluates the predicate (the source database for a
JDBC land, Spark SQL for the raw -> staging step).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACEHOLDER = ":start_date"


def parse_run_date(run_date: str | _dt.date | _dt.datetime) -> _dt.date:
    if isinstance(run_date, _dt.datetime):
        return run_date.date()
    if isinstance(run_date, _dt.date):
        return run_date
    return _dt.datetime.strptime(run_date, "%Y-%m-%d").date()


def start_date(run_date: str | _dt.date | _dt.datetime) -> _dt.date:
    """First day of the change window: the day before ``run_date``."""
    return parse_run_date(run_date) - _dt.timedelta(days=1)


def start_date_col(run_date: str) -> Column:
    """Same as :func:`start_date`, as a Spark expression."""
    return F.date_sub(F.to_date(F.lit(str(parse_run_date(run_date))), "yyyy-MM-dd"), 1)


# Literal renderers: date -> SQL text in one dialect.

def spark_date_literal(d: _dt.date) -> str:
    """Spark SQL: ``TO_DATE('yyyy-MM-dd', 'yyyy-MM-dd')``."""
    return f"TO_DATE('{d:%Y-%m-%d}', 'yyyy-MM-dd')"


def sqlserver_date_literal(d: _dt.date) -> str:
    """SQL Server: ``CONVERT(DATETIME, 'yyyy-MM-dd', 120)``."""
    return f"CONVERT(DATETIME, '{d:%Y-%m-%d}', 120)"


def derby_date_literal(d: _dt.date) -> str:
    """Derby: ``TIMESTAMP('yyyy-MM-dd 00:00:00')``."""
    return f"TIMESTAMP('{d:%Y-%m-%d} 00:00:00')"


def ansi_date_literal(d: _dt.date) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d} 00:00:00'"


_SIMPLE_WINDOW = re.compile(
    r'^\s*(?:"([^"]+)"|\[([^\]]+)\]|`([^`]+)`|([A-Za-z_][A-Za-z0-9_]*))\s*(?:>=|>)\s*'
    + re.escape(PLACEHOLDER) + r'\s*$')


def filter_column(template: str | None) -> str | None:
    """The column of a simple change window ``<col> >= :start_date`` (the
    column may be quoted), else ``None``."""
    if template is None:
        return None
    m = _SIMPLE_WINDOW.match(template)
    if not m:
        return None
    return next(g for g in m.groups() if g)


def render_filter(template: str | None, run_date, literal=spark_date_literal) -> str | None:
    """Fill the ``:start_date`` placeholder; ``None`` stays ``None`` (no filter)."""
    if template is None:
        return None
    return template.replace(PLACEHOLDER, literal(start_date(run_date)))
