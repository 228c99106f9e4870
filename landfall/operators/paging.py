"""Ordered paging of a table: ``ORDER BY … LIMIT page_length OFFSET page * page_length``.

Pages are zero-based; ``page_length = 0`` means every row (one page). The
order is total: after the columns asked for come all others, so rows that tie
stand in the same place on every call, and the pages of a table together are
the table, each row once. Null is the least value, as in Spark's ORDER BY.

The engine sorts; what is chosen here is how much of the table it has to:

* a page that ends within the first ``EARLY`` rows is one ORDER BY / LIMIT /
  OFFSET, which Spark runs as a top-k: a task keeps that many rows;
* for a page further down, a histogram of the *first* sort column (its
  approximate quantiles, one narrow scan) tells the stretch of values that
  holds the page, and a second narrow scan how many rows stand before it. The
  stretch is a range filter that reaches the scan, and the engine sorts what
  passes: by a top-k again, or, where the page is large or ties are many, by
  its range-partitioned sort, written once to the shared folder with the place
  of each row; the page is then a range of places.

No page goes through the driver or through one task but those of a top-k, and
of a deep page's table only the stretch is sorted. What reaches the driver of
a histogram is its ``STRETCHES`` bounds. Page information is a one-row
aggregate over the table (``count``), so it is lazy and distributed as well.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import carried, restored
from .validate import col as col_

#: Rows that a task may keep to find the first ones of a table.
EARLY = 10_000
#: Stretches that the first sort column is split into.
STRETCHES = 512

OrderSpec = Sequence[str | Column | tuple[Column, bool]] | None

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
_PLACE_BITS = 33   # of monotonically_increasing_id: a row's place in its task


def _check(page: int, page_length: int) -> None:
    for name, value in (("page", page), ("page_length", page_length)):
        if value < 0:
            raise ValueError(f"{name} is negative: {value}")


def _items(df: DataFrame, order: OrderSpec) -> list[tuple[Column, bool, str | None]]:
    """(expression, descending, name of the plain column) of each sort item."""
    out = []
    for item in order or [f"`{df.columns[0]}`"]:
        if isinstance(item, Column):
            out.append((item, False, None))
        elif isinstance(item, tuple):
            out.append((item[0], bool(item[1]), None))
        else:
            name, _, direction = item.strip().rpartition(" ") if item.strip().upper().endswith((" ASC", " DESC")) else (item.strip(), "", "ASC")
            name = name.strip().strip("`")
            if " " in name and name not in df.columns:
                raise ValueError(f"not a sort item: {item!r}")
            out.append((col_(name), direction.upper() == "DESC", name))
    return out


def _kind(df: DataFrame, c: Column) -> str:
    return df.select(c.alias("x")).schema["x"].dataType.simpleString()


def _sortable(df: DataFrame, c: Column) -> Column:
    """Maps and variants have no order of their own: that of their JSON."""
    kind = _kind(df, c)
    return F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else c


def total_order(df: DataFrame, order: OrderSpec) -> list[tuple[Column, bool]]:
    """(expression, descending): the items asked for, then every other column."""
    items = _items(df, order)
    used = {name.lower() for _, _, name in items if name}
    items += [(col_(c), False, c) for c in df.columns if c.lower() not in used]
    return [(_sortable(df, c), descending) for c, descending, _ in items]


def _measure(c: Column, kind: str, prefix: str = "") -> Column | None:
    """A number that never falls as ``c`` rises, null where ``c`` is; None if
    there is none for the type. Strings behind a ``prefix`` that all share are
    measured by their next six bytes."""
    if kind in _NUMBERS or kind.startswith("decimal"):
        number = c.cast("int").cast("double") if kind == "boolean" else c.cast("double")
        return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind == "timestamp":
        return F.unix_micros(c).cast("double")
    if kind == "timestamp_ntz":
        return F.unix_date(c.cast("date")).cast("double") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if kind == "string":
        rest = F.substring(c.cast("binary"), len(prefix.encode()) + 1, 6)
        return F.conv(F.rpad(F.hex(rest), 12, "0"), 16, 10).cast("double")
    return None


def _common_prefix(df: DataFrame, c: Column) -> str:
    ends = df.agg(F.min(c).alias("a"), F.max(c).alias("b")).first()
    a, b = ends["a"] or "", ends["b"] or ""
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def _stretch(df: DataFrame, c: Column, descending: bool, first: int, last: int) -> tuple[DataFrame, int] | None:
    """The rows whose values of ``c`` can stand at places ``first`` to ``last``
    (exclusive) of the order, and how many rows stand before them; None past
    the end of the table."""
    kind = _kind(df, c)
    measure = _measure(c, kind, _common_prefix(df, c) if kind == "string" else "")
    if measure is None:
        return df, 0
    shares = F.array(*[F.lit(i / STRETCHES) for i in range(STRETCHES + 1)])
    found = df.select(c.alias("c"), measure.alias("m")).agg(F.percentile_approx("m", shares, 20 * STRETCHES).alias("cuts"), F.count("c").alias("held"), F.count(F.lit(1)).alias("n")).first()
    n, held, cuts = found["n"], found["held"], found["cuts"]
    if first >= n:
        return None
    last = min(last, n)
    nulls = n - held
    low, high = (n - last, n - first) if descending else (first, last)   # places counted from the least value, nulls first
    with_nulls = low < nulls
    if held == 0 or high <= nulls:
        return df.where(c.isNull()), (held if descending else 0)
    # a stretch more on either side: the quantiles are approximate
    a = max(0, int((low - nulls) / held * STRETCHES) - 1) if low > nulls else 0
    b = min(STRETCHES, int((high - nulls) / held * STRETCHES) + 2)
    while True:
        inside = measure.between(cuts[a], cuts[b])
        got = df.agg(F.count_if(measure < cuts[a]).alias("below"), F.count_if(inside).alias("inside"), F.count_if(measure > cuts[b]).alias("above"),
                     F.min(F.when(inside, carried(c, kind))).alias("least"), F.max(F.when(inside, carried(c, kind))).alias("most")).first()
        if nulls + got["below"] <= max(low, nulls) and nulls + got["below"] + got["inside"] >= high:
            break
        if (a, b) == (0, STRETCHES):
            return df, 0
        a, b = max(0, a - 8), min(STRETCHES, b + 8)
    chosen = (c >= restored(got["least"], kind)) & (c <= restored(got["most"], kind))
    if kind in ("float", "double") and got["most"] != got["most"]:   # NaN, the greatest: a file's statistics don't know it
        chosen = (c >= restored(got["least"], kind)) | F.isnan(c)
    if with_nulls:
        chosen = chosen | c.isNull()
    before = got["above"] if descending else got["below"] + (0 if with_nulls else nulls)
    return df.where(chosen), before


def _placed(rows: DataFrame, whole: list[Column], first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` of the sorted rows: the engine's sort, written
    once with each row's task and place in it."""
    from ..sources.tables import stage_batch   # which imports this package

    place = f"_place_{uuid.uuid4().hex[:8]}"
    written, _ = stage_batch(rows.orderBy(*whole).withColumn(place, F.monotonically_increasing_id()))
    tasks = written.groupBy(F.shiftright(place, _PLACE_BITS).alias("task")).count().orderBy("task").collect()
    ends = list(accumulate((r["count"] for r in tasks), initial=0))

    def at(position: int) -> int:
        k = min(bisect_right(ends, position), len(tasks)) - 1
        return (tasks[k]["task"] << _PLACE_BITS) + position - ends[k]

    if first >= ends[-1]:
        return rows.limit(0)
    return written.where((F.col(place) >= at(first)) & (F.col(place) < at(min(last, ends[-1])))).orderBy(place).drop(place)


def page(df: DataFrame, order: OrderSpec, page: int, page_length: int,
         select: Sequence[str] | None = None) -> DataFrame:
    """Rows of page ``page`` (zero-based) in the given order, projected to
    ``select`` (the order may use columns that are not selected, as in SQL).
    Sort items are ``"name"``, ``"name DESC"``, a Column (ascending) or a
    ``(Column, descending)`` pair. Early pages run no job; to find a deep one
    takes two or three, and two more where it has to be sorted in full."""
    _check(page, page_length)
    if not order and select:
        order = [f"`{select[0]}`"]
    names = [col_(c) for c in (select if select is not None else df.columns)]
    items = total_order(df, order)
    whole = [c.desc() if descending else c.asc() for c, descending in items]
    if page_length == 0:
        return df.orderBy(*whole).select(*names)
    first, last = page * page_length, (page + 1) * page_length
    rows, before = df, 0
    if last > EARLY:
        found = _stretch(df, *items[0], first, last)
        if found is None:
            return df.limit(0).select(*names)
        rows, before = found
    if last - before <= EARLY:
        return rows.orderBy(*whole).offset(first - before).limit(page_length).select(*names)
    return _placed(rows, whole, first - before, last - before).select(*names)


def page_info(df: DataFrame, page: int, page_length: int) -> DataFrame:
    """One row: ``page, page_length, total_pages, total_results``.
    ``total_pages`` rounds up; a page length of 0 means one page."""
    _check(page, page_length)
    total = F.count(F.lit(1))
    if page_length == 0:
        pages = F.lit(1).cast("bigint")
    else:
        pages = F.ceil(total / F.lit(float(page_length))).cast("bigint")
    return df.agg(F.lit(page).alias("page"), F.lit(page_length).alias("page_length"),
                  pages.alias("total_pages"), total.alias("total_results"))
