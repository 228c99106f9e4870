"""Catalog tables: scan, existence probe, staged batches and snapshot writes.

Built-in Parquet tables have no row-level ``MERGE``/``UPDATE``. A changed table
is therefore written as a **new snapshot folder** and the catalog entry is
pointed at it (``ALTER TABLE … SET LOCATION`` + ``refreshTable``). Writing a
new folder means the old files can be read while the new ones are written
(overwriting a table that is being read is refused), and readers that already
planned against the old snapshot keep their files. A writer that dies before
the catalog call leaves the table unchanged. One writer per table is assumed.

A partitioned table has one catalog call per touched partition, so while they
run, or if the writer dies between two of them, readers see some partitions of
the new state and some of the old: a key that moves partition may be missing
or there twice. Running the same batch again completes the switch.

A snapshot folder that the table was pointed at holds a marker file; folders
without one are leftovers of writers that died.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import scan
from ..session import scratch_path, warehouse_root


#: The range that a row's key falls in, in a table laid out in ranges (``key_ranges``).
RANGE_COLUMN = "_key_range"


@dataclass(frozen=True)
class Zones:
    """Zone prefixes: a session catalog has two name levels, so a zone becomes
    a database prefix, ``{zone}_{schema}.{table}``."""
    ctr: str = "ctr"
    raw: str = "raw"
    stg: str = "stg"


def database(zone: str, schema: str) -> str:
    return f"{zone}_{schema}".lower()


def qualified(zone: str, schema: str, table: str) -> str:
    return f"{database(zone, schema)}.{table}"


def _quote_name(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str, selected: Sequence[str] | None = None,
               predicate: str | Column | None = None) -> DataFrame:
    """``spark.table`` + predicate + column list (both pushed into the scan),
    without the column of a layout in key ranges."""
    return scan(spark.table(name).drop(RANGE_COLUMN), selected, predicate)


def footer_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A table as Spark's V2 file source reads it, in a session of its own:
    ``count``, and ``min`` and ``max`` of numbers, dates and booleans, over all
    of it are then answered from the Parquet footers, and no row is read. None
    for a partitioned table, whose partitions lie in several folders."""
    if partition_columns(spark, name):
        return None
    apart = spark.newSession()
    for key, value in (("spark.sql.sources.useV1SourceList", ""), ("spark.sql.parquet.aggregatePushdown", "true"),
                       ("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))):
        apart.conf.set(key, value)
    return apart.read.schema(spark.table(name).schema).parquet(_table_location(spark, name))


def table_bounds(spark: SparkSession, name: str, column: str) -> tuple:
    """Least and greatest value of a table's column, from the footers where
    they tell (strings and timestamps are read)."""
    df = footer_table(spark, name)
    df = spark.table(name) if df is None else df
    c = F.col("`" + column.replace("`", "``") + "`")
    return tuple(df.agg(F.min(c), F.max(c)).first())


def create_database(spark: SparkSession, db: str, root: str | None = None) -> None:
    root = root or warehouse_root(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{root}/{db}.db'")


def _snapshot_path(spark: SparkSession, name: str, root: str | None) -> str:
    root = root or warehouse_root(spark)
    db, _, tbl = name.rpartition(".")
    stamp = f"{int(time.time() * 1000):015d}"
    return f"{root}/{db or 'default'}.db/{tbl}/snapshot-{stamp}-{uuid.uuid4().hex[:8]}"


CONF_MAX_RECORDS = "landfall.write.maxRecordsPerFile"
DEFAULT_MAX_RECORDS = 10_000_000


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by partition before a partitioned write, so each partition is
    written by few tasks (not one file per task per partition). The
    ``rebalance`` hint lets AQE merge small groups and split a large one."""
    return df.hint("rebalance", *partition_by)


def max_records(spark: SparkSession) -> str:
    return spark.conf.get(CONF_MAX_RECORDS, str(DEFAULT_MAX_RECORDS))


def _writer(df: DataFrame):
    return df.write.option("maxRecordsPerFile", max_records(df.sparkSession))


def snapshot_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder for the next snapshot of table ``name``."""
    return _snapshot_path(spark, name, root)


@contextmanager
def new_snapshot(spark: SparkSession, name: str, root: str | None = None) -> Iterator[str]:
    """A fresh folder for the next snapshot of table ``name``, deleted again
    unless the table was pointed at it inside the block."""
    path = snapshot_path(spark, name, root)
    try:
        yield path
    finally:
        if not is_registered(spark, path):
            delete_path(spark, path)


_MARKER = "_registered"   # readers pass over names that begin with an underscore


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def mark_registered(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, f"{path}/{_MARKER}")
    fs.create(p, True).close()


def is_registered(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, f"{path}/{_MARKER}")
    return bool(fs.exists(p))


def register_snapshot(spark: SparkSession, name: str, path: str, root: str | None = None) -> None:
    """Point table ``name`` at the snapshot in ``path`` (create it if absent)."""
    mark_registered(spark, path)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {_quote_name(name)} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        db = name.rpartition(".")[0]
        if db:
            create_database(spark, db, root)
        spark.catalog.createTable(name, path=path, source="parquet")


def write_snapshot(spark: SparkSession, df: DataFrame, name: str, root: str | None = None) -> str:
    """Write ``df`` as the new content of table ``name`` (created if absent).
    Partitioned tables are changed partition by partition (``load_into``)."""
    if spark.catalog.tableExists(name) and partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned: its partitions are repointed one by one "
                         "(load_into), not the whole table")
    path = _snapshot_path(spark, name, root)
    _writer(df).mode("errorifexists").parquet(path)
    register_snapshot(spark, name, path, root)
    return path


def create_empty_table(spark: SparkSession, name: str, schema, root: str | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` with a fixed schema; True if created."""
    if spark.catalog.tableExists(name):
        return False
    write_snapshot(spark, spark.createDataFrame([], schema), name, root)
    return True


def write_batch(df: DataFrame, path: str,
                partition_by: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` to ``path`` once and return the written rows and their
    count. The count is an observed metric of the same pass (exact: the write
    is a result stage, so a retried task is not counted twice)."""
    written, rows, _ = write_batch_observed(df, path, partition_by)
    return written, rows


def write_batch_observed(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                         metrics: dict[str, Column] | None = None
                         ) -> tuple[DataFrame, int, dict]:
    """:func:`write_batch` that also returns extra aggregate ``metrics``
    observed in the same pass."""
    spark = df.sparkSession
    obs = Observation(f"landfall_batch_{uuid.uuid4().hex[:8]}")
    extra = [c.alias(name) for name, c in (metrics or {}).items()]
    writer = _writer(df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    observed = obs.get
    rows = observed.get("rows")
    # the schema is known: no footer inference (and an empty partitioned
    # write, which leaves no data files, still reads back)
    written = spark.read.schema(df.schema).parquet(path)
    if rows is None:
        rows = written.count()
    return written, int(rows), {k: observed.get(k) for k in (metrics or {})}


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library wrote (Hadoop FileSystem, any scheme).
    Returns False when the session gives no JVM access (nothing deleted)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:
        return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).delete(p, True))


def stage_batch(df: DataFrame) -> tuple[DataFrame, int]:
    """Materialise an extracted batch once, in the shared checkpoint folder.

    The source is read exactly once; the row count comes from the same pass
    and the upsert reads the staged files, so the count and the loaded rows
    agree even if the source changes. The copy is deleted when the driver's
    JVM ends."""
    path = scratch_path(df.sparkSession, "batches")
    fs, p = _hadoop(df.sparkSession, path)
    fs.deleteOnExit(p)
    return write_batch(df, path)


# ---------------------------------------------------------------- partitioned tables
#
# A table partitioned by columns whose value never changes for a key (an order
# date, a region) can be upserted partition by partition: only the partitions
# a batch touches are read and rewritten, each into a new folder, and the
# catalog's partition entries are repointed one by one (each switch is a
# metadata update; untouched partitions keep their files and are never read).

_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Partitions repointed at the same time, and tasks that list a table's folders.
SWAP_CALLS, LISTING_TASKS = 8, 64
_CONF_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_DEFAULT_LISTING = "10000"
_LISTING = {"lock": threading.Lock(), "inside": 0, "session": None}


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark lists folders in ``LISTING_TASKS`` tasks at most, where
    the session doesn't set another number; by default each of a table's
    thousands of partitions is a task of its own, several times in a load.
    Loads may run side by side: the last one out restores the session."""
    with _LISTING["lock"]:
        if not _LISTING["inside"]:
            _LISTING["session"] = spark if spark.conf.get(_CONF_LISTING) == _DEFAULT_LISTING else None
            if _LISTING["session"]:
                spark.conf.set(_CONF_LISTING, str(LISTING_TASKS))
        _LISTING["inside"] += 1
    try:
        yield
    finally:
        with _LISTING["lock"]:
            _LISTING["inside"] -= 1
            if not _LISTING["inside"] and _LISTING["session"]:
                _LISTING["session"].conf.unset(_CONF_LISTING)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _sql_literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(cols: Sequence[str], values: Sequence[str | None]) -> str:
    return "PARTITION (" + ", ".join(f"`{c}` = {_sql_literal(v)}"
                                     for c, v in zip(cols, values)) + ")"


def _values_from_path(rel: str, cols: Sequence[str]) -> tuple:
    """``a=1/b=x%2Fy`` -> ``("1", "x/y")`` (partition folder names are
    percent-escaped; NULL has a reserved name)."""
    kv = dict(seg.split("=", 1) for seg in rel.strip("/").split("/") if "=" in seg)
    return tuple(None if kv.get(c) == _DEFAULT_PARTITION else unquote(kv.get(c, ""))
                 for c in cols)


def written_partitions(spark: SparkSession, root: str, cols: Sequence[str]) -> dict[tuple, str]:
    """Partition values (as text) -> folder, for a partitioned write under
    ``root``: its folders are listed, not their files."""
    return {_values_from_path("/".join(f.rsplit("/", len(cols))[1:]), cols): f for f in _partition_folders(spark, root, cols)}


def partition_values(df: DataFrame, cols: Sequence[str]) -> set[tuple]:
    """Distinct partition values of ``df`` as text, formatted the way Spark
    names partition folders (a cast to string). At most one row per
    partition reaches the driver."""
    rows = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).distinct().collect()
    return {tuple(r) for r in rows}


def create_partitioned_table(spark: SparkSession, name: str, path: str, schema,
                             partition_by: Sequence[str], root: str | None = None,
                             properties: dict[str, str] | None = None) -> None:
    """Register a partitioned snapshot folder as a table whose partitions are
    tracked by the catalog. Column types are declared (not inferred from the
    folder names, which would turn ``"007"`` into a number)."""
    db = name.rpartition(".")[0]
    if db:
        create_database(spark, db, root)
    part = {c.lower() for c in partition_by}
    fields = ([f for f in schema.fields if f.name.lower() not in part]
              + [f for p in partition_by for f in schema.fields if f.name.lower() == p.lower()])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    q = _quote_name(name)
    mark_registered(spark, path)
    held = ", ".join(f"{_sql_literal(k)} = {_sql_literal(v)}" for k, v in (properties or {}).items())
    spark.sql(f"CREATE TABLE {q} ({ddl}) USING parquet PARTITIONED BY ({parts}) LOCATION '{path}'" + (f" TBLPROPERTIES ({held})" if held else ""))
    spark.sql(f"ALTER TABLE {q} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def swap_partitions(spark: SparkSession, name: str, cols: Sequence[str], touched: set[tuple],
                    written: dict[tuple, str], path: str) -> None:
    """Point each touched partition at its new folder under ``path``; add new
    partitions; drop touched partitions that are now empty. One catalog call
    for each repointed partition (see the module's note on that window),
    ``SWAP_CALLS`` of them at a time."""
    mark_registered(spark, path)
    q = _quote_name(name)
    drop_partitions(spark, name, cols, touched - set(written))
    if written:
        every = sorted(written, key=repr)
        # new ones are added; for the others this does nothing, and they are repointed
        spark.sql(f"ALTER TABLE {q} ADD IF NOT EXISTS " + " ".join(f"{_spec(cols, v)} LOCATION '{written[v]}'" for v in every))
        with ThreadPoolExecutor(min(SWAP_CALLS, len(every)), thread_name_prefix="landfall-swap") as pool:
            list(pool.map(lambda v: spark.sql(f"ALTER TABLE {q} {_spec(cols, v)} SET LOCATION '{written[v]}'"), every))
    spark.catalog.refreshTable(name)


def drop_partitions(spark: SparkSession, name: str, cols: Sequence[str], values: Iterable[tuple]) -> None:
    """Take partitions (values as text) out of the catalog, in one call."""
    gone = sorted(values, key=repr)
    if gone:
        spark.sql(f"ALTER TABLE {_quote_name(name)} DROP IF EXISTS " + ", ".join(_spec(cols, v) for v in gone))
        spark.catalog.refreshTable(name)


def partition_filter(df: DataFrame, cols: Sequence[str], values: Iterable[tuple]) -> Column:
    """Rows of the partitions with these values (as text). Each column's values
    are compared as its own type, which a catalog can prune by; for several
    columns the exact combinations are checked besides."""
    values = list(values)
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = F.lit(bool(values))
    for i, c in enumerate(cols):
        column = F.col(f"`{c}`")
        some = [F.lit(v).cast(kinds[c.lower()]) for v in sorted({v[i] for v in values if v[i] is not None})]
        one = column.isin(*some) if some else F.lit(False)
        out = out & (one | column.isNull() if any(v[i] is None for v in values) else one)
    return out & _null_safe_in(cols, values) if len(cols) > 1 and values else out


def _null_safe_in(cols: Sequence[str], values: Sequence[tuple]) -> Column:
    """One IN over the values side by side, each behind its length."""
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in (F.col(f"`{c}`").cast("string") for c in cols)]
    texts = ["".join("-" if x is None else f"{len(x)}:{x}" for x in v) for v in values]
    return F.concat(*parts).isin(*texts)


# ---------------------------------------------------------------- snapshot retention

def _table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote_name(name)}").collect()
    return [r["data_type"] for r in rows if r["col_name"] == "Location"][0]


def _snapshot_folder(path: str) -> str | None:
    """``…/tbl/snapshot-123-ab/p=1/part-0.parquet`` -> ``…/tbl/snapshot-123-ab``."""
    parts = path.rstrip("/").split("/")
    for i in range(len(parts) - 1, -1, -1):
        if parts[i].startswith("snapshot-"):
            return "/".join(parts[:i + 1])
    return None


def expire_snapshots(spark: SparkSession, name: str, retain: int = 2) -> list[str]:
    """Delete what table ``name`` no longer needs, and return the deleted
    folders. Versions are snapshot folders that the table was pointed at;
    others beside them are leftovers of writers that died, and go.

    Of an unpartitioned table the ``retain`` newest versions stay, and the one
    in use. A partitioned table keeps that many versions of each partition, and
    the one in use: a partition's own folder goes when newer ones replace it,
    a snapshot folder when nothing is left in it. ``retain >= 2`` leaves
    readers that planned before the last swap their files. Only folders are
    listed, never the files of the table."""
    if retain < 1:
        raise ValueError("retain must be at least 1")
    current = _snapshot_folder(_table_location(spark, name))
    if current is None:
        return []
    cols = partition_columns(spark, name)
    fs, base = _hadoop(spark, current.rsplit("/", 1)[0])
    folders = sorted((st.getPath().toString() for st in fs.listStatus(base)
                      if st.isDirectory() and st.getPath().getName().startswith("snapshot-")),
                     key=lambda p: p.rsplit("/", 1)[-1])
    versions = [p for p in folders if is_registered(spark, p) or _norm_path(p) == _norm_path(current)]
    doomed = [p for p in folders if p not in versions]
    if not cols:
        doomed += [p for p in versions[:-retain] if _norm_path(p) != _norm_path(current)]
    else:
        doomed += _replaced_partitions(spark, name, cols, versions, retain)
    for p in doomed:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p), True)
    if cols:
        for p in versions:
            if _norm_path(p) != _norm_path(current) and not _partition_folders(spark, p, cols):
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p), True)
                doomed.append(p)
    return doomed


def _partition_folders(spark: SparkSession, path: str, cols: Sequence[str]) -> list[str]:
    fs, pattern = _hadoop(spark, path + "/*=*" * len(cols))
    return [st.getPath().toString() for st in fs.globStatus(pattern) or []]


def _replaced_partitions(spark: SparkSession, name: str, cols: Sequence[str], versions: Sequence[str],
                         retain: int) -> list[str]:
    """Folders of partitions that ``retain`` newer versions replace."""
    by: dict[str, list[str]] = {}
    for version in versions:   # oldest first
        for folder in _partition_folders(spark, version, cols):
            by.setdefault("/".join(folder.rsplit("/", len(cols))[1:]), []).append(folder)
    out = []
    for rel, held in by.items():
        old = held[:-retain]
        if old:
            used = _partition_location(spark, name, _spec(cols, _values_from_path(rel, cols)))
            out += [f for f in old if used is None or _norm_path(f) != _norm_path(used)]
    return out


def _partition_location(spark: SparkSession, name: str, spec: str) -> str | None:
    """Where the catalog has a partition, None if it has none."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote_name(name)} {spec}").collect()
    except AnalysisException:
        return None
    found = [r["data_type"] for r in rows if r["col_name"] == "Location"]
    return found[0] if found else None


def _norm_path(p: str) -> str:
    """Compare paths without their scheme spelling (``file:/x`` vs ``file:///x``)."""
    return unquote(p).split(":", 1)[-1].lstrip("/") if p else p
