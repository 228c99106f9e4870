"""

Every registered query reads the given tables (or data Spark derives from
them) in full. The change batch used by the upsert-style queries is the
incremental window of a run on 2000-01-01: orders dated on or after
1999-12-31 get status ``'X'``, and every urgent order in that window is
followed up by a new order (key ``-(o_orderkey + 1)``, which no existing order
can have at any scale).

The JDBC-backed queries (``jdbc_*``, ``partition_bounds``, ``land_*``,
``audit_*``, ``key_duplicates_ranged``) load the given tables into an embedded
in-memory Derby database as the stand-in source. No server is started and no
port opened, but only the JVM that made the database sees it, so these queries
need local mode; on a cluster they need a real source database.
"""

from __future__ import annotations

import importlib.util
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.domains import sales
from landfall.functions import (as_text, decode_typed, render_filter, snake_case,
                                staging_key_col, start_date)
from landfall.functions.dates import derby_date_literal
from landfall.operators import (duplicate_keys, duplicate_keys_ranged, key_length_mismatches, merge_action_counts,
                                null_violations, page, rename_positional,
                                snake_case_columns, upsert)
from landfall.plans import (activate, active_for_land, active_for_stage, active_schemas,
                            control_table_name, deactivate, init, land, list_control, list_log,
                            load_into, log_table_name, seed_control, set_flag, stage, stage_frame,
                            table_info)
from landfall.plans.control import CONTROL_SCHEMA, key_lists
from landfall.sources import (JdbcConnection, JdbcTable, Zones, catalog_table, create_database,
                              qualified, read_table, register_catalog, stage_batch, write_snapshot)
from landfall.session import ensure_checkpoint_dir, scratch_path
from landfall.streaming import upsert_available

RUN_DATE = "2000-01-01"
START = str(start_date(RUN_DATE))  # 1999-12-31

ORDERS_PASCAL = {"o_orderkey": "OrderKey", "o_custkey": "CustKey", "o_orderstatus": "OrderStatus",
                 "o_totalprice": "TotalPrice", "o_orderdate": "OrderDate",
                 "o_orderpriority": "OrderPriority"}
LINEITEM_PASCAL = {"l_orderkey": "OrderKey", "l_partkey": "PartKey", "l_suppkey": "SuppKey",
                   "l_linenumber": "LineNumber", "l_quantity": "Quantity",
                   "l_extendedprice": "ExtendedPrice", "l_discount": "Discount", "l_tax": "Tax",
                   "l_returnflag": "ReturnFlag", "l_linestatus": "LineStatus",
                   "l_shipdate": "ShipDate"}


# ---------------------------------------------------------------- helpers

def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _tag() -> str:
    return uuid.uuid4().hex[:8]


def _root(spark: SparkSession) -> str:
    return scratch_path(spark, "warehouse")


def _zones() -> Zones:
    t = _tag()
    return Zones(ctr=f"c{t}", raw=f"r{t}", stg=f"s{t}")


def _catalog_table(spark: SparkSession, d: str, name: str) -> str:
    """A file registered as an external catalog table (no copy)."""
    db = f"src_{_tag()}"
    create_database(spark, db, _root(spark))
    spark.catalog.createTable(f"{db}.{name}", path=f"{d}/{name}.parquet", source="parquet")
    return f"{db}.{name}"


def _catalog_orders(spark: SparkSession, d: str) -> str:
    return _catalog_table(spark, d, "orders")


def _window(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) >= F.to_date(F.lit(START)))


def _changes(orders: DataFrame) -> DataFrame:
    """The change batch of the run (see module docstring)."""
    b = _window(orders, "o_orderdate").withColumn("o_orderstatus", F.lit("X"))
    new = (b.where(F.col("o_orderpriority") == "1-URGENT")
            .withColumn("o_orderkey", -(F.col("o_orderkey") + F.lit(1))))
    return b.unionByName(new)


def _ntz(df: DataFrame) -> DataFrame:
    """JDBC reads give session-zone timestamps; the test tables are zone-less."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.simpleString() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


def _derby(spark: SparkSession, tables: dict[str, DataFrame]) -> JdbcConnection:
    """An in-memory Derby database (no port) holding the given frames."""
    url = f"jdbc:derby:memory:lf{_tag()};create=true"
    for name, df in tables.items():
        (df.write.format("jdbc").option("url", url).option("dbtable", f"APP.{name}")
           .mode("overwrite").save())
    return JdbcConnection(url)


def _control_row(schema, table, pk, *, stg_pk=None, flt=None, selected=None,
                 part_col=None, n_parts=None, active=True) -> dict:
    return {"schema_name": schema, "table_name": table, "primary_key": pk,
            "stg_primary_key": stg_pk, "active": active, "filter": flt, "selected": selected,
            "partition_column": part_col, "num_partitions": n_parts}


def _control(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = CONTROL_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CONTROL_SCHEMA)


def _control_from_customer(c: DataFrame) -> DataFrame:
    """A control-shaped table with one row per customer (used to run the
    control-table operators over a table that grows with the data)."""
    nk = F.col("c_nationkey")
    return c.select(
        F.col("c_mktsegment").alias("schema_name"),
        F.col("c_name").alias("table_name"),
        F.when(nk % 3 == 0, F.lit("OrderKey, LineNumber")).otherwise(F.lit("CustKey"))
         .alias("primary_key"),
        F.when(nk % 7 == 0, F.lit("a, b, c"))
         .when(nk % 2 == 0, F.when(nk % 3 == 0, F.lit("order_id, line_id")).otherwise(F.lit("id")))
         .alias("stg_primary_key"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.lit("ModifiedDate >= :start_date").alias("filter"),
        F.when(nk % 4 == 0, F.lit("CustKey, Name")).alias("selected"),
        F.when(nk % 5 != 0, F.lit("ModifiedDate")).alias("partition_column"),
        F.when(nk % 5 != 0, (nk % 8 + 1).cast("int")).alias("num_partitions"),
    )


CONTROL_FROM_CUSTOMER_SQL = """ctl AS (
  SELECT c_mktsegment AS schema_name, c_name AS table_name,
         CASE WHEN c_nationkey % 3 = 0 THEN 'OrderKey, LineNumber' ELSE 'CustKey' END AS primary_key,
         CASE WHEN c_nationkey % 7 = 0 THEN 'a, b, c'
              WHEN c_nationkey % 2 = 0 THEN CASE WHEN c_nationkey % 3 = 0 THEN 'order_id, line_id' ELSE 'id' END
         END AS stg_primary_key,
         c_acctbal > 0 AS active,
         'ModifiedDate >= :start_date' AS filter,
         CASE WHEN c_nationkey % 4 = 0 THEN 'CustKey, Name' END AS selected,
         CASE WHEN c_nationkey % 5 <> 0 THEN 'ModifiedDate' END AS partition_column,
         CASE WHEN c_nationkey % 5 <> 0 THEN CAST(c_nationkey % 8 + 1 AS INTEGER) END AS num_partitions
  FROM customer)"""


def _store_frame(spark: SparkSession, d: str) -> DataFrame:
    """Store-shaped rows built from supplier, with the survey as an XML document."""
    s = _read(spark, d, "supplier")
    survey = F.struct(
        F.col("s_acctbal").cast("decimal(18,2)").alias("AnnualRevenue"),
        F.col("s_nationkey").alias("AnnualSales"),
        F.col("s_name").alias("BankName"),
        F.col("s_suppkey").cast("string").alias("Brands"),
        F.lit("OS").alias("BusinessType"),
        F.lit("T1").alias("Internet"),
        F.col("s_nationkey").alias("NumberEmployees"),
        F.lit("Touring").alias("Specialty"),
        (F.col("s_nationkey") * 1000).alias("SquareFeet"),
        (F.lit(1990) + F.col("s_nationkey")).alias("YearOpened"))
    xml = F.to_xml(survey, {"rowTag": "StoreSurvey"})
    return s.select(F.col("s_suppkey").alias("BusinessEntityID"), F.col("s_name").alias("Name"),
                    xml.alias("Demographics"))


# ---------------------------------------------------------------- scans

def q_table_scan_full(spark, d):
    return read_table(spark, _catalog_orders(spark, d))


def q_table_scan_incremental(spark, d):
    pred = render_filter("o_orderdate >= :start_date", RUN_DATE)
    return read_table(spark, _catalog_orders(spark, d), None, pred)


def q_select_listed(spark, d):
    return read_table(spark, _catalog_orders(spark, d), ["o_orderkey", "o_orderdate"])


def q_jdbc_scan(spark, d):
    conn = _derby(spark, {"nation": _read(spark, d, "nation")})
    return JdbcTable(conn, "APP", "nation").read(spark)


def q_jdbc_select_listed(spark, d):
    conn = _derby(spark, {"orders": _read(spark, d, "orders")})
    src = JdbcTable(conn, "APP", "orders", selected=["o_orderkey", "o_orderdate"],
                    partition_column="o_orderkey", num_partitions=4)
    return _ntz(src.read(spark))


def q_jdbc_partitioned_scan(spark, d):
    conn = _derby(spark, {"customer": _read(spark, d, "customer")})
    return JdbcTable(conn, "APP", "customer", partition_column="c_custkey",
                     num_partitions=4).read(spark)


def q_jdbc_partitioned_unselected(spark, d):
    """Split on a column that the column list leaves out."""
    conn = _derby(spark, {"orders": _read(spark, d, "orders")})
    return JdbcTable(conn, "APP", "orders", selected=["o_orderkey", "o_totalprice"],
                     partition_column="o_custkey", num_partitions=4).read(spark)


def _derby_orders(spark, d):
    conn = _derby(spark, {"orders": _read(spark, d, "orders")})
    src = JdbcTable(conn, "APP", "orders", partition_column="o_orderdate", num_partitions=4)
    pred = render_filter('"o_orderdate" >= :start_date', RUN_DATE, derby_date_literal)
    return src, pred


def q_jdbc_incremental_scan(spark, d):
    src, pred = _derby_orders(spark, d)
    return _ntz(src.read(spark, pred))


def q_jdbc_quantile_scan(spark, d):
    """Nine in ten orders moved to one day, read in ranges of equal numbers of
    rows by day and, within it, by key."""
    o = _read(spark, d, "orders")
    day = F.when(F.col("o_orderkey") % 10 != 0, F.lit("1998-06-01").cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))
    conn = _derby(spark, {"orders": o.withColumn("o_orderdate", day)})
    return _ntz(JdbcTable(conn, "APP", "orders", partition_column="o_orderdate", num_partitions=8, even=True,
                          tie_column="o_orderkey").read(spark))


def q_jdbc_catalog_scan(spark, d):
    """The source database as a Spark catalog: the window, the columns and the
    aggregate run inside the database."""
    name = register_catalog(spark, f"src_{_tag()}", _derby(spark, {"orders": _read(spark, d, "orders")}))
    rows = catalog_table(spark, name, "APP", "ORDERS").where("o_custkey >= 100 AND o_totalprice > 1000")
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most"))


def q_partition_bounds(spark, d):
    src, pred = _derby_orders(spark, d)
    return _ntz(src.bounds_frame(spark, pred))


def q_movements_count(spark, d):
    pred = render_filter("o_orderdate >= :start_date", RUN_DATE)
    staged, _ = stage_batch(read_table(spark, _catalog_orders(spark, d), None, pred))
    return staged.agg(F.count(F.lit(1)).alias("movements"))


# ---------------------------------------------------------------- loads and upserts

def q_load_first(spark, d):
    target = f"lf_{_tag()}.orders"
    load_into(spark, _read(spark, d, "orders"), target, ["o_orderkey"], root=_root(spark))
    return spark.table(target)


def q_load_empty_batch(spark, d):
    root = _root(spark)
    orders = _read(spark, d, "orders")
    target, absent = f"lf_{_tag()}.orders", f"lf_{_tag()}.never"
    load_into(spark, orders, target, ["o_orderkey"], root=root)
    empty = orders.where(F.col("o_orderdate") > F.to_date(F.lit("2100-01-01")))
    if load_into(spark, empty, target, ["o_orderkey"], root=root).mode != "skipped":
        raise AssertionError("an empty batch must not be merged")
    load_into(spark, empty, absent, ["o_orderkey"], root=root)
    if spark.catalog.tableExists(absent):
        raise AssertionError("an empty first batch must not create the target")
    return spark.table(target)


def _counted_changes(spark, d):
    """The change batch, staged once (one pass gives the rows and their count),
    as the load step does before an upsert."""
    orders = _read(spark, d, "orders")
    s, n = stage_batch(_changes(orders))
    return orders, s, n


def q_upsert_single_key(spark, d):
    orders, s, n = _counted_changes(spark, d)
    return upsert(orders, s, ["o_orderkey"], source_rows=n)


def q_upsert_idempotent(spark, d):
    orders, s, n = _counted_changes(spark, d)
    once = upsert(orders, s, ["o_orderkey"], source_rows=n)
    return upsert(once, s, ["o_orderkey"], source_rows=n)


def q_upsert_mapped_key(spark, d):
    orders, s, n = _counted_changes(spark, d)
    return upsert(orders, s.withColumnRenamed("o_orderkey", "OrderKey"),
                  {"OrderKey": "o_orderkey"}, source_rows=n)


def q_upsert_composite_key(spark, d):
    li = _read(spark, d, "lineitem")
    orders = _read(spark, d, "orders")
    # the target, written once (as a loaded table would be): aggregated once
    t, _ = stage_batch(li.groupBy("l_orderkey", "l_linenumber")
                         .agg(F.count(F.lit(1)).alias("n")))
    changed = _window(orders, "o_orderdate").select(F.col("o_orderkey").alias("l_orderkey"),
                                                    "o_orderpriority")
    hit = t.join(changed, "l_orderkey", "left_semi")
    # urgent orders in the window get each line repeated under a new line number
    new_lines = (t.join(changed.where(F.col("o_orderpriority") == "1-URGENT").select("l_orderkey"),
                        "l_orderkey", "left_semi")
                  .select("l_orderkey", (-F.col("l_linenumber")).alias("l_linenumber"), "n"))
    s, n = stage_batch(hit.select("l_orderkey", "l_linenumber", (-F.col("n")).alias("n"))
                          .unionByName(new_lines))
    return upsert(t, s, ["l_orderkey", "l_linenumber"], source_rows=n)


def q_upsert_large_batch(spark, d):
    """The lines of urgent orders in the window change and get a twin each. The
    budget takes a bitmap of the batch's keys, not the keys: lines that miss
    the bitmap aren't shuffled, the others are joined exactly."""
    lines, _ = stage_batch(_read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber")
                           .agg(F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("top_price")))
    urgent = _window(_read(spark, d, "orders"), "o_orderdate").where(F.col("o_orderpriority") == "1-URGENT")
    hit = lines.join(urgent.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    changed = hit.withColumn("n", -F.col("n"))
    s, n = stage_batch(changed.unionByName(hit.withColumn("l_linenumber", -F.col("l_linenumber"))))
    return upsert(lines, s, ["l_orderkey", "l_linenumber"], source_rows=n, broadcast_bytes=8 * n + 8192)


def q_merge_action_counts(spark, d):
    orders, s, n = _counted_changes(spark, d)
    return merge_action_counts(orders, s, ["o_orderkey"], source_rows=n)


def q_upsert_partitioned(spark, d):
    """Orders laid out by status; the batch moves every changed order to the
    new status's partition, so the old partitions must lose those rows."""
    root = _root(spark)
    orders = _read(spark, d, "orders")
    target = f"lf_{_tag()}.orders"
    load_into(spark, orders, target, ["o_orderkey"], root=root, partition_by=["o_orderstatus"])
    load_into(spark, _changes(orders), target, ["o_orderkey"], root=root)
    return spark.table(target)


def q_upsert_key_ranges(spark, d):
    """Orders laid out in ranges of their key; the batch rewrites the ranges
    that its keys fall in, and ranges that grow too large are split."""
    root = _root(spark)
    orders = _read(spark, d, "orders")
    target = f"lf_{_tag()}.orders"
    load_into(spark, orders, target, ["o_orderkey"], root=root, range_rows=4000)
    load_into(spark, _changes(orders), target, ["o_orderkey"], root=root)
    return read_table(spark, target)


def q_upsert_extra_column(spark, d):
    """The batch has grown a column that the target lacks."""
    root = _root(spark)
    orders = _read(spark, d, "orders")
    target = f"lf_{_tag()}.orders"
    load_into(spark, orders, target, ["o_orderkey"], root=root)
    load_into(spark, _changes(orders).withColumn("o_comment", F.lit("new")), target, ["o_orderkey"], root=root)
    return spark.table(target)


def q_upsert_stream(spark, d):
    """The change batch arrives as files of a stream; each micro-batch is
    upserted into a target that was first loaded with all orders."""
    root = _root(spark)
    orders = _read(spark, d, "orders")
    target = f"lf_{_tag()}.orders"
    load_into(spark, orders, target, ["o_orderkey"], root=root)
    inbox = scratch_path(spark, "inbox")
    _changes(orders).write.parquet(inbox)
    changes = spark.readStream.schema(orders.schema).parquet(inbox)
    upsert_available(changes, target, ["o_orderkey"], version="o_orderdate", root=root)
    return spark.table(target)


# ---------------------------------------------------------------- land (JDBC -> raw)

def _land_orders(spark, d, incremental: bool, split_by_key: bool = False, **options):
    orders = _read(spark, d, "orders")
    zones, root = _zones(), _root(spark)
    row = _control_row("APP", "orders", "o_orderkey", flt='"o_orderdate" >= :start_date',
                       part_col="o_orderdate", n_parts=4)
    land(spark, _control(spark, [row]), _derby(spark, {"orders": orders}), RUN_DATE,
         zones=zones, root=root, split_by_key=split_by_key, **options)
    if incremental:
        # the source now holds the changed and the new rows
        after = upsert(orders, _changes(orders), ["o_orderkey"])
        land(spark, _control(spark, [row]), _derby(spark, {"orders": after}), RUN_DATE,
             zones=zones, root=root, split_by_key=split_by_key, **options)
    return _ntz(read_table(spark, qualified(zones.raw, "APP", "orders")))


def q_land_full(spark, d):
    return _land_orders(spark, d, incremental=False)


def q_land_incremental(spark, d):
    return _land_orders(spark, d, incremental=True)


def q_land_split_by_key(spark, d):
    """Full then incremental land, reading in ranges of the key."""
    return _land_orders(spark, d, incremental=True, split_by_key=True)


def q_land_partitioned(spark, d):
    """Full then incremental land into a raw table laid out by status."""
    return _land_orders(spark, d, incremental=True, partition_by={"orders": ["o_orderstatus"]})


def q_land_key_ranges(spark, d):
    """Full then incremental land into a raw table laid out in ranges of its
    key, read from the source in ranges of equal numbers of rows."""
    return _land_orders(spark, d, incremental=True, range_rows=4000, even_ranges=True)


def _land_with_log(spark, d, with_missing: bool):
    zones, root = _zones(), _root(spark)
    log_table = qualified(zones.ctr, "loading", "data_ingestion_log")
    conn = _derby(spark, {"orders": _read(spark, d, "orders"),
                          "events": _read(spark, d, "events")})
    rows = [_control_row("APP", "orders", "o_orderkey", part_col="o_orderkey", n_parts=4),
            _control_row("APP", "events", "event_id", part_col="event_id", n_parts=4)]
    if with_missing:
        rows.append(_control_row("APP", "missing_table", "id"))
    land(spark, _control(spark, rows), conn, RUN_DATE, zones=zones, root=root,
         log_table=log_table, raise_on_failure=False)
    return _log_rows(spark.table(log_table), zones)


def _log_rows(log: DataFrame, zones: Zones) -> DataFrame:
    """All columns of the log. The stamp and the run's own zone names differ
    from run to run: whether there is a stamp, and the zone, are shown."""
    zone = lambda c: F.when(F.col(c) == zones.raw, "raw").when(F.col(c) == zones.stg, "stg").otherwise(F.col(c))
    now = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("ingestion_date")
    return log.select(
        now.between(0, 3600).alias("stamped"), zone("source_catalog_name").alias("source_catalog_name"), "source_schema_name", "source_table_name",
        zone("target_catalog_name").alias("target_catalog_name"), "target_schema_name", "target_table_name",
        F.col("movements").cast("bigint").alias("movements"), F.col("error").isNotNull().alias("failed"))


def q_audit_append(spark, d):
    return _land_with_log(spark, d, with_missing=False)


def q_audit_failures(spark, d):
    return _land_with_log(spark, d, with_missing=True)


# ---------------------------------------------------------------- naming and staging

def q_snake_case_columns(spark, d):
    return snake_case_columns(_read(spark, d, "orders").withColumnsRenamed(ORDERS_PASCAL))


def q_snake_case_values(spark, d):
    p = _read(spark, d, "part")
    x = F.concat(F.regexp_replace("p_brand", "#", ""), F.upper("p_name"), F.col("p_type"),
                 F.lit("Id"), F.col("p_size").cast("string"), F.lit("XMLData"))
    return p.select("p_partkey", x.alias("x")).select("p_partkey", "x",
                                                      snake_case("x").alias("snake"))


def q_rename_key_single(spark, d):
    df = snake_case_columns(_read(spark, d, "orders").withColumnsRenamed(ORDERS_PASCAL))
    return rename_positional(df, ["order_key"], ["id"])


def q_rename_key_composite(spark, d):
    df = snake_case_columns(_read(spark, d, "lineitem").withColumnsRenamed(LINEITEM_PASCAL))
    return rename_positional(df, ["order_key", "line_number"], ["order_id", "line_id"])


def _stage_orders(spark, d, incremental: bool, **options):
    orders = _read(spark, d, "orders")
    zones, root = _zones(), _root(spark)
    raw = qualified(zones.raw, "Shop", "Orders")
    write_snapshot(spark, orders.withColumnsRenamed(ORDERS_PASCAL), raw, root)
    ctl = _control(spark, [_control_row("Shop", "Orders", "OrderKey", stg_pk="id",
                                        flt="OrderDate >= :start_date")])
    routes = {("Shop", "Orders"): [("orders", None)]}
    stage(spark, ctl, routes, RUN_DATE, zones=zones, root=root, **options)
    if incremental:
        load_into(spark, _changes(orders).withColumnsRenamed(ORDERS_PASCAL), raw, ["OrderKey"],
                  root=root)
        stage(spark, ctl, routes, RUN_DATE, zones=zones, root=root, **options)
    return read_table(spark, qualified(zones.stg, "shop", "orders"))


def q_stage_fanout_log(spark, d):
    """One raw Store table staged into its two routes; the log tells the rows
    each route moved."""
    zones, root = _zones(), _root(spark)
    log_table = qualified(zones.ctr, "loading", "data_ingestion_log")
    write_snapshot(spark, _store_frame(spark, d), qualified(zones.raw, "Sales", "Store"), root)
    ctl = _control(spark, [_control_row("Sales", "Store", "BusinessEntityID")])
    routes = {("Sales", "Store"): sales.ROUTES[("Sales", "Store")]}
    stage(spark, ctl, routes, RUN_DATE, zones=zones, root=root, log_table=log_table)
    return _log_rows(spark.table(log_table), zones)


def q_stage_fanout_incremental(spark, d):
    """A raw table's change window (every third store, renamed) read once for
    both of its routes; the two staged tables side by side."""
    zones, root = _zones(), _root(spark)
    raw, stores = qualified(zones.raw, "Sales", "Store"), _store_frame(spark, d)
    write_snapshot(spark, stores, raw, root)
    ctl = _control(spark, [_control_row("Sales", "Store", "BusinessEntityID", flt="BusinessEntityID % 3 = 0")])
    routes = {("Sales", "Store"): sales.ROUTES[("Sales", "Store")]}
    stage(spark, ctl, routes, RUN_DATE, zones=zones, root=root)
    write_snapshot(spark, stores.withColumn("Name", F.concat(F.lit("new "), F.col("Name"))), raw, root)
    stage(spark, ctl, routes, RUN_DATE, zones=zones, root=root)
    names = spark.table(qualified(zones.stg, "sales", "stores")).select("business_entity_id", "name")
    return names.join(spark.table(qualified(zones.stg, "sales", "store_demographics")).select("business_entity_id", "bank_name"), "business_entity_id")


def q_stage_generic(spark, d):
    return _stage_orders(spark, d, incremental=False)


def q_stage_incremental(spark, d):
    return _stage_orders(spark, d, incremental=True)


def q_stage_key_ranges(spark, d):
    """Full then incremental stage into a table laid out in ranges of its key."""
    return _stage_orders(spark, d, incremental=True, range_rows=4000)


def q_stage_partitioned(spark, d):
    """Full then incremental stage into a table laid out by status."""
    return _stage_orders(spark, d, incremental=True, partition_by={"orders": ["order_status"]})


def q_stage_credit_cards(spark, d):
    c = _read(spark, d, "customer")
    src = c.select(F.col("c_custkey").alias("CreditCardID"), F.col("c_mktsegment").alias("CardType"),
                   F.col("c_name").alias("CardNumber"), F.col("c_nationkey").alias("ExpMonth"),
                   (F.lit(2000) + F.col("c_nationkey")).alias("ExpYear"))
    return stage_frame(src, sales.TRANSFORMS["credits_cards"], ["credit_card_id"], ["id"])


def q_stage_order_details(spark, d):
    li = _read(spark, d, "lineitem")
    src = li.select(F.col("l_orderkey").alias("SalesOrderID"),
                    F.col("l_linenumber").alias("SalesOrderDetailID"),
                    F.col("l_quantity").alias("OrderQty"), F.col("l_partkey").alias("ProductID"),
                    F.col("l_extendedprice").alias("UnitPrice"))
    return stage_frame(src, sales.TRANSFORMS["order_details"],
                       ["sales_order_id", "sales_order_detail_id"], None)


def q_stage_order_headers(spark, d):
    o = _read(spark, d, "orders")
    src = o.select(F.col("o_orderkey").alias("SalesOrderID"), F.col("o_custkey").alias("CustomerID"),
                   F.col("o_totalprice").alias("TaxAmt"), F.col("o_orderdate").alias("OrderDate"),
                   F.col("o_orderstatus").alias("Status"))
    return stage_frame(src, sales.TRANSFORMS["order_headers"], ["sales_order_id"], None)


def q_stage_sales_people(spark, d):
    s = _read(spark, d, "supplier")
    src = s.select(F.col("s_suppkey").alias("BusinessEntityID"),
                   F.col("s_acctbal").alias("CommissionPct"),
                   F.col("s_nationkey").alias("TerritoryID"))
    return stage_frame(src, sales.TRANSFORMS["sales_people"], ["business_entity_id"], None)


def q_stage_special_offers(spark, d):
    p = _read(spark, d, "part")
    src = p.select(F.col("p_partkey").alias("SpecialOfferID"), F.col("p_name").alias("Description"),
                   F.col("p_retailprice").alias("DiscountPct"), F.col("p_type").alias("Type"),
                   F.col("p_size").alias("MinQty"), (F.col("p_size") * 10).alias("MaxQty"))
    return stage_frame(src, sales.TRANSFORMS["special_offers"], ["special_offer_id"], ["id"])


def q_stage_stores(spark, d):
    return stage_frame(_store_frame(spark, d), sales.TRANSFORMS["stores"],
                       ["business_entity_id"], None)


def q_stage_store_demographics(spark, d):
    return stage_frame(_store_frame(spark, d), sales.TRANSFORMS["store_demographics"],
                       ["business_entity_id"], None)


# ---------------------------------------------------------------- control table

def q_zone_schemas(spark, d):
    c = _read(spark, d, "customer")
    return active_schemas(c, "c_mktsegment", F.col("c_acctbal") > 5000) \
        .withColumnRenamed("c_mktsegment", "schema_name")


def q_control_deactivate(spark, d):
    c = _read(spark, d, "customer").withColumn("active", F.lit(True))
    return set_flag(c, {"c_nationkey": 7, "c_mktsegment": "BUILDING"}, "active", False)


def q_control_activate(spark, d):
    c = _read(spark, d, "customer").withColumn("active", F.lit(False))
    return set_flag(c, {"c_nationkey": 7, "c_mktsegment": "BUILDING"}, "active", True)


def q_control_seed(spark, d):
    """Seeding inserts only missing keys: rows already present (here: all rows
    with a partition column, switched off) keep their flag."""
    ctl = _control_from_customer(_read(spark, d, "customer"))
    name = f"lf_{_tag()}.data_ingestion"
    root = _root(spark)
    seed_control(spark, name, ctl.where(F.col("num_partitions").isNotNull())
                 .withColumn("active", F.lit(False)), root)
    seed_control(spark, name, ctl, root)
    return spark.table(name)


def q_control_active_land(spark, d):
    return active_for_land(_control_from_customer(_read(spark, d, "customer")))


def q_control_active_stage(spark, d):
    return active_for_stage(_control_from_customer(_read(spark, d, "customer")))


def q_control_key_lists(spark, d):
    ctl = _control_from_customer(_read(spark, d, "customer"))
    bad = key_length_mismatches(ctl).select("schema_name", "table_name",
                                            F.lit(True).alias("lengths_differ"))
    lists = key_lists(ctl)
    names = [c for c in lists.columns if c not in ("schema_name", "table_name")]
    return (lists.select("schema_name", "table_name", *[F.array_join(c, "|").alias(c) for c in names])
                 .join(bad, ["schema_name", "table_name"], "left")
                 .withColumn("lengths_differ", F.coalesce("lengths_differ", F.lit(False))))


def q_control_effective_key(spark, d):
    ctl = _control_from_customer(_read(spark, d, "customer"))
    return ctl.select("schema_name", "table_name",
                      F.array_join(staging_key_col(), ",").alias("staging_key"))


def _initialised(spark, d) -> tuple[Zones, str]:
    """A control database, seeded from a control-shaped table, log and zones."""
    zones, root = _zones(), _root(spark)
    init(spark, _control_from_customer(_read(spark, d, "customer")), zones=zones, root=root)
    return zones, root


def q_init_databases(spark, d):
    zones, _ = _initialised(spark, d)
    tag = zones.raw[1:]
    found = spark.sql(f"SHOW DATABASES LIKE '*{tag}_*'")
    return found.select(F.regexp_replace(found.columns[0], f"^(.){tag}", "$1").alias("database"))


def q_list_control(spark, d):
    zones, _ = _initialised(spark, d)
    rows, info = list_control(spark, 3, 20, zones=zones)
    return rows.withColumn("total_results", F.lit(info.first()["total_results"]).cast("bigint"))


def q_list_log(spark, d):
    """The log listing over a stored log with one record per order."""
    zones, root = _initialised(spark, d)
    o = _read(spark, d, "orders")
    log = o.select(F.col("o_orderdate").cast("timestamp").alias("ingestion_date"), F.lit(None).cast("string").alias("source_catalog_name"),
                   F.lit("S").alias("source_schema_name"), F.col("o_orderstatus").alias("source_table_name"), F.lit("raw").alias("target_catalog_name"),
                   F.lit("S").alias("target_schema_name"), F.concat(F.lit("t"), F.col("o_orderkey")).alias("target_table_name"),
                   F.col("o_custkey").cast("bigint").alias("movements"), F.lit(None).cast("string").alias("error"))
    write_snapshot(spark, log, log_table_name(zones), root)
    rows, info = list_log(spark, 7, 30, zones=zones)
    return rows.select(F.date_format("ingestion_date", "yyyy-MM-dd").alias("day"), "source_table_name", "target_table_name", "movements",
                       F.lit(info.first()["total_pages"]).cast("bigint").alias("total_pages"))


def q_set_active_stored(spark, d):
    """One table switched off and one on, in the stored control table."""
    zones, root = _initialised(spark, d)
    c = _read(spark, d, "customer")
    ends = c.agg(F.min_by(F.struct("c_mktsegment", "c_name"), "c_custkey").alias("least"), F.max_by(F.struct("c_mktsegment", "c_name"), "c_custkey").alias("most")).first()
    deactivate(spark, *ends["least"], zones=zones, root=root)
    activate(spark, *ends["most"], zones=zones, root=root)
    return spark.table(control_table_name(zones)).select("schema_name", "table_name", "active")


# ---------------------------------------------------------------- paging, decode, checks

def q_page_control(spark, d):
    ctl = _control_from_customer(_read(spark, d, "customer"))
    return page(ctl, ["schema_name", "table_name"], 3, 20)


def q_page_log(spark, d):
    return page(_read(spark, d, "events"), ["ts DESC", "event_id"], 2, 25)


def q_page_all(spark, d):
    return page(_read(spark, d, "events"), ["ts DESC", "event_id"], 0, 0)


def q_page_deep(spark, d):
    return page(_read(spark, d, "events"), ["ts DESC", "event_id"], 300, 25)


def q_page_ties(spark, d):
    """All pages of an order with long ties, one after the other: the table,
    each row once."""
    events = _read(spark, d, "events")
    key, length = "event_type", -(-events.count() // 4)
    parts = [page(events, [f"{key} DESC"], k, length).withColumn("page", F.lit(k)) for k in range(4)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("page")


def q_page_large(spark, d):
    return page(_read(spark, d, "lineitem"), ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_quantity", "l_extendedprice"], 0, 50_000)


def q_page_info(spark, d):
    return table_info(spark, _catalog_table(spark, d, "events"), 2, 25)


def q_decode_typed(spark, d):
    c = _read(spark, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        (F.col("c_acctbal") > 0).alias("c_positive"))
    text, declared = as_text(c)
    return decode_typed(text, declared)


def q_key_duplicates(spark, d):
    return duplicate_keys(_read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_key_duplicates_ranged(spark, d):
    """The same over a JDBC read in ranges of the order key: each task compares
    the neighbours of its own range, nothing is shuffled."""
    lines = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    src = JdbcTable(_derby(spark, {"lineitem": lines}), "APP", "lineitem", partition_column="l_orderkey", num_partitions=8)
    return duplicate_keys_ranged(src.read(spark), ["l_orderkey", "l_linenumber"])


def q_null_violations(spark, d):
    """Required columns of a staged order batch whose key is NULL where the
    source had no priority set (``5-LOW`` stands for "unset" here)."""
    o = _read(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("o_orderdate"))
    return null_violations(o, ["o_orderkey", "o_custkey", "o_orderdate"])


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "table_scan_full": q_table_scan_full,
    "table_scan_incremental": q_table_scan_incremental,
    "select_listed": q_select_listed,
    "jdbc_scan": q_jdbc_scan,
    "jdbc_select_listed": q_jdbc_select_listed,
    "jdbc_partitioned_scan": q_jdbc_partitioned_scan,
    "jdbc_partitioned_unselected": q_jdbc_partitioned_unselected,
    "jdbc_incremental_scan": q_jdbc_incremental_scan,
    "jdbc_quantile_scan": q_jdbc_quantile_scan,
    "jdbc_catalog_scan": q_jdbc_catalog_scan,
    "partition_bounds": q_partition_bounds,
    "movements_count": q_movements_count,
    "load_first": q_load_first,
    "load_empty_batch": q_load_empty_batch,
    "upsert_single_key": q_upsert_single_key,
    "upsert_idempotent": q_upsert_idempotent,
    "upsert_composite_key": q_upsert_composite_key,
    "upsert_large_batch": q_upsert_large_batch,
    "upsert_mapped_key": q_upsert_mapped_key,
    "merge_action_counts": q_merge_action_counts,
    "upsert_partitioned": q_upsert_partitioned,
    "upsert_key_ranges": q_upsert_key_ranges,
    "upsert_extra_column": q_upsert_extra_column,
    "upsert_stream": q_upsert_stream,
    "land_full": q_land_full,
    "land_incremental": q_land_incremental,
    "land_split_by_key": q_land_split_by_key,
    "land_partitioned": q_land_partitioned,
    "land_key_ranges": q_land_key_ranges,
    "audit_append": q_audit_append,
    "audit_failures": q_audit_failures,
    "snake_case_columns": q_snake_case_columns,
    "snake_case_values": q_snake_case_values,
    "rename_key_single": q_rename_key_single,
    "rename_key_composite": q_rename_key_composite,
    "stage_fanout_log": q_stage_fanout_log,
    "stage_fanout_incremental": q_stage_fanout_incremental,
    "stage_generic": q_stage_generic,
    "stage_incremental": q_stage_incremental,
    "stage_partitioned": q_stage_partitioned,
    "stage_key_ranges": q_stage_key_ranges,
    "stage_credit_cards": q_stage_credit_cards,
    "stage_order_details": q_stage_order_details,
    "stage_order_headers": q_stage_order_headers,
    "stage_sales_people": q_stage_sales_people,
    "stage_special_offers": q_stage_special_offers,
    "stage_stores": q_stage_stores,
    "stage_store_demographics": q_stage_store_demographics,
    "zone_schemas": q_zone_schemas,
    "control_activate": q_control_activate,
    "control_deactivate": q_control_deactivate,
    "control_seed": q_control_seed,
    "control_active_land": q_control_active_land,
    "control_active_stage": q_control_active_stage,
    "control_key_lists": q_control_key_lists,
    "control_effective_key": q_control_effective_key,
    "init_databases": q_init_databases,
    "list_control": q_list_control,
    "list_log": q_list_log,
    "set_active_stored": q_set_active_stored,
    "page_control": q_page_control,
    "page_log": q_page_log,
    "page_all": q_page_all,
    "page_deep": q_page_deep,
    "page_ties": q_page_ties,
    "page_large": q_page_large,
    "page_info": q_page_info,
    "decode_typed": q_decode_typed,
    "key_duplicates": q_key_duplicates,
    "key_duplicates_ranged": q_key_duplicates_ranged,
    "null_violations": q_null_violations,
}


# ---------------------------------------------------------------- oracle SQL

_W = f"o_orderdate >= DATE '{START}'"
_CHANGES = f"""b AS (SELECT * FROM orders WHERE {_W}),
  s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM b
        UNION ALL
        SELECT -(o_orderkey + 1), o_custkey, 'X', o_totalprice, o_orderdate, o_orderpriority FROM b
        WHERE o_orderpriority = '1-URGENT')"""
_Q4 = f"""WITH {_CHANGES}
SELECT * FROM orders t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s"""
_ORDERS_SNAKE = ("o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status, "
                 "o_totalprice AS total_price, o_orderdate AS order_date, "
                 "o_orderpriority AS order_priority")
_SNAKE = ("lower(regexp_replace(regexp_replace({x}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), "
          "'([a-z])([A-Z]{{2,}})', '\\1_\\2', 'g'))")
_LIST = "array_to_string(string_split(replace({c}, ' ', ''), ','), '|')"
_SIZE = "CAST(len(string_split(replace({c}, ' ', ''), ',')) AS INTEGER)"
_LOG = """SELECT true AS stamped, {src} AS source_catalog_name, '{schema}' AS source_schema_name, '{table}' AS source_table_name,
  '{zone}' AS target_catalog_name, '{into}' AS target_schema_name, '{target}' AS target_table_name, {n} AS movements, {failed} AS failed"""


def _landed(table: str, n: str = "count(*)", failed: str = "false") -> str:
    return _LOG.format(src="CAST(NULL AS VARCHAR)", schema="APP", table=table, zone="raw", into="APP", target=table, n=n, failed=failed)


def _staged(target: str) -> str:
    return _LOG.format(src="'raw'", schema="Sales", table="Store", zone="stg", into="sales", target=target, n="count(*)", failed="false") + " FROM supplier"


_Q13 = _landed("orders") + " FROM orders UNION ALL " + _landed("events") + " FROM events"
_PAGE_EVENTS = "SELECT * FROM events ORDER BY ts DESC, event_id LIMIT 25 OFFSET {off}"

_ORACLE: dict[str, str] = {
    "table_scan_full": "SELECT * FROM orders",
    "table_scan_incremental": f"SELECT * FROM orders WHERE {_W}",
    "select_listed": "SELECT o_orderkey, o_orderdate FROM orders",
    "jdbc_scan": "SELECT * FROM nation",
    "jdbc_select_listed": "SELECT o_orderkey, o_orderdate FROM orders",
    "jdbc_partitioned_scan": "SELECT * FROM customer",
    "jdbc_partitioned_unselected": "SELECT o_orderkey, o_totalprice FROM orders",
    "jdbc_incremental_scan": f"SELECT * FROM orders WHERE {_W}",
    "jdbc_quantile_scan": """SELECT * REPLACE (CASE WHEN o_orderkey % 10 <> 0 THEN TIMESTAMP '1998-06-01 00:00:00' ELSE o_orderdate END AS o_orderdate) FROM orders""",
    "jdbc_catalog_scan": """SELECT o_custkey, count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most
FROM orders WHERE o_custkey >= 100 AND o_totalprice > 1000 GROUP BY o_custkey""",
    "partition_bounds": (f"SELECT min(o_orderdate) AS lower_bound, max(o_orderdate) AS upper_bound "
                         f"FROM orders WHERE {_W}"),
    "movements_count": f"SELECT count(*) AS movements FROM orders WHERE {_W}",
    "load_first": "SELECT * FROM orders",
    "load_empty_batch": "SELECT * FROM orders",
    "upsert_single_key": _Q4,
    "upsert_idempotent": _Q4,
    "upsert_mapped_key": _Q4,
    "upsert_composite_key": f"""WITH t AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber),
  c AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE {_W})
SELECT t.l_orderkey, t.l_linenumber, CASE WHEN c.o_orderkey IS NULL THEN t.n ELSE -t.n END AS n FROM t LEFT JOIN c ON c.o_orderkey = t.l_orderkey
UNION ALL
SELECT t.l_orderkey, -t.l_linenumber, t.n FROM t JOIN c ON c.o_orderkey = t.l_orderkey WHERE c.o_orderpriority = '1-URGENT'""",
    "upsert_large_batch": f"""WITH t AS (SELECT l_orderkey, l_linenumber, count(*) AS n, max(l_extendedprice) AS top_price FROM lineitem GROUP BY l_orderkey, l_linenumber),
  u AS (SELECT o_orderkey FROM orders WHERE {_W} AND o_orderpriority = '1-URGENT')
SELECT l_orderkey, l_linenumber, CASE WHEN o_orderkey IS NULL THEN n ELSE -n END AS n, top_price FROM t LEFT JOIN u ON o_orderkey = l_orderkey
UNION ALL SELECT l_orderkey, -l_linenumber, n, top_price FROM t JOIN u ON o_orderkey = l_orderkey""",
    "merge_action_counts": f"""WITH {_CHANGES}
SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS action, count(*) AS n
FROM s LEFT JOIN orders t ON s.o_orderkey = t.o_orderkey GROUP BY 1""",
    "upsert_partitioned": _Q4,
    "upsert_key_ranges": _Q4,
    "upsert_extra_column": _Q4,
    "upsert_stream": _Q4,
    "land_full": "SELECT * FROM orders",
    "land_incremental": _Q4,
    "land_split_by_key": _Q4,
    "land_partitioned": _Q4,
    "land_key_ranges": _Q4,
    "audit_append": _Q13,
    "audit_failures": _Q13 + " UNION ALL " + _landed("missing_table", "CAST(NULL AS BIGINT)", "true"),
    "snake_case_columns": f"SELECT {_ORDERS_SNAKE} FROM orders",
    "snake_case_values": ("SELECT p_partkey, x, " + _SNAKE.format(x="x") + " AS snake FROM ("
                          "SELECT p_partkey, replace(p_brand, '#', '') || upper(p_name) || p_type "
                          "|| 'Id' || CAST(p_size AS VARCHAR) || 'XMLData' AS x FROM part)"),
    "rename_key_single": "SELECT " + _ORDERS_SNAKE.replace("AS order_key", "AS id") + " FROM orders",
    "rename_key_composite": """SELECT l_orderkey AS order_id, l_partkey AS part_key, l_suppkey AS supp_key,
  l_linenumber AS line_id, l_quantity AS quantity, l_extendedprice AS extended_price,
  l_discount AS discount, l_tax AS tax, l_returnflag AS return_flag, l_linestatus AS line_status,
  l_shipdate AS ship_date FROM lineitem""",
    "stage_fanout_log": _staged("stores") + " UNION ALL " + _staged("store_demographics"),
    "stage_fanout_incremental": """SELECT s_suppkey AS business_entity_id, CASE WHEN s_suppkey % 3 = 0 THEN 'new ' ELSE '' END || s_name AS name,
  s_name AS bank_name FROM supplier""",
    "stage_generic": "SELECT " + _ORDERS_SNAKE.replace("AS order_key", "AS id") + " FROM orders",
    "stage_incremental": (f"WITH q AS ({_Q4}) SELECT "
                          + _ORDERS_SNAKE.replace("AS order_key", "AS id") + " FROM q"),
    "stage_key_ranges": (f"WITH q AS ({_Q4}) SELECT "
                         + _ORDERS_SNAKE.replace("AS order_key", "AS id") + " FROM q"),
    "stage_partitioned": (f"WITH q AS ({_Q4}) SELECT "
                          + _ORDERS_SNAKE.replace("AS order_key", "AS id") + " FROM q"),
    "stage_credit_cards": """SELECT c_custkey AS id, c_mktsegment AS card_type, c_name AS card_number,
  c_nationkey AS expiration_month, 2000 + c_nationkey AS expiration_year FROM customer""",
    "stage_order_details": """SELECT l_orderkey AS sales_order_id, l_linenumber AS sales_order_detail_id,
  l_quantity AS order_quantity, l_partkey AS product_id, l_extendedprice AS unit_price FROM lineitem""",
    "stage_order_headers": """SELECT o_orderkey AS sales_order_id, o_custkey AS customer_id,
  o_totalprice AS tax_amount, o_orderdate AS order_date, o_orderstatus AS status FROM orders""",
    "stage_sales_people": """SELECT s_suppkey AS business_entity_id, s_acctbal AS commission_percentage,
  s_nationkey AS territory_id FROM supplier""",
    "stage_special_offers": """SELECT p_partkey AS id, p_name AS description, p_retailprice AS discount_percentage,
  p_type AS type, p_size AS min_quantity, p_size * 10 AS max_quantity FROM part""",
    "stage_stores": "SELECT s_suppkey AS business_entity_id, s_name AS name FROM supplier",
    "stage_store_demographics": """SELECT s_suppkey AS business_entity_id,
  CAST(s_acctbal AS DECIMAL(18,2)) AS annual_revenue, s_nationkey AS annual_sales,
  s_name AS bank_name, CAST(s_suppkey AS VARCHAR) AS brands, 'OS' AS business_type,
  'T1' AS internet, s_nationkey AS number_of_employees, 'Touring' AS specialty,
  s_nationkey * 1000 AS square_feet, 1990 + s_nationkey AS year_opened FROM supplier""",
    "zone_schemas": "SELECT DISTINCT c_mktsegment AS schema_name FROM customer WHERE c_acctbal > 5000",
    "control_deactivate": ("SELECT *, NOT (c_nationkey = 7 AND c_mktsegment = 'BUILDING') AS active "
                           "FROM customer"),
    "control_activate": ("SELECT *, (c_nationkey = 7 AND c_mktsegment = 'BUILDING') AS active "
                         "FROM customer"),
    "control_seed": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT schema_name, table_name, primary_key, stg_primary_key,
       CASE WHEN num_partitions IS NOT NULL THEN false ELSE active END AS active,
       filter, selected, partition_column, num_partitions FROM ctl""",
    "control_active_land": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT schema_name, table_name, primary_key, filter, selected, partition_column, num_partitions
FROM ctl WHERE active""",
    "control_active_stage": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT schema_name, table_name, primary_key, stg_primary_key, filter, selected FROM ctl WHERE active""",
    "control_key_lists": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT schema_name, table_name, {_LIST.format(c='primary_key')} AS primary_key_list,
       {_LIST.format(c='stg_primary_key')} AS stg_primary_key_list, {_LIST.format(c='selected')} AS selected_list,
       replace({_SNAKE.format(x="replace(coalesce(stg_primary_key, primary_key), ' ', '')")}, ',', '|') AS staging_key,
       coalesce(stg_primary_key IS NOT NULL AND
                {_SIZE.format(c='primary_key')} <> {_SIZE.format(c='stg_primary_key')}, false)
         AS lengths_differ
FROM ctl""",
    "control_effective_key": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT schema_name, table_name,
       {_SNAKE.format(x="replace(coalesce(stg_primary_key, primary_key), ' ', '')")} AS staging_key
FROM ctl""",
    "page_control": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT * FROM ctl ORDER BY schema_name, table_name LIMIT 20 OFFSET 60""",
    "init_databases": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT 'c_loading' AS database UNION SELECT 'r_' || lower(schema_name) FROM ctl WHERE active
UNION SELECT 's_' || lower(schema_name) FROM ctl WHERE active""",
    "list_control": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT *, (SELECT count(*) FROM ctl) AS total_results FROM ctl ORDER BY schema_name, table_name LIMIT 20 OFFSET 60""",
    "list_log": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS source_table_name, 't' || o_orderkey AS target_table_name,
  CAST(o_custkey AS BIGINT) AS movements, CAST(ceil((SELECT count(*) FROM orders) / 30.0) AS BIGINT) AS total_pages
FROM orders ORDER BY o_orderdate DESC, target_table_name LIMIT 30 OFFSET 210""",
    "set_active_stored": f"""WITH {CONTROL_FROM_CUSTOMER_SQL}
SELECT schema_name, table_name, CASE table_name WHEN (SELECT arg_min(c_name, c_custkey) FROM customer) THEN false
  WHEN (SELECT arg_max(c_name, c_custkey) FROM customer) THEN true ELSE active END AS active FROM ctl""",
    "page_ties": "SELECT * FROM events",
    "page_large": "SELECT * FROM lineitem ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 50000",
    "page_log": _PAGE_EVENTS.format(off=50),
    "page_all": "SELECT * FROM events",
    "page_deep": _PAGE_EVENTS.format(off=7500),
    "page_info": ("SELECT 2 AS page, 25 AS page_length, CAST(ceil(count(*) / 25.0) AS BIGINT) "
                  "AS total_pages, count(*) AS total_results FROM events"),
    "decode_typed": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_nationkey, c_mktsegment,
  c_acctbal > 0 AS c_positive FROM customer""",
    "key_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "key_duplicates_ranged": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "null_violations": """SELECT count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS null_o_orderkey,
  CAST(0 AS BIGINT) AS null_o_custkey,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS null_o_orderdate FROM orders""",
}


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: a day's change window of orders, named like a source system,
    staged (snake_case, key renamed to ``id``) and upserted into the rows
    staged before."""
    ensure_checkpoint_dir(spark)
    d = "/root/testdata/sf0.001"
    src = _read(spark, d, "orders").withColumnsRenamed(ORDERS_PASCAL)
    older = stage_frame(src, None, ["order_key"], ["id"])
    batch = src.where(render_filter("OrderDate >= :start_date", RUN_DATE)) \
               .withColumn("OrderStatus", F.lit("X"))
    staged = stage_frame(batch, None, ["order_key"], ["id"])
    return upsert(older, staged, ["id"], source_rows=staged.count())


def _reachable(spark: SparkSession) -> None:
    """Python workers import this repository as the driver does, whatever the
    folder they start in. (On a cluster, submit it with ``--py-files``.)"""
    env = spark.sparkContext.environment
    here = os.path.dirname(os.path.abspath(__file__))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([here, *paths])


def _llm():
    """The queries module of the ``llm`` subpackage, or None where the
    subpackage and ``corpus_pipeline.py`` were left out."""
    for name in ("landfall.llm", "corpus_pipeline"):
        if importlib.util.find_spec(name) is None:
            return None
    return importlib.import_module("landfall.llm.queries")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            _reachable(spark)
            return fn(spark, sf_dir.rstrip("/"))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    llm = _llm()
    return {k: wrap(v) for k, v in (_QUERIES | (llm.queries() if llm else {})).items()}


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return _ORACLE | (llm.oracle_sql() if llm else {})
