"""Listing the control and log tables page by page, and switching tables on/off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.paging import page, page_info
from ..sources.tables import Zones, footer_table
from .bootstrap import control_table_name, log_table_name
from .control import set_active

# Sort orders of the two listings.
CONTROL_ORDER = ["schema_name", "table_name"]
LOG_ORDER = ["ingestion_date DESC", "target_catalog_name", "target_schema_name",
             "target_table_name"]


def table_info(spark: SparkSession, name: str, page_no: int, page_length: int) -> DataFrame:
    """One-row page information of a table, its count taken from the Parquet
    footers (a partitioned table's from its scan)."""
    df = footer_table(spark, name)
    return page_info(spark.table(name) if df is None else df, page_no, page_length)


def list_control(spark: SparkSession, page_no: int, page_length: int, *,
                 zones: Zones = Zones(),
                 select: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of the page, one-row page info) for the control table;
    ``select`` narrows the columns."""
    name = control_table_name(zones)
    return (page(spark.table(name), CONTROL_ORDER, page_no, page_length, select=select),
            table_info(spark, name, page_no, page_length))


def list_log(spark: SparkSession, page_no: int, page_length: int, *,
             zones: Zones = Zones(),
             select: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of the page, one-row page info) for the log, newest first;
    ``select`` narrows the columns."""
    name = log_table_name(zones)
    return (page(spark.table(name), LOG_ORDER, page_no, page_length, select=select),
            table_info(spark, name, page_no, page_length))


def activate(spark: SparkSession, schema_name: str, table_name: str, *,
             zones: Zones = Zones(), root: str | None = None) -> None:
    set_active(spark, control_table_name(zones), schema_name, table_name, True, root)


def deactivate(spark: SparkSession, schema_name: str, table_name: str, *,
               zones: Zones = Zones(), root: str | None = None) -> None:
    set_active(spark, control_table_name(zones), schema_name, table_name, False, root)
