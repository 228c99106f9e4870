"""Control table (what to ingest, how) and its operations.

The control table is small metadata; its operations are still written as
DataFrame plans over the whole table (filter, project, distinct, keyed flag
update), so they hold for any size and keep the same shape as the data path.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

from ..functions.lists import split_list_col, staging_key_col
from ..operators.validate import key_length_mismatches
from ..sources.tables import create_empty_table, write_snapshot

# The control table's columns, in declaration order.
CONTROL_SCHEMA = StructType([
    StructField("schema_name", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("primary_key", StringType(), False),
    StructField("stg_primary_key", StringType(), True),
    StructField("active", BooleanType(), False),
    StructField("filter", StringType(), True),
    StructField("selected", StringType(), True),
    StructField("partition_column", StringType(), True),
    StructField("num_partitions", IntegerType(), True),
])
CONTROL_KEY = ["schema_name", "table_name"]

# The log table's columns, in declaration order.
LOG_SCHEMA = StructType([
    StructField("ingestion_date", TimestampType(), True),
    StructField("source_catalog_name", StringType(), True),
    StructField("source_schema_name", StringType(), False),
    StructField("source_table_name", StringType(), False),
    StructField("target_catalog_name", StringType(), True),
    StructField("target_schema_name", StringType(), True),
    StructField("target_table_name", StringType(), True),
    # bigint, not int: one table's batch can exceed 2^31 rows at scale
    StructField("movements", LongType(), True),
    StructField("error", StringType(), True),
])
LOG_KEY = ["target_catalog_name", "target_schema_name", "target_table_name", "ingestion_date"]

# What each step takes from a control row.
LAND_COLUMNS = ["schema_name", "table_name", "primary_key", "filter", "selected",
                "partition_column", "num_partitions"]
STAGE_COLUMNS = ["schema_name", "table_name", "primary_key", "stg_primary_key", "filter",
                 "selected"]


def control_frame(spark: SparkSession, rows: Iterable[Mapping | Sequence]) -> DataFrame:
    """Control rows (dicts by column name, or tuples in schema order)."""
    names = CONTROL_SCHEMA.fieldNames()
    tuples = [tuple(r.get(n) for n in names) if isinstance(r, Mapping) else tuple(r)
              for r in rows]
    return spark.createDataFrame(tuples, CONTROL_SCHEMA)


def active_rows(control: DataFrame, flag: str = "active") -> DataFrame:
    return control.where(F.col(flag))


def active_for_land(control: DataFrame) -> DataFrame:
    """Active rows with what the landing step needs."""
    return active_rows(control).select(*LAND_COLUMNS)


def active_for_stage(control: DataFrame) -> DataFrame:
    """Active rows with what the staging step needs."""
    return active_rows(control).select(*STAGE_COLUMNS)


def active_schemas(control: DataFrame, schema_col: str = "schema_name",
                   flag: str | Column = "active") -> DataFrame:
    """Distinct schemas that have at least one active table. The filter runs
    before the projection and the dedup, so a schema with both active and
    inactive tables is kept."""
    cond = F.col(flag) if isinstance(flag, str) else flag
    return control.where(cond).select(schema_col).distinct()


def key_lists(control: DataFrame) -> DataFrame:
    """Key and column lists as arrays, plus the effective staging key."""
    return control.select(
        *CONTROL_KEY,
        split_list_col("primary_key").alias("primary_key_list"),
        split_list_col("stg_primary_key").alias("stg_primary_key_list"),
        split_list_col("selected").alias("selected_list"),
        staging_key_col().alias("staging_key"),
    )


def set_flag(df: DataFrame, key_values: Mapping[str, object], flag: str,
             value: bool) -> DataFrame:
    """Keyed update of one boolean column: rows whose key columns equal
    ``key_values`` get ``value``; the others keep theirs. No match is fine."""
    match = None
    for k, v in key_values.items():
        cond = F.col(k) == F.lit(v)
        match = cond if match is None else (match & cond)
    new = F.when(match, F.lit(value)).otherwise(F.col(flag))
    return df.withColumn(flag, new.cast("boolean"))


def set_active(spark: SparkSession, control_table: str, schema_name: str, table_name: str,
               active: bool, root: str | None = None) -> None:
    """Switch ingestion of one table on or off (new control snapshot)."""
    updated = set_flag(spark.table(control_table),
                       {"schema_name": schema_name, "table_name": table_name}, "active", active)
    write_snapshot(spark, updated, control_table, root)


def create_control_table(spark: SparkSession, name: str, root: str | None = None) -> bool:
    return create_empty_table(spark, name, CONTROL_SCHEMA, root)


def create_log_table(spark: SparkSession, name: str, root: str | None = None) -> bool:
    return create_empty_table(spark, name, LOG_SCHEMA, root)


def seed_control(spark: SparkSession, name: str,
                 rows: DataFrame | Iterable[Mapping | Sequence],
                 root: str | None = None) -> int:
    """Insert the seed rows whose ``(schema_name, table_name)`` is missing.
    Existing rows (and their ``active`` flags) are left as they are, so seeding
    is safe to repeat and completes a half-seeded table."""
    create_control_table(spark, name, root)
    current = spark.table(name)
    seeds = rows if isinstance(rows, DataFrame) else control_frame(spark, rows)
    seeds = seeds.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields])
    missing = seeds.join(current.select(*CONTROL_KEY), CONTROL_KEY, "left_anti")
    if missing.isEmpty():  # stops at the first missing row
        return 0
    obs = Observation(f"landfall_seed_{uuid.uuid4().hex[:8]}")
    write_snapshot(spark, current.unionByName(missing.observe(obs, F.count(F.lit(1)).alias("n"))),
                   name, root)
    return int(obs.get.get("n", 0))


def control_problems(control: DataFrame) -> DataFrame:
    """Rows that would fail later: key lists of unequal length."""
    return key_length_mismatches(control)
