"""Init: control database, control table and its seeds, log table, zone databases."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession

from ..functions.naming import pascal_to_snake
from ..sources.tables import Zones, create_database, database, qualified
from .control import active_schemas, create_log_table, seed_control

CONTROL_SCHEMA_NAME = "loading"
CONTROL_TABLE = "data_ingestion"
LOG_TABLE = "data_ingestion_log"


def control_table_name(zones: Zones = Zones()) -> str:
    return qualified(zones.ctr, CONTROL_SCHEMA_NAME, CONTROL_TABLE)


def log_table_name(zones: Zones = Zones()) -> str:
    return qualified(zones.ctr, CONTROL_SCHEMA_NAME, LOG_TABLE)


def init(spark: SparkSession, seeds: Iterable[Mapping | Sequence], *, zones: Zones = Zones(),
         root: str | None = None) -> list[str]:
    """Create what the run needs; returns the zone databases created/ensured.

    Seeds are inserted only where their key is missing. Zone databases: for
    every schema with an active table, one raw database (name as is) and one
    staging database (snake_case)."""
    create_database(spark, database(zones.ctr, CONTROL_SCHEMA_NAME), root)
    seed_control(spark, control_table_name(zones), seeds, root)
    create_log_table(spark, log_table_name(zones), root)
    control = spark.table(control_table_name(zones))
    made = []
    for row in active_schemas(control).collect():  # distinct schema names only
        for db in (database(zones.raw, row["schema_name"]),
                   database(zones.stg, pascal_to_snake(row["schema_name"]))):
            create_database(spark, db, root)
            made.append(db)
    return made
