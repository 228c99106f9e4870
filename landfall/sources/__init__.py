from .jdbc import (ANSI, DERBY, SQLSERVER, Dialect, JdbcConnection, JdbcTable, catalog_table,
                   dialect_for, register_catalog)
from .tables import (Zones, create_database, create_empty_table, database, expire_snapshots,
                     qualified, read_table,
                     register_snapshot, snapshot_path, stage_batch, table_exists, write_batch,
                     write_snapshot)

__all__ = [
    "ANSI", "DERBY", "SQLSERVER", "Dialect", "JdbcConnection", "JdbcTable", "catalog_table",
    "dialect_for", "register_catalog",
    "Zones", "create_database", "create_empty_table", "database", "expire_snapshots", "qualified",
    "read_table",
    "register_snapshot", "snapshot_path", "stage_batch", "table_exists", "write_batch",
    "write_snapshot",
]
