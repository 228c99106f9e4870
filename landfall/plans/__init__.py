from .audit import IngestionFailed, LogRecord, Place, append_log, log_frame
from .bootstrap import control_table_name, init, log_table_name
from .control import (CONTROL_KEY, CONTROL_SCHEMA, LOG_SCHEMA, active_for_land, active_for_stage,
                      active_schemas, control_frame, control_problems, create_control_table,
                      create_log_table, key_lists, seed_control, set_active, set_flag)
from .land import land, land_table
from .listing import activate, deactivate, list_control, list_log, table_info
from .load import LoadResult, load_into
from .stage import stage, stage_frame, stage_route

__all__ = [
    "IngestionFailed", "LogRecord", "Place", "append_log", "log_frame",
    "control_table_name", "init", "log_table_name",
    "CONTROL_KEY", "CONTROL_SCHEMA", "LOG_SCHEMA", "active_for_land", "active_for_stage",
    "active_schemas", "control_frame", "control_problems", "create_control_table",
    "create_log_table", "key_lists", "seed_control", "set_active", "set_flag",
    "land", "land_table", "activate", "deactivate", "list_control", "list_log", "table_info",
    "LoadResult", "load_into", "stage", "stage_frame", "stage_route",
]
