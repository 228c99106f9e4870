from .dates import (PLACEHOLDER, ansi_date_literal, derby_date_literal, filter_column,
                    parse_run_date,
                    render_filter, spark_date_literal, sqlserver_date_literal, start_date,
                    start_date_col)
from .decode import as_text, decode_typed, decode_value
from .lists import split_list, split_list_col, staging_key, staging_key_col
from .naming import pascal_to_snake, snake_case

__all__ = [
    "PLACEHOLDER", "ansi_date_literal", "derby_date_literal", "filter_column", "parse_run_date",
    "render_filter",
    "spark_date_literal", "sqlserver_date_literal", "start_date", "start_date_col",
    "as_text", "decode_typed", "decode_value",
    "split_list", "split_list_col", "staging_key", "staging_key_col",
    "pascal_to_snake", "snake_case",
]
