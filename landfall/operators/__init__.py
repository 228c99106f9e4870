from .columns import (apply, chain, drop_column, rename_columns, rename_positional, scan,
                      select_listed, snake_case_columns, where_filter)
from .paging import page, page_info, total_order
from .upsert import (align_to_target, extra_columns, merge_action_counts, merge_actions,
                     normalize_keys, small_side, upsert)
from .validate import (KeyViolation, any_null, assert_not_null, assert_unique, duplicate_keys, duplicate_keys_ranged,
                       key_length_mismatches, null_violations)

__all__ = [
    "apply", "chain", "drop_column", "rename_columns", "rename_positional", "scan",
    "select_listed", "snake_case_columns", "where_filter",
    "page", "page_info", "total_order",
    "align_to_target", "extra_columns", "merge_action_counts", "merge_actions", "normalize_keys", "small_side",
    "upsert",
    "KeyViolation", "any_null", "assert_not_null", "assert_unique", "duplicate_keys",
    "duplicate_keys_ranged",
    "key_length_mismatches", "null_violations",
]
