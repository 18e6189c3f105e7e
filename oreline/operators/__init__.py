from oreline.operators.changes import (
    drop_deletes,
    in_window,
    latest_per_key,
    read_changes,
    require_key,
    silver_changes,
    strip_columns,
)
from oreline.operators.upsert import check_not_null, duplicate_keys, upsert

__all__ = [
    "check_not_null",
    "drop_deletes",
    "duplicate_keys",
    "in_window",
    "latest_per_key",
    "read_changes",
    "require_key",
    "silver_changes",
    "strip_columns",
    "upsert",
]
