from oreline.sinks.catalog import ensure_database, ensure_table
from oreline.sinks.maintenance import compact, compact_log
from oreline.sinks.tables import lookup, upsert_table, write_table

__all__ = ["compact", "compact_log", "ensure_database", "ensure_table", "lookup", "upsert_table", "write_table"]
