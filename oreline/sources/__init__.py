from oreline.sources.streams import read_cdc_stream
from oreline.sources.tables import read_table, register_views

__all__ = ["read_cdc_stream", "read_table", "register_views"]
