from oreline.streaming.bronze import append_bronze, run_until_stopped
from oreline.streaming.progress import BatchProgress, read_progress

__all__ = ["BatchProgress", "append_bronze", "read_progress", "run_until_stopped"]
