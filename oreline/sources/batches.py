"""Batches of a log, and which of them a consumer has yet to take.

Every micro-batch owns the folders that carry its label: the id of its stream's checkpoint and its
number. Numbers of one checkpoint only grow, so one high-water mark per checkpoint says what was taken,
whatever event dates a batch wrote to.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from oreline import paths
from oreline.sources.tables import partition_values, read_table
from oreline.spec import BATCH, EVENT_DATE, EntitySpec

COMPACTED = "compacted"

Folder = tuple[str, str]


def split_label(batch: str) -> tuple[str, int] | None:
    """(checkpoint id, number) of a batch label; None for folded batches and labels of another kind."""
    run, dash, number = batch.rpartition("-")
    return (run, int(number)) if dash and number.isdigit() else None


def batch_folders(spark: SparkSession, path: str, days: Iterable[str] | None = None) -> list[Folder]:
    """(event date, batch) of every folder of the log; of some days, as the folders name them, if given."""
    if days is None:
        days = partition_values(spark, path, EVENT_DATE)
    names = [f"{EVENT_DATE}={day}" for day in days]
    below = paths.side_by_side(lambda name: paths.child_dirs(spark, f"{path}/{name}"), names)
    prefix = f"{BATCH}="
    return [
        (name.partition("=")[2], batch.removeprefix(prefix))
        for name, batches in zip(names, below)
        for batch in batches
        if batch.startswith(prefix)
    ]


def last_commit(spark: SparkSession, checkpoint: str) -> tuple[str, int] | None:
    """(id, number of the last batch that is committed) of a stream's checkpoint; None without one.

    A batch is written before it is committed, folder after folder: until then a reader may see part of it.
    """
    if "metadata" not in paths.child_files(spark, checkpoint):
        return None
    run = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    numbers = [int(name) for name in paths.child_files(spark, f"{checkpoint}/commits") if name.isdigit()]
    return run, max(numbers, default=-1)


def unseen(folders: Iterable[Folder], marks: Mapping[str, int], commit: tuple[str, int] | None) -> list[Folder]:
    """Folders of batches above their checkpoint's mark that are committed.

    Folded batches count on the first run only, when there are no marks: later only seen ones are folded.
    Batches of other checkpoints than the current one are taken as complete.
    """
    picked = []
    for day, batch in folders:
        label = split_label(batch)
        if label is None:
            if not marks:
                picked.append((day, batch))
            continue
        run, number = label
        if number > marks.get(run, -1) and not (commit and run == commit[0] and number > commit[1]):
            picked.append((day, batch))
    return picked


def highest(folders: Iterable[Folder]) -> dict[str, int]:
    """The marks that having taken these folders sets."""
    marks: dict[str, int] = {}
    for _, batch in folders:
        if label := split_label(batch):
            marks[label[0]] = max(label[1], marks.get(label[0], -1))
    # Without any, as after a log that is all folded, a mark of no checkpoint says that there was a run.
    return marks or {"": 0}


def read_batches(spark: SparkSession, path: str, entity: EntitySpec, folders: Iterable[Folder]) -> DataFrame:
    """Rows of some folders of the log; nothing else of it is listed or opened."""
    picked = [f"{path}/{EVENT_DATE}={day}/{BATCH}={batch}" for day, batch in folders]
    return read_table(spark, path, schema=entity.bronze_schema, folders=picked)
