"""Upsert as a DataFrame operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COPIES = "_source_copies"
_IN_SOURCE = "_in_source"
_SOURCE_VERSION = "_source_version"


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several rows share, with how many. NULL keys match nothing, so
    they are never duplicates."""
    counted = df.filter(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job, while it runs, on a NULL in any of ``columns``.

    Parquet does not enforce NOT NULL; this makes the declared constraint hold
    without a pass of its own.
    """
    for column in columns:
        failed = F.raise_error(F.lit(f"NULL in NOT NULL column {column}")).cast(df.schema[column].dataType)
        df = df.withColumn(column, F.coalesce(F.col(column), failed))
    return df


def _one_per_key(source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    if null_safe:
        return source.dropDuplicates(list(keys))
    # NULL keys match nothing and are all inserted; keeping them out of the
    # shuffle also keeps them from piling up in one partition.
    nulls = _any_null(keys)
    return source.filter(~nulls).dropDuplicates(list(keys)).unionByName(source.filter(nulls))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    match_also: Sequence[str] = (),
    on_duplicate: str = "error",
    null_safe: bool = False,
    evolve: bool = False,
    guard: str | None = None,
    delete_when: Column | None = None,
    null_keys: bool = True,
    few: bool = False,
) -> DataFrame:
    """The rows ``target`` holds after ``source`` has been merged into it.

    A target row whose ``keys`` + ``match_also`` equal those of a source row
    takes all columns of the source; other target rows stay; source rows that
    match nothing are inserted. A NULL key equals nothing, unless ``null_safe``.

    ``on_duplicate``: ``"error"`` fails, while the result is computed, if several
    source rows match a target row; ``"keep_any"`` first reduces the source to
    one row per key; ``"trust"`` skips the check for a source known to be unique.
    ``evolve=True`` accepts source columns the target lacks. ``guard`` names a
    version column: a target row is replaced only by a newer source row.
    ``delete_when`` is a condition on source rows: those remove their key.

    ``null_keys=False`` says that the target has no NULL keys to speak of. It is
    a hint about skew, not a promise: the result is the same either way. ``few=True`` says that
    the keys of the source can be sent to every task, which the planner does not see of what is joined from them.

    The source is read twice (its keys, then its rows); stage it first if it is
    costly, as ``upsert_table`` does.
    """
    match = [*keys, *match_also]
    extra = [c for c in source.columns if c not in target.columns]
    if delete_when is not None:
        source = source.withColumn("_delete", F.coalesce(delete_when, F.lit(False)))
        if "_op" in extra:
            source = source.drop("_op")
            extra.remove("_op")
    if extra and not evolve:
        raise ValueError(f"source columns missing from the target: {extra}; pass evolve=True to add them")

    if on_duplicate == "keep_any":
        source = _one_per_key(source, match, null_safe)
    elif on_duplicate not in ("error", "trust"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    counted = on_duplicate == "error"

    missing = [c for c in target.columns if c not in source.columns]
    kept = _kept(target, source, match, null_safe, counted, guard, null_keys and not null_safe)
    written = _newer(target, source, match, null_safe, guard, few) if guard is not None else source
    if missing:
        written = _carry(target, written, match, missing, null_safe)
    merged = kept.unionByName(written, allowMissingColumns=True)

    if delete_when is not None:
        merged = merged.filter(~F.coalesce(F.col("_delete"), F.lit(False))).drop("_delete")
    return merged.select(*target.columns, *extra)


def _source_keys(
    source: DataFrame, match: Sequence[str], null_safe: bool, counted: bool = False, version: str | None = None
) -> DataFrame:
    """Key columns of the source as ``_k0, _k1, ...``, with row counts or the
    version on request."""
    keys = source if null_safe else source.filter(~_any_null(match))
    names = [F.col(c).alias(f"_k{i}") for i, c in enumerate(match)]
    extra = [F.col(version).alias(_SOURCE_VERSION)] if version else []
    keys = keys.select(*names, *extra)
    if counted:
        newest = [F.max(_SOURCE_VERSION).alias(_SOURCE_VERSION)] if version else []
        keys = keys.groupBy(*[f"_k{i}" for i in range(len(match))]).agg(
            F.count(F.lit(1)).alias(_COPIES), *newest
        )
    return keys


def _on_keys(match: Sequence[str], null_safe: bool) -> Column:
    return _all(
        F.col(c).eqNullSafe(F.col(f"_k{i}")) if null_safe else F.col(c) == F.col(f"_k{i}")
        for i, c in enumerate(match)
    )


def _ambiguous() -> Column:
    return F.raise_error(F.lit("several source rows match the same target row")).cast("boolean")


def _not_older(version: str) -> Column:
    """Whether a target row's version holds against the matching source row's."""
    return F.col(_SOURCE_VERSION).isNull() | F.coalesce(F.col(version) >= F.col(_SOURCE_VERSION), F.lit(False))


def _kept(
    target: DataFrame,
    source: DataFrame,
    match: Sequence[str],
    null_safe: bool,
    counted: bool,
    version: str | None,
    bypass: bool,
) -> DataFrame:
    """Target rows that no source row replaces.

    Only the source's keys take part, so for a small source they are broadcast
    and the target is neither shuffled nor sorted. With ``bypass`` target rows
    that have a NULL key go around the join, which would send all of them to one
    partition; that reads the target twice, the second time pruned to the row
    groups that have such rows.
    """
    keys = _source_keys(source, match, null_safe, counted, version)
    candidates = target.filter(~_any_null(match)) if bypass else target
    on = _on_keys(match, null_safe)
    if counted or version:
        keys = keys.withColumn(_IN_SOURCE, F.lit(True))
        stays = F.col(_IN_SOURCE).isNull()
        if version:
            stays = stays | _not_older(version)
        if counted:
            stays = F.when(F.col(_COPIES) > 1, _ambiguous()).otherwise(stays)
        kept = candidates.join(keys, on, "left").filter(stays).select(*target.columns)
    else:
        kept = candidates.join(keys, on, "left_anti")
    # NULL branch first: a union only reports the partitioning its children share
    # (which spares a bucketed table its shuffle) if the first child's key is
    # nullable like the union's own.
    return target.filter(_any_null(match)).unionByName(kept) if bypass else kept


def _newer(
    target: DataFrame, source: DataFrame, match: Sequence[str], null_safe: bool, version: str, few: bool
) -> DataFrame:
    """Source rows that no target row of the same or a higher version holds off.

    Looked up from the target's side (keys and version only), so that the source
    is what gets broadcast when it is small.
    """
    versions = _source_keys(source, match, null_safe, version=version)
    holds = (
        target.select(*match, version)
        .join(versions, _on_keys(match, null_safe), "inner")
        .filter(_not_older(version))
    )
    stale = holds.select(*[F.col(f"_k{i}") for i in range(len(match))])
    if few:
        stale = F.broadcast(stale)  # keys of the source, as far as the target has them
    return source.join(stale, _on_keys(match, null_safe), "left_anti")


def _carry(
    target: DataFrame, source: DataFrame, match: Sequence[str], missing: Sequence[str], null_safe: bool
) -> DataFrame:
    """Source rows, with the columns only the target has taken from the matched row."""
    t = target.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(match)], *[F.col(c).alias(f"_t_{c}") for c in missing]
    )
    carried = source.join(t, _on_keys(match, null_safe), "left")
    return carried.select(*source.columns, *[F.col(f"_t_{c}").alias(c) for c in missing])
