"""Change-event envelope -> flat bronze columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.spec import BEFORE_KEY, ENVELOPE_META, EVENT_DATE, IMAGE, EntitySpec

_KAFKA_COLUMNS = ("topic", "partition", "offset", "timestamp")
_MS_PER_DAY = 86_400_000


def _message_schema(after: T.StructType, meta: Sequence[str], before: T.StructType | None) -> T.StructType:
    # Only what is selected is declared: the JSON reader skips undeclared
    # members without building them, so the unused "before" image (half of
    # most messages) costs a token skip instead of a row.
    payload = [T.StructField("after", after)]
    payload += [T.StructField(name, ENVELOPE_META[name]) for name in meta]
    if before is not None:
        payload.append(T.StructField("before", before))
    return T.StructType([T.StructField("payload", T.StructType(payload))])


def decode_envelope(
    df: DataFrame,
    after_schema: T.StructType,
    columns: Sequence[str] | None = None,
    meta: Sequence[str] = ("op", "ts_ms"),
    before_key: str | None = None,
    before_image: bool = False,
    image: bool = False,
) -> DataFrame:
    """Parse ``value`` and flatten it.

    ``columns=None`` takes every field of the ``after`` image in schema order; a
    list takes just those (and parses just those). Envelope fields named in
    ``meta`` come out with a leading underscore, stream columns with a
    ``_kafka_`` prefix. The ``before`` image is skipped unless asked for:
    ``before_key`` keeps one field of it as ``_before_key``, ``before_image`` all of
    it as the struct ``_before``. ``image`` keeps the whole ``after`` image, undeclared
    members included, as the VARIANT ``_image``. A value that is not a decodable envelope yields a row
    whose decoded columns are all NULL; nothing is dropped here.
    """
    after = after_schema if columns is None else T.StructType([after_schema[c] for c in columns])
    before = after_schema if before_image else T.StructType([after_schema[before_key]]) if before_key else None
    schema = _message_schema(after, meta, before)
    parsed = df.select(
        *[F.col(c).alias(f"_kafka_{c}") for c in _KAFKA_COLUMNS],
        F.from_json(F.col("value").cast("string"), schema).alias("msg"),
        *([row_image(F.col("value").cast("string")).alias(IMAGE)] if image else []),
    )
    extra = [F.col(f"msg.payload.before.{before_key}").alias(BEFORE_KEY)] if before_key else []
    if before_image:
        extra.append(F.col("msg.payload.before").alias("_before"))
    if image:
        extra.append(F.col(IMAGE))
    return parsed.select(
        *[F.col(f"msg.payload.{m}").alias(f"_{m}") for m in meta],
        *[F.col(f"_kafka_{c}") for c in _KAFKA_COLUMNS],
        *extra,
        F.col("msg.payload.after.*"),
    )


def row_image(value: Column) -> Column:
    """The ``after`` image of an envelope as it is; NULL if there is none or the text is no JSON."""
    found = F.try_variant_get(F.try_parse_json(value), "$.payload.after", "variant")
    return F.when(~F.is_variant_null(found), found)


def image_columns(df: DataFrame, columns: T.StructType) -> DataFrame:
    """Add members of the stored image as columns; a member that is missing or of another type is NULL.

    How a column that the source gained before it was declared is taken from rows landed meanwhile.
    """
    members = {f.name: F.try_variant_get(IMAGE, f"$.{f.name}", f.dataType.simpleString()) for f in columns.fields}
    return df.withColumns(members)


def event_date(ts_ms: Column) -> Column:
    """UTC day of an epoch-millisecond column, whatever the session zone is.

    Day arithmetic instead of a timestamp round trip: no zone lookup, and a
    corrupt out-of-range value becomes NULL instead of failing the batch.
    """
    return F.date_from_unix_date(F.floor(ts_ms / _MS_PER_DAY).try_cast("int"))


def with_event_date(df: DataFrame, ts_ms: str = "_ts_ms") -> DataFrame:
    return df.withColumn(EVENT_DATE, event_date(F.col(ts_ms)))


def stamp(df: DataFrame, column: str) -> DataFrame:
    """Add the processing time; one value per query or micro-batch."""
    return df.withColumn(column, F.current_timestamp())


def to_bronze(df: DataFrame, entity: EntitySpec) -> DataFrame:
    """Stream records -> bronze rows of ``entity`` (works on batch and stream)."""
    decoded = decode_envelope(
        df,
        entity.after_schema,
        meta=entity.meta,
        before_key=entity.key if entity.before_key else None,
        image=entity.image,
    )
    return with_event_date(stamp(decoded, "_ingested_at"))


def undecodable(df: DataFrame) -> DataFrame:
    """Bronze rows whose value was a tombstone or not a change envelope."""
    return df.filter(F.col("_op").isNull())
