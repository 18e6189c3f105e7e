"""Change-event stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.spec import STREAM_RECORD, EntitySpec


def kafka_options(entity: EntitySpec, bootstrap_servers: str | None) -> dict[str, str]:
    """Options of the Kafka source; the entity's own options come last and win.

    A batch is decoded by one task per topic partition. Where a topic has fewer
    partitions than the cluster has cores, put ``minPartitions`` there.
    """
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is required for the kafka source")
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": entity.topic,
        "groupIdPrefix": f"bronze-{entity.name}",
        "startingOffsets": entity.starting_offsets,
        "maxOffsetsPerTrigger": str(entity.max_per_trigger),
        "failOnDataLoss": str(entity.fail_on_data_loss).lower(),
        **entity.options,
    }


def read_cdc_stream(
    spark: SparkSession,
    entity: EntitySpec,
    fmt: str = "kafka",
    path: str | None = None,
    bootstrap_servers: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of change records of one entity.

    ``fmt="kafka"`` subscribes to the entity's topic. Any file format reads a
    folder of files that hold the same five columns (an archived topic, or the
    stand-in used by the tests); its intake is limited in files, not offsets.
    """
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(entity, bootstrap_servers)).load()

    if not path:
        raise ValueError(f"path is required for the {fmt} source")
    reader = (
        spark.readStream.format(fmt)
        .schema(STREAM_RECORD)
        .option("ignoreMissingFiles", str(not entity.fail_on_data_loss).lower())
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def drop_redelivered(records: DataFrame, within: str = "1 hour") -> DataFrame:
    """The first of several records with the same stream position that arrive within a time of each other.

    Positions are kept in the state store, by arrival: an old event that arrives for the first time is never
    late, and a position is forgotten when ``within`` has passed since it came. The state outlives
    a restart with the same checkpoint. It holds the positions of that time only, dealt to
    ``spark.sql.shuffle.partitions`` stores, a number that the checkpoint fixes.
    """
    arrived = records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("_arrived")
