"""Spark session defaults shared by every job."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Zone is pinned so that event dates, run windows and report dates agree no
# matter where the driver runs. Sizes are left to AQE: a fixed shuffle width
# that suits a laptop is wrong on a cluster and the other way round.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Staged inputs have exact sizes; below this one goes to every executor
    # instead of the other side being shuffled.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, conf: dict[str, str] | None = None, hive: bool = False) -> SparkSession:
    """Create (or get) a session with the library's defaults.

    ``hive=True`` binds the session to the metastore the cluster is configured
    with, so that the layer tables outlive the application.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Pin a session made elsewhere to UTC, which all date logic assumes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
