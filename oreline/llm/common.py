"""What several operators share: staged tables, a bounded pre-filter, connected components."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.paths import scratch_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application.

    What ``--py-files`` does, for sessions started without it. The archive lies in the shared folder.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = f"{scratch_path(spark, 'package')}/{root.name}-package.zip"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
    out.write(bytearray(packed.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)

#: Bits of the pre-filter of ``sift``. It goes to every executor, so its size is fixed: 2^24 bits
#: are at most 2^18 rows of two longs, whatever the input.
SIFT_BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and lets later steps read a result twice without computing it twice. Lost
    executors cost no more than the tasks they ran.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bit(key: str) -> str:
    return f"pmod(xxhash64({key}), {2**SIFT_BITS}L)"


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of hashed keys as rows (word, bits): at most 2^18 rows."""
    return (
        keys.select(F.expr(_bit(key)).alias("__bit"))
        .groupBy(F.expr("shiftright(__bit, 6)").alias("__word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(__bit & 63 as int)))").alias("__bits"))
    )


def sift(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows whose ``key`` may be in the bitmap ``keys``, and rows whose key is surely not.

    A lossless pre-filter: it keeps wide rows that a join would drop anyway out of its shuffle. More
    keys than bits only let more rows through.
    """
    marked = (
        df.withColumn("__bit", F.expr(_bit(key)))
        .withColumn("__word", F.expr("shiftright(__bit, 6)"))
        .join(F.broadcast(keys), "__word", "left")
        .withColumn("__may", F.expr("coalesce(shiftright(__bits, cast(__bit & 63 as int)) & 1, 0) = 1"))
    )
    scratch = ("__bit", "__word", "__bits", "__may")
    return marked.where("__may").drop(*scratch), marked.where("not __may").drop(*scratch)


def row_key(*columns: str):
    """One long for the values of a row: equal rows share it, so that repeated rows share a decision."""
    return F.xxhash64(*columns)


def without(df: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``dropped``; only rows that may go are shuffled."""
    gone = dropped.select(F.col(key)).distinct()
    maybe, surely = sift(df, key, bitmap(gone, key))
    return surely.unionByName(maybe.join(gone, key, "left_anti").select(*df.columns))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, component), the smallest node reachable.

    Every round takes the smallest label among the neighbours, then the label of that label, so the
    rounds grow with the logarithm of a chain's length. Each round is a staged table; the driver sees
    only whether anything changed. A hub is a skewed join key, which AQE splits; minima are
    pre-aggregated. Nodes without links do not appear.
    """
    ends = links.select("a", "b").where("a <> b")
    edges = staged(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels"
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        rounds = staged(
            hooked.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("component")), "labels"
        )
        moved = rounds.where("old <> component").limit(1).count()
        labels = rounds.select("node", "component")
        if not moved:
            return labels
