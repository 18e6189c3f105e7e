"""A training corpus from raw documents: five stages, each a table that the next one reads.

Every stage works on all that its predecessor kept, and is re-run alone from the stored table if it
fails. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oreline.llm.common import bitmap, row_key, sift, staged, table, without  # noqa: E402
from oreline.llm.decontaminate import benchmark_matches  # noqa: E402
from oreline.llm.language_id import identify  # noqa: E402
from oreline.llm.line_dedup import dedup_lines  # noqa: E402
from oreline.llm.mixing import mix_sources  # noqa: E402
from oreline.llm.near_join import near_duplicates  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; what is no language, or has no text, goes."""
    judged = identify(docs, F.col("text"), F.col("lang"), F.col("lang"), F.col("source"))
    rejected = judged.where("not keep").select(F.col("row").alias("__row"))
    rows = docs.withColumn("__row", row_key("doc_id", "text"))
    return without(rows, "__row", rejected).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier in the corpus; one that only had such lines goes."""
    cleaned = dedup_lines(docs)
    emptied = "n_exact + n_near > 0 and n_exact + n_near = n_lines"
    return cleaned.where(f"not ({emptied})").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows are told apart by their id and text, as an id may be null or stand on several texts. Of rows that agree in
    both, one stays if it has words.
    """
    rows = docs.withColumn("__row", row_key("doc_id", "text"))
    linked = staged(near_duplicates(rows, id_col="__row"), "linked")
    ids = rows.select("__row", "doc_id").distinct()
    first = (
        linked.distinct()
        .join(ids, "__row")
        .groupBy("component_id")
        .agg(F.expr("min(struct(doc_id is null, doc_id, __row)).__row").alias("__first"))
    )
    copies = linked.join(first, "component_id").where("__row <> __first").select("__row")
    again = linked.where("n_shingles > 0").groupBy("__row").count().where("count > 1").select("__row")
    kept = without(rows, "__row", staged(copies, "copies"))
    maybe, surely = sift(kept, "__row", bitmap(again, "__row"))
    repeated = maybe.join(again, "__row", "left_semi").dropDuplicates(["__row"])
    single = maybe.join(again, "__row", "left_anti")
    return surely.unionByName(single).unionByName(repeated).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows are told apart by their id and text."""
    rows = docs.withColumn("__row", row_key("doc_id", "text"))
    leaks = benchmark_matches(rows, table(spark, sf_dir, "benchmark"), id_col="__row").select("__row")
    return without(rows, "__row", staged(leaks, "leaks")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mix_sources(docs)


STAGES = [("language", language), ("lines", lines), ("near", near), ("benchmark", benchmark), ("mixture", mixture)]

#: The language model, edit-distance search and parity sketches have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
