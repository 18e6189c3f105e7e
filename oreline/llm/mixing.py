"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

1. Sources get targets in words: shares by weight of the words there are, none above ``max_repeat``
   times its size, the excess reshared by weight.
2. Inside a source a document's expected number of copies follows its weight (1 divided by the number
   of rows with the same text, so a text that was copied a thousand times is not mixed in a thousand
   times as often), scaled to meet the target, none above ``max_repeat``.
3. The whole part of that number is taken for certain. Its fraction p is an inclusion probability:
   documents are ranked by u / (1 - u) divided by p / (1 - p), with u a hash of the id, and taken in
   that order until the source's words are met.

Steps 1 and 2 are the same question: amounts proportional to weights, up to caps, with a given sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import staged

WORDS = r"[^\x20\x09-\x0D]+"
#: Steps of the rank that are summed before any order is made: the rows of a source that meet in one
#: task are those of one step, not those of the source.
RANK_STEPS = 1024


def water_fill(parts: DataFrame, group: list[str], weight: str, cap: str, total: str, out: str) -> DataFrame:
    """Add ``out``: amounts min(cap, level * weight) that sum up to ``total`` in each group.

    If the caps sum up to less, every amount is its cap. Parts are aggregated rows (a source, or a
    source and a weight), in the order in which a rising level fills them.
    """
    w = Window.partitionBy(*group).orderBy(F.expr(f"{cap} / {weight}"), weight, cap)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = F.expr(f"({total} - __full) / __rest")
    return (
        parts.withColumn("__full", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("__rest", F.sum(weight).over(after))
        .withColumn("__level", level)
        # The level is right from the first part that it does not fill; from then on it would only fall.
        .withColumn("__fits", F.expr(f"__level * {weight} <= {cap}"))
        .withColumn("__final", F.max(F.when(F.col("__fits"), F.col("__level"))).over(Window.partitionBy(*group)))
        .withColumn(out, F.expr(f"least({cap}, coalesce(__final * {weight}, {cap}))"))
        .drop("__full", "__rest", "__level", "__fits", "__final")
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    max_repeat: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, source, ``size`` (words), ``source_size``, ``target`` and ``taken``.

    ``taken`` counts the words the mix takes of the document, repeats included: 0 to ``max_repeat``
    times its size. Sources are ordered by code point, null last, and take ``weights`` in turn. A null
    or empty text has size 0 and is never taken; a source without words has target 0. Ties in rank go
    by id, text and row order of equal rows; reruns agree. An empty table gives none. Only the named
    columns are read. A source's taken words fall short of its target by less than one document.
    """
    rows = staged(docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("text_key"),
    ), "sizes")
    copies = rows.groupBy("source", "text_key", "size").agg(F.count("*").alias("copies"))
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: a numbering of aggregated rows, not of documents.
    numbered = by_source.withColumn(
        "__n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    )
    turn = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("__n", F.lit(len(weights))) + 1).cast("int"))
    shares = (
        numbered.withColumn("__weight", turn)
        .withColumn("__cap", F.col("source_size") * float(max_repeat))
        .withColumn("__total", F.sum("source_size").over(Window.partitionBy(F.lit(0))).cast("double"))
        .withColumn("__one", F.lit(0))
    )
    targets = water_fill(shares, ["__one"], "__weight", "__cap", "__total", "target").select(
        "source", "source_size", "target"
    )
    # Expected copies of a document with n equal rows: min(max_repeat, level / n), the same for the class (source, n).
    classes = (
        copies.groupBy("source", "copies")
        .agg(F.sum(F.col("size") * F.col("copies")).cast("double").alias("__words"))
        .where("__words > 0")
        .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("__weight", F.col("__words") / F.col("copies"))
        .withColumn("__cap", F.col("__words") * float(max_repeat))
    )
    rates = water_fill(classes, ["source"], "__weight", "__cap", "target", "__amount").select(
        F.col("source").alias("r_source"), F.col("copies").alias("r_copies"), F.expr("__amount / __words").alias("rate")
    )
    keyed = (
        rows.join(
            copies.select(F.col("source").alias("c_source"), F.col("text_key").alias("c_key"), F.col("size").alias("c_size"), "copies"),
            F.col("source").eqNullSafe(F.col("c_source")) & (F.col("text_key") == F.col("c_key")) & (F.col("size") == F.col("c_size")),
        )
        .join(rates, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("copies") == F.col("r_copies")), "left")
        .select("id", "source", "size", "text_key", F.coalesce("rate", F.lit(0.0)).alias("rate"))
    )
    u = (F.conv(F.substring(F.md5(F.concat_ws("\x1f", F.lit(seed), F.col("id").cast("string"), F.col("text_key").cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)
    ranked = (
        # A rate within rounding of a whole number is that number: no document goes above the cap.
        keyed.withColumn("certain", F.floor(F.col("rate") + 1e-9))
        .withColumn("p", F.greatest(F.col("rate") - F.col("certain"), F.lit(0.0)))
        .withColumn("u", u)
        # Only documents with a chance between 0 and 1 are ranked.
        .withColumn("xi", F.expr("case when p > 1e-9 and size > 0 then (u / (1 - u)) / (p / (1 - p)) end"))
        # The odds ratio brought to 0..1, so that it can be cut into steps.
        .withColumn("step", F.floor(F.expr(f"{RANK_STEPS} * xi / (1 + xi)")).cast("int"))
    )
    ordered = Window.partitionBy("b_source").orderBy("b_step")
    steps = (
        ranked.groupBy(F.col("source").alias("b_source"), F.col("step").alias("b_step"))
        .agg(F.sum("size").alias("step_words"), F.sum(F.col("size") * F.col("certain")).alias("sure"))
        .withColumn("all_sure", F.sum("sure").over(Window.partitionBy("b_source")))
        .where("b_step is not null")
        .withColumn("before", F.coalesce(F.sum("step_words").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(targets.select(F.col("source").alias("t_source"), F.col("target").alias("t")), F.col("b_source").eqNullSafe(F.col("t_source")))
        .withColumn("room", F.expr("t - all_sure - before"))
        .select("b_source", "b_step", "step_words", "room")
    )
    placed = ranked.join(
        steps, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("step") == F.col("b_step")), "left"
    ).drop("b_source", "b_step")
    # Whole steps are in or out; only the step in which the target is met needs an order.
    edge = "room > 0 and room < step_words"
    inside = Window.partitionBy("source", "step").orderBy("xi", "id", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.where(edge).withColumn("extra", F.when(F.sum("size").over(inside) <= F.col("room"), 1).otherwise(0))
    plain = placed.where(f"not coalesce({edge}, false)").withColumn(
        "extra", F.when(F.col("room") >= F.col("step_words"), 1).otherwise(0)
    )
    taken = plain.unionByName(cut).withColumn("taken", (F.col("size") * (F.col("certain") + F.col("extra"))).cast("long"))
    return taken.join(
        targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source"))
    ).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken")
