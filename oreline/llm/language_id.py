"""Language identification by Bayesian evidence fusion.

The posterior of a language multiplies

* the likelihood of the text under byte-trigram models, with a background model ``und`` (all trigrams
  alike) for what is no language;
* the likelihood of the language that markup declares, from counts of how often texts of each language
  declare which;
* the prior of the host: language counts of the host, smoothed towards its registered domain, that
  towards the address suffix, and that towards all rows.

Counts are sums of text posteriors over all rows, by grouped aggregation. Only the trigram models are
fitted on a sample: ``SAMPLE_ROWS`` labelled rows, chosen by hash, of each language its share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import row_key, staged
from oreline.llm.suffixes import SUFFIXES
from oreline.llm.url_filter import levels
from oreline.llm.words import _buffers

SAMPLE_ROWS = 20_000
#: Trigrams are hashed into so many cells.
CELLS = 1 << 15
UNKNOWN = "und"
#: Every byte counts in three trigrams, so their evidence is a third of what it would be if they were independent.
TEMPER = 1 / 3
#: Rows that a group's parent is worth when its counts are smoothed.
STRENGTH = 20.0
RUN_BYTES = 1 << 18

#: ASCII letters in lower case; other ASCII is one space. Bytes above are parts of letters.
_FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def _cells(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, trigram cells, text of each) for runs of texts; white space and punctuation count once."""
    offsets, data = _buffers(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = first + 1
        while last < n and offsets[last + 1] - offsets[first] <= RUN_BYTES:
            last += 1
        folded = np.frombuffer(data[offsets[first] : offsets[last]].tobytes().translate(_FOLD), np.uint8)
        owner = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
        if len(folded):
            keep = np.ones(len(folded), bool)
            keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | (owner[1:] != owner[:-1])
            folded, owner = folded[keep].astype(np.uint32), owner[keep]
        if len(folded) > 2:
            cell = (folded[:-2] * np.uint32(0x9E3779B1) ^ folded[1:-1] * np.uint32(0x85EBCA77) ^ folded[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
            whole = owner[:-2] == owner[2:]
            yield first, (cell[whole] >> np.uint32(17)).astype(np.int64), owner[:-2][whole]
        first = last


def fit_models(docs: DataFrame, text: Column, label: Column, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [language, cell]) from about ``sample_rows`` labelled rows, as many of each label.

    Counts are summed by language and cell on the cluster; the driver gets at most ``CELLS`` numbers per
    language. Rows with a null label or text are not used. Without any, there are no languages.
    """
    rows = docs.select(text.cast("string").alias("text"), label.cast("string").alias("label")).where("text is not null and label is not null")
    spot = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_000_000))
    labels = rows.groupBy("label").agg(F.count("*").alias("n"), F.min(spot).alias("first")).collect()
    if not labels:
        return [], np.zeros((0, CELLS))
    # A rate per label, so that a rare one keeps its rows whatever the others have; each keeps one text at least.
    each = max(1, sample_rows // len(labels)) if sum(r["n"] for r in labels) > sample_rows else sample_rows
    last = [(r["label"], max(r["first"], int(1e9 * min(1.0, each / r["n"])))) for r in labels]
    rates = docs.sparkSession.createDataFrame(last, "label string, last long")
    sample = rows.join(F.broadcast(rates), "label").where(spot <= F.col("last")).select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            for first, cells, owner in _cells(batch.column("text")):
                own = labels[first + owner]
                for one in set(own.tolist()):
                    sums[one] = sums.get(one, np.zeros(CELLS, np.int64)) + np.bincount(cells[own == one], minlength=CELLS)
        for one, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at])], ["label", "cell", "n"])

    counted = sample.mapInArrow(count, "label string, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counted.column("label").to_pylist()))
    table = np.zeros((len(languages), CELLS))
    index = {x: i for i, x in enumerate(languages)}
    table[[index[x] for x in counted.column("label").to_pylist()], counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    table = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)
    return languages, np.log(table)


def _scorer(models: np.ndarray):
    """Rows (row, declared, host, n, scores): log likelihoods of the languages relative to the background's."""
    relative = (models + np.log(CELLS)).T.copy()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k = batch.num_rows, relative.shape[1]
            sums, counts = np.zeros((n, k)), np.zeros(n, np.int64)
            for first, cells, owner in _cells(batch.column("text")):
                size = int(owner.max(initial=-1)) + 1
                counts[first : first + size] = np.bincount(owner, minlength=size)
                for j in range(k):
                    sums[first : first + size, j] = np.bincount(owner, weights=relative[:, j].take(cells), minlength=size)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("declared"), batch.column("host"), pa.array(counts), lists],
                ["row", "id", "declared", "host", "n", "scores"],
            )

    return score


def _normalised(logs: str) -> str:
    """Probabilities from an array of logarithms, without overflow."""
    powers = f"transform({logs}, x -> exp(x - array_max({logs})))"
    return f"transform({powers}, x -> x / aggregate({powers}, 0D, (s, y) -> s + y))"


def identify(
    docs: DataFrame,
    text: Column,
    label: Column,
    declared: Column | None = None,
    host: Column | None = None,
    id_col: str = "doc_id",
    row_columns: tuple[str, ...] | None = None,
    least: float = 0.5,
    sample_rows: int = SAMPLE_ROWS,
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a hash of id and text, or of ``row_columns``), the id, ``language``,
    ``posterior``, ``declared`` (as given) and ``keep``.

    ``keep`` is false for what is no known language (``und``) or whose posterior is below ``least``. A
    null or empty text, or one without a trigram, has no evidence of its own and is ``und`` with posterior 0.
    A null or unknown declared language and a null host say nothing. Ties go to the first language in
    alphabetical order. Repeated rows stay and agree; an empty table gives none. Names of other columns
    cannot clash. A hot host is a skewed key of a join of thin rows, which AQE splits.
    """
    nothing = F.lit(None).cast("string")
    declared, host = nothing if declared is None else declared, nothing if host is None else host
    languages, models = fit_models(docs, text, label, sample_rows)
    names = [*languages, UNKNOWN]
    k = len(names)
    row = row_key(*(row_columns or (id_col,)), text.cast("string")) if row_columns is None else row_key(*row_columns)
    rows = docs.select(
        row.alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        F.lower(F.substring_index(F.trim(declared.cast("string")), "-", 1)).alias("declared"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
    )
    scored = staged(
        rows.mapInArrow(_scorer(models), "row long, id long, declared string, host string, n long, scores array<double>").select(
            "row",
            "id",
            F.when(F.col("declared").isin(languages), F.col("declared")).otherwise(F.lit("")).alias("declared"),
            "host",
            F.expr(f"transform(concat(scores, array(0D)), x -> x * {TEMPER})").alias("logs"),
            "n",
        ),
        "scores",
    )
    # Sums of text posteriors per declared language and host, over all rows with a text.
    soft = scored.where("n > 0").select("declared", "host", F.expr(_normalised("logs")).alias("p"))
    sums = [F.sum(F.col("p")[i]).alias(f"c{i}") for i in range(k)]
    counts = [f"c{i}" for i in range(k)]
    # At most one row per language and one without: bounded by the models' own size.
    by_declared = {r["declared"]: [r[c] for c in counts] for r in soft.groupBy("declared").agg(*sums).collect()}
    overall = [sum(x[i] for x in by_declared.values()) for i in range(k)]
    spoken = [(c + 1) / (sum(overall) + k) for c in overall]
    told = F.create_map(
        *[
            part
            for name in [*languages, ""]
            for part in (
                F.lit(name),
                # What a row does not declare, or declares in an unknown language, is no evidence.
                F.array(
                    *[
                        F.lit(float(np.log((by_declared.get(name, [0] * k)[i] + 0.5) / (overall[i] + 0.5 * (k + 1)))) if name else 0.0)
                        for i in range(k)
                    ]
                ),
            )
        ]
    )
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = soft.groupBy("host").agg(*sums).withColumns({"domain": domain, "suffix": suffix})
    smooth = lambda own, parent: [
        ((F.col(c) + STRENGTH * parent(i)) / (sum((F.col(x) for x in counts), F.lit(0.0)) + STRENGTH)).alias(f"{own}{i}") for i, c in enumerate(counts)
    ]
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(c).alias(c) for c in counts]).select("suffix", *smooth("s", lambda i: F.lit(spoken[i])))
    domains = hosts.groupBy("suffix", "domain").agg(*[F.sum(c).alias(c) for c in counts]).join(suffixes, "suffix").select("domain", *smooth("d", lambda i: F.col(f"s{i}")))
    priors = hosts.join(domains, "domain").select("host", *smooth("h", lambda i: F.col(f"d{i}")))
    priors = priors.select(F.col("host").alias("p_host"), F.array(*[F.log(f"h{i}") for i in range(k)]).alias("prior"))
    general = F.array(*[F.lit(float(np.log(p))) for p in spoken])
    fused = (
        scored.join(priors, F.col("host") == F.col("p_host"), "left")
        .withColumn("prior", F.when(F.col("host") == "", general).otherwise(F.coalesce("prior", general)))
        .withColumn("told", F.element_at(told, F.col("declared")))
        .withColumn("all", F.expr("zip_with(zip_with(logs, prior, (x, y) -> x + y), told, (x, y) -> x + y)"))
        .withColumn("p", F.expr(_normalised("`all`")))
        .withColumn("best", F.expr("cast(array_position(p, array_max(p)) as int)"))
    )
    known = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("best"))
    return fused.select(
        "row",
        F.col("id").alias(id_col),
        F.when(F.col("n") > 0, known).otherwise(UNKNOWN).alias("language"),
        F.when(F.col("n") > 0, F.array_max("p")).otherwise(0.0).alias("posterior"),
        F.nullif("declared", F.lit("")).alias("declared"),
    ).withColumn("keep", F.expr(f"language <> '{UNKNOWN}' and posterior >= {least}"))
