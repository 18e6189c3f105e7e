"""Line deduplication by a deletion-neighbourhood join.

A line's words, between ASCII white space, are compared with A-Z in lower case, by 64-bit hashes. Lines with the same words are exact copies. Two lines of at
least ``NEAR_WORDS`` words are near copies if one word edit (replace, insert or delete) turns one into
the other. Every line emits what is left of it when a word is deleted, as hashed keys, and lines that
share a key are joined:

* with the same word deleted at the same place of lines of equal length, they differ in that word;
* with a word deleted from one line and the whole of the other, the other lacks that word.

Each such group keeps its earliest line, found by a minimum per key, so a group of any size costs one
row per member and no pairs. The distance of a line to the one that displaces it is verified word by word.

Before that, lines are sifted without loss: one edit leaves the first or the last words of both lines
alone, so a line whose beginning and end are its own emits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import bitmap, row_key, sift, staged
from oreline.llm.words import SPACED, mix, scan

NEAR_WORDS = 8
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def _lines(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row of each line, line number in its text, first word of each line and the end, word hashes)."""
    for first, bounds, own, begin, hashes in scan(batch.column("text"), SPACED):
        if not len(begin):
            continue
        breaks = np.flatnonzero(own == 10)
        row = np.searchsorted(bounds, begin, side="right") - 1
        line = np.searchsorted(breaks, begin)
        start = np.flatnonzero((np.diff(line, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
        number = line[start] - np.searchsorted(breaks, bounds[row[start]])
        yield first, row[start], number, np.append(start, len(hashes)), hashes


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64), pa.int64())


def _lists(values: np.ndarray, limits: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), _longs(values))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line with words: id, row, pos, two hashes of its words, and its anchors.

    Anchors are hashes of a line's first and last h words, h being the largest power of two below half its
    length. A partner may be one word longer, so a line whose length is just below a step takes both.
    The beginning and end do not overlap, and one edit touches at most one of them.
    """
    for batch in batches:
        for first, row, number, limits, hashes in _lines(batch):
            start, n = limits[:-1], np.diff(limits)
            ahead = np.arange(len(hashes)) - np.repeat(start, n)
            behind = np.repeat(n, n) - ahead
            forward = mix(hashes + ahead.astype(np.uint64) * _PLACE)
            fore, back = _sums(forward), _sums(mix(~hashes + behind.astype(np.uint64) * _PLACE))
            one, two = fore[limits[1:]] - fore[start], np.add.reduceat(mix(forward ^ _PLACE), start)
            anchors, own = [], np.flatnonzero(n >= NEAR_WORDS)
            for longer in (0, 1):
                h = 1 << np.floor(np.log2((n[own] + longer - 1) / 2)).astype(np.int64)
                tag = h.astype(np.uint64) << np.uint64(1)
                anchors.append(mix((fore[start[own] + h] - fore[start[own]]) ^ mix(tag)))
                anchors.append(mix((back[limits[own + 1]] - back[limits[own + 1] - h]) ^ mix(tag + np.uint64(1))))
            table = np.stack(anchors, 1) if len(own) else np.zeros((0, 4), np.uint64)
            # A line that takes one length only has its two anchors twice.
            twice = (table[:, 0] == table[:, 2]) & (table[:, 1] == table[:, 3])
            keep = np.ones(table.shape, bool)
            keep[twice, 2:] = False
            counts = np.zeros(len(n), np.int64)
            counts[own] = keep.sum(axis=1)
            at = pa.array(first + row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    batch.column("row").take(at),
                    pa.array(number, pa.int64()),
                    _longs(one),
                    _longs(two),
                    _lists(table[keep], np.concatenate([[0], np.cumsum(counts)])),
                ],
                ["id", "row", "pos", "h1", "h2", "anchors"],
            )


def _line_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line of at least NEAR_WORDS words: row, pos and the hashes of its words."""
    for batch in batches:
        for first, row, number, limits, hashes in _lines(batch):
            n = np.diff(limits)
            own = n >= NEAR_WORDS
            words = hashes[np.repeat(own, n)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(first + row[own])),
                    pa.array(number[own], pa.int64()),
                    _lists(words, np.concatenate([[0], np.cumsum(n[own])])),
                ],
                ["row", "pos", "words"],
            )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed keys of each line: roles 0 one word deleted, 1 the whole line, 2 one word deleted at a known place.

    The hash of a sequence is a sum over (word, place), so the deletion of a word is the sum before it
    plus the sum after it with places moved by one: every variant costs the same, however long the line.
    """
    for batch in batches:
        words = batch.column("words")
        limits = np.asarray(words.offsets)
        hashes = np.asarray(words.values)[limits[0] : limits[-1]].view(np.uint64)
        limits = (limits - limits[0]).astype(np.int64)
        n = np.diff(limits)
        line = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(hashes)) - limits[line]
        here = _sums(mix(hashes + place.astype(np.uint64) * _PLACE))
        moved = _sums(mix(hashes + (place - 1).astype(np.uint64) * _PLACE))
        i = np.arange(len(hashes))
        cut = (here[i] - here[limits[line]]) + (moved[limits[line + 1]] - moved[i + 1])
        whole = here[limits[1:]] - here[limits[:-1]]
        of = mix(np.concatenate([cut, whole]))
        tag = mix((n[line].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64))
        keys = np.concatenate([of, mix(mix(cut) ^ tag)])
        lines = np.concatenate([line, np.arange(len(n)), line])
        roles = np.repeat([0, 1, 2], [len(cut), len(whole), len(cut)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("h1").take(pa.array(lines)), _longs(keys), pa.array(roles, pa.int32())], ["h1", "key", "role"]
        )


def _near(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (h1, h2) of the lines that an earlier line is a near copy of."""
    anchored = distinct.where("size(anchors) > 0").select("h1", "h2", "first", F.explode("anchors").alias("anchor"))
    crowded = anchored.groupBy("anchor").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x < y").select("anchor")
    candidates = staged(anchored.join(crowded, "anchor", "left_semi").select("h1", "h2", "first").distinct(), "candidates")
    # Their words, read from the documents again; most documents are sifted out before the shuffle.
    rows = candidates.select(F.col("first.row").alias("row"), F.col("first.pos").alias("pos"), "h1", "h2", "first")
    kept, _ = sift(docs.select("row", "text"), "row", bitmap(rows, "row"))
    read = kept.mapInArrow(_line_words, "row long, pos long, words array<long>")
    lines = staged(read.join(rows, ["row", "pos"]).select("h1", "h2", "first", "words").dropDuplicates(["h1", "h2"]), "lines")
    variants = lines.select("h1", "words").mapInArrow(_variants, "h1 long, key long, role int")
    met = (
        variants.groupBy("key")
        .agg(F.min("h1").alias("x"), F.max("h1").alias("y"), F.min("role").alias("r0"), F.max("role").alias("r1"))
        .where("x < y and (r0 = 2 or r0 = 0 and r1 = 1)")
        .select("key")
    )
    members = staged(variants.join(met, "key").join(lines.select("h1", "h2", "first"), "h1"), "members")
    line = F.struct("first", "h1", "h2").alias("line")
    same = members.where("role = 2").select("key", line)
    whole = members.where("role = 1").select("key", line)
    cut = members.where("role = 0").select("key", line)
    earliest = lambda rows: rows.groupBy("key").agg(F.min("line").alias("by"))
    pairs = (
        same.join(earliest(same), "key")
        .unionByName(cut.join(earliest(whole), "key"))
        .unionByName(whole.join(earliest(cut), "key"))
        .where("by.first < line.first")
        .select("line.h1", "line.h2", F.col("by.h1").alias("b1"), F.col("by.h2").alias("b2"))
        .distinct()
    )
    texts = lines.select("h1", "h2", "words")
    other = lines.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("words").alias("other"))
    both = pairs.join(texts, ["h1", "h2"]).join(other, ["b1", "b2"])
    ordered = both.select(
        "h1",
        "h2",
        F.expr("if(size(words) >= size(other), words, other)").alias("a"),
        F.expr("if(size(words) >= size(other), other, words)").alias("b"),
    ).withColumn("p", F.expr("coalesce(nullif(array_position(zip_with(slice(a, 1, size(b)), b, (x, y) -> x = y), false), 0), size(b) + 1)"))
    # One edit at the first difference p: what follows is equal, with one word less in the shorter line.
    rest = "slice(a, cast(p as int) + 1, size(a)) = slice(b, cast(p as int) + if(size(a) = size(b), 1, 0), size(b) + 1)"
    return ordered.where(f"size(a) - size(b) <= 1 and ({rest})").select("h1", "h2").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of lines taken out of the text, plus ``n_lines``, ``n_exact`` and ``n_near``.

    Lines are split at ``\\n``. The earliest occurrence, by id (null first), content and line number,
    stays; a line is a near copy if any earlier line lies within one word edit, whether that line itself
    stays or not, so the result does not depend on an order of work. Lines without words always stay.
    ``n_lines`` counts lines with words, ``n_exact`` and ``n_near`` those taken out. A null text stays
    null with counts 0; an empty one stays empty. Repeated rows (same id and text) are one document and
    share its result. An empty table gives none. Other columns are passed through; ones with these three
    names are replaced.

    Lines travel as hashes: a text is shuffled only if lines are taken out of it.
    """
    ids = docs.withColumn("__row", row_key(id_col, text_col))
    own = ids.select(F.col(id_col).cast("long").alias("id"), F.col("__row").alias("row"), F.col(text_col).cast("string").alias("text"))
    occurrences = staged(
        own.mapInArrow(_occurrences, "id long, row long, pos long, h1 long, h2 long, anchors array<long>").select(
            F.struct("id", "row", "pos").alias("first"), "h1", "h2", "anchors"
        ),
        "occurrences",
    )
    distinct = staged(
        occurrences.groupBy("h1", "h2").agg(F.min("first").alias("first"), F.max("first").alias("last"), F.max("anchors").alias("anchors")),
        "distinct",
    )
    near = staged(_near(distinct, own).withColumn("near", F.lit(True)), "near")
    decided = (
        distinct.select("h1", "h2", F.col("first").alias("keep"), "last")
        .join(near, ["h1", "h2"], "left")
        .where("near or keep < last")
        .select("h1", "h2", "keep", F.coalesce("near", F.lit(False)).alias("near"))
    )
    gone = (
        occurrences.join(decided, ["h1", "h2"])
        .where("near or first > keep")
        .groupBy(F.col("first.row").alias("__row"))
        # As many positions as the document has lines.
        .agg(F.collect_set(F.struct(F.col("first.pos").alias("pos"), "near")).alias("__gone"))
    )
    gone = staged(gone, "gone")
    maybe, surely = sift(ids, "__row", bitmap(gone, "__row"))
    joined = maybe.join(gone, "__row", "left")
    lines = f"split(`{text_col}`, '\\n')"
    left = f"array_except(sequence(0L, size({lines}) - 1L), transform(__gone, g -> g.pos))"
    cleaned = f"if(__gone is null, `{text_col}`, array_join(transform({left}, i -> element_at(__lines, cast(i as int) + 1)), '\n'))"
    # A line with words: a character that is not white space, and all up to the line's end.
    counted = F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D][^\n]*")).cast("long")
    out = [c for c in docs.columns if c not in ("n_lines", "n_exact", "n_near")]
    nothing = F.lit(None).cast(gone.schema["__gone"].dataType)

    def finish(rows: DataFrame) -> DataFrame:
        tally = lambda what: F.expr(f"coalesce(cast(size(filter(__gone, g -> {what} g.near)) as long), 0L)")
        return rows.withColumn("__lines", F.expr(lines)).select(
            *[F.expr(cleaned).alias(c) if c == text_col else F.col(f"`{c}`") for c in out],
            F.coalesce(counted, F.lit(0).cast("long")).alias("n_lines"),
            F.when(F.col("__gone").isNull(), F.lit(0).cast("long")).otherwise(tally("not")).alias("n_exact"),
            F.when(F.col("__gone").isNull(), F.lit(0).cast("long")).otherwise(tally("")).alias("n_near"),
        )

    return finish(joined).unionByName(finish(surely.withColumn("__gone", nothing)))
