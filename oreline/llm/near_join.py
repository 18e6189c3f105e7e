"""Jaccard join on word shingles by parity sketches.

A document's shingles are dealt by hash to m segments, and a segment's word is the XOR of its
shingles' 64-bit hashes: the parities of 64 random subsets at once. A shingle that only one of two
documents has changes one word, so the number of words that differ is at most the size of the symmetric
difference, which similarity 0.8 bounds by (|A| + |B|) / 9. Segments that no difference falls into
have equal words, and these are joined, per band of set sizes.

With as many segments as allowed differences, a pair at the threshold keeps a third of its words. A
band's number of words is chosen so that such a pair has ``EXPECTED`` equal words on average that are
made of enough shingles to be selective: it is missed with probability exp(-EXPECTED), a pair of more
similar documents with a far smaller one. Small sets repeat the deal with other hashes.

Candidates are verified on the whole shingle sets. Documents with the same set are one node, so copies
are never expanded. Bucket by bucket, every node is first held against the smallest node it shares most
words with; only buckets whose nodes are not yet one component are searched further, between components,
behind a bound from a bit sketch. A bucket of more than ``CROWDED`` such nodes, as a passage that many
documents quote makes, is dealt again by rare shingles: two linked sets share at least 80 % of either, so
they share one of the rarest 20 % (and one more) of each, and no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import bitmap, components, sift, staged
from oreline.llm.words import SPACED, mix, runs, shingles

WIDTH = 5
#: Similarity in hundredths: linked when 100 * intersection >= 80 * union.
PERCENT = 80
EXPECTED = 18.0
#: Bits of the sketch that rejects pairs before they are verified, in longs.
SKETCH_LONGS = 8
#: Rows of a bucket beyond which it is dealt again by rare shingles.
CROWDED = 1000

SIGNATURE = "id long, n long, d1 long, d2 long, keys array<long>, sketch array<long>"


def allowed(total: int) -> int:
    """The largest symmetric difference of two sets with ``total`` elements together that are linked."""
    return total * (100 - PERCENT) // (100 + PERCENT)


@cache
def plan(level: int) -> tuple[int, int, int]:
    """(segments m, words to emit, least shingles in a segment) for set sizes from 2^level to 2^(level+1) - 1."""
    low, high = 2**level, 2 ** (level + 1) - 1
    most = allowed(2 * high)
    if not most:
        return 0, 0, 0  # only equal sets are similar enough, and they are one node
    m, least = max(2, most), 1 if most < 6 else 2
    rates = []
    for n in (low, (low + high) // 2, high):
        smaller = math.ceil(n * PERCENT / 100)
        for size in {smaller, n}:
            apart = allowed(n + size)
            common = (n + size - apart) // 2
            few = sum(math.comb(common, i) * (1 / m) ** i * (1 - 1 / m) ** (common - i) for i in range(least))
            rates.append((1 - 1 / m) ** apart * (1 - few))
    return m, math.ceil(EXPECTED / min(rates)), least


def parity_keys(values: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(join keys, their sets): one per emitted segment and level, for sets values[limits[i]:limits[i + 1]]."""
    sizes = np.diff(limits)
    bits = np.array([int(n).bit_length() for n in sizes])
    partner = np.array([int(n * 100 // PERCENT).bit_length() for n in sizes])
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    # A set joins its own level, and the next one if a partner may lie there.
    for up in (0, 1):
        levels = np.where((bits > 0) & (bits + up <= partner), bits - 1 + up, 0)
        plans = np.array([plan(int(x)) for x in levels])
        m, words, least = (plans[:, i] for i in range(3))
        deals = np.where(m > 0, -(-words // np.maximum(m, 1)), 0)
        owner, hashed = np.repeat(np.arange(len(sizes)), sizes), values
        for deal in range(int(deals.max(initial=0))):
            active = deals[owner] > deal
            owner, hashed = owner[active], mix(hashed[active] + np.uint64(0x9E3779B97F4A7C15))
            segment = ((hashed >> np.uint64(32)) * m[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            chosen = segment < np.minimum(m, words - deal * m)[owner]
            place = (owner[chosen] << 8) + segment[chosen]
            order = np.argsort(place, kind="stable")
            place, hits = place[order], hashed[chosen][order]
            begin = np.flatnonzero(np.diff(place, prepend=-1))
            if not len(begin):
                continue
            counts, of = np.diff(begin, append=len(place)), place[begin] >> 8
            word = np.bitwise_xor.reduceat(mix(hits), begin)
            tag = (levels[of] << 52) + (deal << 40) + (place[begin] & 255)
            enough = counts >= least[of]
            keys.append(mix(word ^ mix(tag.astype(np.uint64)))[enough])
            owners.append(of[enough])
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], owners[order]


def bit_sketches(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Parity bits, one toggled per shingle: two sketches differ in no more bits than the sets in elements."""
    width = 64 * SKETCH_LONGS
    bit = (mix(values ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(width)).astype(np.int64)
    parity = (np.bincount(owner * width + bit, minlength=n * width) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def digests(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, 0 for an empty one."""
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    if len(begin):
        one[owner[begin]] = np.add.reduceat(mix(values ^ np.uint64(0x1F83D9ABFB41BD6B)), begin)
        two[owner[begin]] = np.bitwise_xor.reduceat(mix(values + np.uint64(0x5BE0CD19137E2179)), begin)
    return one, two


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), _longs(values))


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, shingle hashes, limits) of runs of texts."""
    for first, hashes, limits in runs(texts, SPACED):
        own = [shingles(hashes[i:j], WIDTH) for i, j in zip(limits[:-1], limits[1:])]
        yield first, np.concatenate(own), np.cumsum([0, *map(len, own)])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, values, limits in _sets(batch.column("text")):
            sizes, n = np.diff(limits), len(limits) - 1
            owner = np.repeat(np.arange(n), sizes)
            one, two = digests(values, owner, n)
            keys, owners = parity_keys(values, limits)
            sketch = bit_sketches(values, owner, n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(first, n),
                    pa.array(sizes, pa.int64()),
                    _longs(one),
                    _longs(two),
                    _lists(keys, np.bincount(owners, minlength=n)),
                    _lists(sketch, np.full(n, SKETCH_LONGS)),
                ],
                ["id", "n", "d1", "d2", "keys", "sketch"],
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, values, limits in _sets(batch.column("text")):
            sizes, n = np.diff(limits), len(limits) - 1
            one, _ = digests(values, np.repeat(np.arange(n), sizes), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").slice(first, n), _longs(one), _lists(values, sizes)], ["node", "d1", "grams"]
            )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", shared.alias("s"), (F.size("x") + F.size("y")).alias("t"))
        .where(f"100 * s >= {PERCENT} * (t - s)")
        .select("a", "b")
    )


def _dealt_again(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of crowded buckets in buckets of their rarest shingles.

    Shingles are counted over these rows, and every set keeps its n - ceil(0.8 n) + 1 rarest; those that
    no other set has lead nowhere and go.
    """
    nodes = crowded.select("node", "n", "component", "sketch").dropDuplicates(["node"])
    grams = staged(sets.join(nodes.select("node"), "node", "left_semi").select("node", F.explode("grams").alias("gram")), "grams")
    times = grams.groupBy("gram").agg(F.count("*").alias("times"))
    ordered = grams.join(times, "gram").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("times", "gram"))).alias("grams"))
    few = F.expr(f"slice(grams, 1, cast(size(grams) - ({PERCENT} * size(grams) + 99) div 100 + 1 as int))")
    rare = ordered.select("node", F.explode(few).alias("rare")).where("rare.times > 1")
    return rare.select(F.col("rare.gram").alias("key"), "node").join(nodes, "node")


def _between_components(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different components that share a bucket and that size and sketch do not rule out."""
    far = " + ".join(f"bit_count(l.sketch[{i}] ^ r.sketch[{i}])" for i in range(SKETCH_LONGS))
    near = (
        f"l.key = r.key and l.component < r.component and 100 * least(l.n, r.n) >= {PERCENT} * greatest(l.n, r.n) "
        f"and {far} <= (l.n + r.n) * {100 - PERCENT} div {100 + PERCENT}"
    )
    pairs = rows.alias("l").join(rows.alias("r"), F.expr(near))
    return pairs.select(F.expr("least(l.node, r.node)").alias("a"), F.expr("greatest(l.node, r.node)").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are separated by ASCII white space and compared with A-Z in lower case. A text of one to four
    words is one shingle; a null or empty text has none and is linked with nothing, so its component is
    its own id. Rows that repeat an id are one document: where their texts differ, the largest set is
    compared. Rows with a null id cannot be named: they are linked with nothing, and their component is null. An empty
    table gives none. Only the two named columns are read. Whole texts count, however long.
    """
    every = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows, nameless = every.where("id is not null"), every.where("id is null")
    signed = staged(rows.mapInArrow(_sign, SIGNATURE), "signatures")
    thin = signed.select("id", "n", "d1", "d2")
    # Equal sets are one node, named by its smallest id. Counts of copies are summed before the shuffle.
    nodes = thin.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("node"))
    chosen = nodes.groupBy("node").agg(F.max(F.struct("n", "d1", "d2")).alias("set"))
    words = staged(
        signed.join(chosen, F.col("id") == F.col("node"))
        .where("set = struct(n, d1, d2)")
        .select("node", "n", "keys", "sketch")
        .dropDuplicates(["node"]),
        "nodes",
    )
    # A word belongs to a bucket if two nodes have it. Its smallest node is the bucket's pivot.
    emitted = words.select("node", F.explode("keys").alias("key"))
    pivots = emitted.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last").drop("last")
    shared = staged(emitted.join(pivots, "key"), "buckets")
    # The whole sets of nodes in buckets, made from the texts again: most rows are sifted out before any shuffle.
    members = shared.select("node").distinct()
    kept, _ = sift(rows.withColumnRenamed("id", "node"), "node", bitmap(members, "node"))
    sets = staged(
        kept.mapInArrow(_set_rows, "node long, d1 long, grams array<long>")
        .join(chosen, "node")
        .where("d1 = set.d1")
        .select("node", "grams")
        .dropDuplicates(["node"]),
        "sets",
    )
    # First the pivot that a node shares most words with.
    best = (
        shared.where("pivot < node")
        .groupBy("node", "pivot")
        .agg(F.count("*").alias("w"))
        .groupBy("node")
        .agg(F.min_by("pivot", F.expr("struct(-w, pivot)")).alias("pivot"))
    )
    links = staged(_verified(best.select(F.col("pivot").alias("a"), F.col("node").alias("b")), sets), "links")
    # Then the buckets that still hold several components, between these.
    so_far = components(links)
    placed = shared.drop("pivot").join(so_far, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = (
        placed.groupBy("key")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows"))
        .where("x < y")
        .select("key", "rows")
    )
    open_rows = staged(
        placed.join(split, "key").join(words.select("node", "n", "sketch"), "node").select("key", "rows", "node", "n", "component", "sketch"), "open"
    )
    plain = _between_components(open_rows.where(F.col("rows") <= crowded))
    dense = open_rows.where(F.col("rows") > crowded)
    if dense.isEmpty():
        rest = plain.distinct()
    else:
        rest = plain.unionByName(_between_components(staged(_dealt_again(dense, sets), "rare"))).distinct()
    tried = best.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    more = staged(_verified(rest.join(tried, ["a", "b"], "left_anti"), sets), "links")
    found = components(links.unionByName(more)).withColumnRenamed("node", "c_node")
    named = nodes.join(found, F.col("node") == F.col("c_node"), "left").select(
        F.col("n").alias("m"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "node").alias("component_id")
    )
    judged = thin.join(named, F.expr("n = m and d1 = e1 and d2 = e2"), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
    alone = nameless.mapInArrow(_sign, SIGNATURE).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return judged.unionByName(alone)
