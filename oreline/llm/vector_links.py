"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the space again and again: a random direction, the median of a sample along it, and a
margin around the median whose vectors go to both sides. Vectors that meet in a leaf of any tree are
compared by cosine. The upper splits are fitted on a bounded sample; every vector is then routed through
all trees. Leaves that hold more than ``GROUP_ROWS`` vectors of a label get a subtree each, fitted on a
chunk of their own vectors, and their chunks are routed through it side by side, until no leaf is too large for a task.
Where leaves are compared they are split further, in the same way, down to ``LEAF`` vectors. Equal vectors are one
node and are counted, not compared.

Every split parts some pairs of a tight group, and the more the larger the group is. So the forest only tells
which vectors hang together: its links give the components, and the links of a vector are then counted exactly
against all vectors of its component, block against block.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import components, staged

TREES = 10
#: Part of a node's vectors around the median that go to both sides.
SPILL = 0.15
#: Vectors that are compared with each other at once.
LEAF = 400
#: Vectors of a label that one task compares at most; a leaf with more is split before.
GROUP_ROWS = 20_000
#: Vectors that the upper splits are fitted on.
SAMPLE_ROWS = 20_000
#: Bytes of vectors that a task holds on each side when a component's blocks are compared; GROUP_ROWS vectors at most.
BLOCK_BYTES = 16 << 20
#: Sampled vectors below which a node is not split on the sample.
LEAST_SAMPLE = 32


def _split(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float, float]:
    """(direction, median, margin) of a random split."""
    direction = rng.standard_normal(x.shape[1])
    direction /= np.linalg.norm(direction)
    along = x @ direction
    middle = float(np.median(along))
    return direction, middle, float(np.quantile(np.abs(along - middle), SPILL))


def grow(x: np.ndarray, most: float, rng: np.random.Generator) -> tuple | None:
    """A tree of splits over the rows of ``x``; None is a leaf of at most ``most`` rows."""
    if len(x) <= max(most, LEAST_SAMPLE):
        return None
    direction, middle, margin = _split(x, rng)
    along = x @ direction
    sides = along <= middle + margin, along >= middle - margin
    if min(s.sum() for s in sides) > 0.95 * len(x):
        return None  # equal along this direction: a split gains nothing
    return direction, middle, margin, grow(x[sides[0]], most, rng), grow(x[sides[1]], most, rng)


def route(tree: tuple | None, x: np.ndarray, rows: np.ndarray, path: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``x`` in it); a leaf is named by its path, with a leading 1."""
    if tree is None or not len(rows):
        if len(rows):
            yield path, rows
        return
    direction, middle, margin, low, high = tree
    along = x[rows] @ direction
    yield from route(low, x, rows[along <= middle + margin], 2 * path)
    yield from route(high, x, rows[along >= middle - margin], 2 * path + 1)


def _split_large(placed: DataFrame, keys: DataFrame, group_rows: int, leaf_rows: int, seed: int) -> DataFrame:
    """``placed`` with leaves of more than ``group_rows`` rows split; ``keys`` are the leaves of its rows.

    A large leaf is dealt into chunks of about half that number. A subtree is fitted on the first one and
    goes to all of them, so no task holds more than a chunk, and nothing comes to the driver but whether
    a large leaf is left. A leaf that no direction splits stays as it is.
    """
    leaf = ["tree", "leaf", "size", "label"]
    columns, done, turn = placed.columns, [], 0
    into = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema.fields)

    def fit(key: tuple, chunk: pd.DataFrame) -> pd.DataFrame:
        x = _unit(np.vstack(chunk.sort_values("node")["v"].to_numpy()))
        name = [int(k) & (2**63 - 1) for k in key[:3]]
        tree = grow(x, 4 * leaf_rows / key[4], np.random.default_rng([seed, turn, *name]))
        return pd.DataFrame([[*key, pickle.dumps(tree)]], columns=[*leaf, "parts", "subtree"])

    def descend(chunk: pd.DataFrame, subtree: pd.DataFrame) -> pd.DataFrame:
        tree = pickle.loads(subtree["subtree"].iloc[0]) if len(subtree) and len(chunk) else None
        if tree is None:
            return chunk[columns].assign(final=len(subtree) > 0)  # without a first chunk it is tried again
        x = _unit(np.vstack(chunk["v"].to_numpy()))
        routed = [chunk.iloc[at].assign(leaf=path) for path, at in route(tree, x, np.arange(len(chunk)), int(chunk["leaf"].iloc[0]))]
        return pd.concat(routed)[columns].assign(final=False)

    while True:
        counted = keys.groupBy(*leaf).agg(F.count("*").alias("rows")).where(F.col("rows") > group_rows)
        large = staged(counted.select(*leaf, F.ceil(F.col("rows") * 2 / group_rows).cast("long").alias("parts")), "large")
        if large.isEmpty():
            break
        marked = placed.join(large, leaf, "left")
        done.append(marked.where("parts is null").select(*columns))
        crowded = marked.where("parts is not null").withColumn("part", F.pmod(F.xxhash64("node", F.lit(seed + turn)), F.col("parts")))
        kind = placed.schema["label"].dataType.simpleString()
        fitted = crowded.where("part = 0").groupBy(*leaf, "parts").applyInPandas(
            fit, f"tree long, leaf long, size long, label {kind}, parts long, subtree binary"
        )
        subtrees = staged(fitted, "subtrees").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        split = crowded.groupBy(*leaf, "part").cogroup(subtrees.groupBy(*leaf, "part")).applyInPandas(descend, f"{into}, final boolean")
        routed = staged(split, "routed")
        done.append(routed.where("final").select(*columns))
        placed = keys = routed.where("not final").select(*columns)
        turn += 1
    for part in done:
        placed = placed.unionByName(part)
    return placed


def _leaf_pairs(x: np.ndarray, least: float, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with cosine >= ``least`` in leaves of at most LEAF rows, by further random splits."""
    stack = [np.arange(len(x))]
    while stack:
        rows = stack.pop()
        if len(rows) > LEAF:
            direction, middle, margin = _split(x[rows], rng)
            along = x[rows] @ direction
            parts = rows[along <= middle + margin], rows[along >= middle - margin]
            if max(map(len, parts)) < 0.95 * len(rows):
                stack += parts
                continue
        # A dense group that no direction splits is compared in blocks.
        for i in range(0, len(rows), LEAF):
            for j in range(i, len(rows), LEAF):
                a, b = rows[i : i + LEAF], rows[j : j + LEAF]
                p, q = np.nonzero(x[a] @ x[b].T >= least)
                if i == j:
                    p, q = p[p < q], q[p < q]
                yield a[p], b[q]


def _tally(x: np.ndarray, y: np.ndarray, weight: np.ndarray, least: float) -> np.ndarray:
    """For each row of ``x``, the summed ``weight`` of the rows of ``y`` with cosine >= ``least``.

    Both are ordered along the direction in which they differ most. Unit vectors with that cosine are at most
    ``reach`` apart, along any direction, so only a band has to be compared.
    """
    both = np.concatenate([x, y])
    both = both - both.mean(axis=0)
    direction = both[np.abs(both).max(axis=1).argmax()]
    for _ in range(5):
        direction = both.T @ (both @ direction)
        length = np.linalg.norm(direction)
        direction = direction / length if length > 0 else np.zeros(both.shape[1])
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    along, other = x @ direction, y @ direction
    mine, yours = np.argsort(along), np.argsort(other)
    y, weight, other = y[yours], weight[yours], other[yours]
    out = np.zeros(len(x), np.int64)
    for i in range(0, len(x), LEAF):
        rows = mine[i : i + LEAF]
        low, high = np.searchsorted(other, [along[rows[0]] - reach, along[rows[-1]] + reach])
        for j in range(low, high, 10 * LEAF):
            k = min(high, j + 10 * LEAF)
            out[rows] += (x[rows] @ y[j:k].T >= least) @ weight[j:k]
    return out


def _degrees(members: DataFrame, least: float, group_rows: int, seed: int) -> DataFrame:
    """Rows (node, others): the rows that each node of ``members`` (node, copies, v, component) links with, but its own.

    All pairs of a component are compared. A component of more than a task's rows is dealt into blocks and
    each pair of blocks is a task. Only counts leave a task, never pairs.
    """
    room = F.greatest(F.lit(1), F.least(F.lit(group_rows), F.floor(F.lit(BLOCK_BYTES) / (8 * F.size("v")))))
    sized = members.groupBy("component").agg(F.count("*").alias("rows"), F.first(room).alias("room"))
    piles = max(1, sized.agg(F.sum(F.col("rows") / F.col("room"))).first()[0] or 0)
    # One row per component that fills a task: few, whatever the number of nodes.
    large = staged(sized.where("rows > room").select("component", F.ceil(F.col("rows") / F.col("room")).cast("long").alias("parts")), "dense")
    marked = members.join(F.broadcast(large), "component", "left")
    whole = marked.where("parts is null").withColumn("pile", F.pmod(F.xxhash64("component", F.lit(seed)), F.lit(int(piles) + 1)))

    def within(pile: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pile.groupby("component", sort=False):
            x, weight = _unit(np.vstack(group["v"].to_numpy())), group["copies"].to_numpy()
            linked = (x @ x.T >= least) @ weight if len(x) <= LEAF else _tally(x, x, weight, least)
            # A vector's cosine with itself may be rounded to less than a bound of 1.
            own = np.einsum("ij,ij->i", x, x) >= least
            out.append(pd.DataFrame({"node": group["node"].to_numpy(), "others": linked - own * weight}))
        return pd.concat(out)

    def across(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        low, high = (blocks[blocks["part"] == p] for p in key[1:3])
        if key[1] == key[2]:
            return within(low)
        if not len(low) or not len(high):
            return pd.DataFrame({"node": [], "others": []}).astype("int64")
        x, y = (_unit(np.vstack(b["v"].to_numpy())) for b in (low, high))
        return pd.DataFrame(
            {
                "node": np.concatenate([low["node"], high["node"]]),
                "others": np.concatenate([_tally(x, y, high["copies"].to_numpy(), least), _tally(y, x, low["copies"].to_numpy(), least)]),
            }
        )

    part = F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts"))
    blocks = (
        marked.where("parts is not null")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("component", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part", "node", "copies", "v")
    )
    schema = "node long, others long"
    counted = whole.groupBy("pile").applyInPandas(within, schema).unionByName(blocks.groupBy("component", "one", "two").applyInPandas(across, schema))
    return counted.groupBy("node").agg(F.sum("others").alias("others"))


def link_vectors(
    vectors: DataFrame,
    least: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    seed: int = 7,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id`` and ``kept`` (id = component_id).

    Two vectors link if their labels are equal and not null and their cosine, in double precision, is at
    least ``least``. No pair below is ever linked. The forest finds the components; within each, every link is
    counted. What can be missed is a link that would be the only way between two components: two vectors
    that meet in none of the trees, nor are joined by others.
    Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null label
    link with nothing. Vectors of unequal length are never compared. Rows that repeat an id, a label and a vector
    count once; one id with several vectors or labels is several vectors, each with its own links; a null id is
    never linked. An empty table gives none. Only the named columns are read.

    Equal vectors of a label are one node with a count, so a vector that a third of the rows share costs
    one row per leaf. Comparing a component takes the square of its distinct vectors in multiplications, less
    what lies too far apart along one direction, but no more than a count per vector and block is kept.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    # Spark's arrays may hold nulls: compare the count of finite components with the length.
    sound = F.expr(
        "id is not null and label is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(v, x -> x <> 0)"
    )
    nodes = staged(
        # Numbered, not named: an id may stand on several vectors. The stored numbers are what later steps agree on.
        rows.where(sound)
        .groupBy("label", "v")
        .agg(F.min("id").alias("name"), F.countDistinct("id").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    ).withColumn("size", F.size("v"))
    total = nodes.count()
    trees: dict[int, list] = {}
    if total:
        part = int(min(1.0, SAMPLE_ROWS / total) * 1_000_000) + 1
        sample = nodes.where(F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1_000_000)) < part).select("size", "v").toArrow()
        by_size: dict[int, list] = {}
        for size, v in zip(sample.column("size").to_pylist(), sample.column("v")):
            by_size.setdefault(size, []).append(np.array(v.values))
        for size, xs in by_size.items():
            x = _unit(np.array(xs))
            most = LEAF * len(x) * 1_000_000 / (total * part) if total else LEAF
            trees[size] = [grow(x, most * 4, np.random.default_rng([seed, size, t])) for t in range(TREES)]

    def place(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(own))
                x = _unit(np.vstack([np.array(v.values) for v in part.column("v")]))
                for t, tree in enumerate(trees.get(int(size), [None] * TREES)):
                    for leaf, at in route(tree, x, np.arange(len(own))):
                        n = len(at)
                        out = part.select(names).take(pa.array(at))
                        key = [pa.array(np.full(n, a), pa.int64()) for a in (t, leaf, size)]
                        yield pa.RecordBatch.from_arrays([*key, *out.columns], ["tree", "leaf", "size", *names])

    kind = nodes.schema["label"].dataType.simpleString()
    spots = nodes.select("label", "node", "v", "size")
    key = f"tree long, leaf long, size long, label {kind}"
    keys = spots.mapInArrow(partial(place, ["label"]), key)
    placed = spots.mapInArrow(partial(place, ["label", "node", "v"]), f"{key}, node long, v array<double>")
    placed = _split_large(placed, keys, group_rows, LEAF, seed)

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = group["node"].to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], _unit(np.vstack(group["v"].to_numpy())[order])
        rng = np.random.default_rng([seed, int(key[0]), int(key[1]) & 0x7FFFFFFF])
        pairs = [(ids[a], ids[b]) for a, b in _leaf_pairs(x, least, rng)]
        a = np.concatenate([p for p, _ in pairs]) if pairs else np.zeros(0, np.int64)
        b = np.concatenate([q for _, q in pairs]) if pairs else np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    links = staged(placed.groupBy("tree", "leaf", "size", "label").applyInPandas(compare, "a long, b long").distinct(), "links")
    thin = nodes.select("node", "name", "copies", "label", "v")
    found = staged(components(links).join(thin, "node").select("node", "name", "copies", "v", "component"), "members")
    degree = _degrees(found.drop("name"), least, group_rows, seed)
    # A component is named by its smallest id.
    names = found.groupBy("component").agg(F.min("name").alias("least_name"))
    found = found.join(names, "component").select("node", "least_name")
    judged = (
        thin.join(degree, "node", "left")
        .join(found, "node", "left")
        .select(
            F.col("label").alias("n_label"),
            F.col("v").alias("n_v"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("least_name", "name").alias("component_id"),
        )
    )
    good = rows.where(sound).join(judged, (F.col("label") == F.col("n_label")) & (F.col("v") == F.col("n_v")))
    rest = rows.where(~F.coalesce(sound, F.lit(False)))
    out = good.select("id", "n_links", "component_id").unionByName(
        rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    )
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.expr("id = component_id"), F.lit(True)).alias("kept"))


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large or small components do not overflow when squared.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
