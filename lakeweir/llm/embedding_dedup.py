"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits the unit sphere by random directions at the median of a sample. Vectors within
``spill`` of a split go to both sides, so a linked pair is seldom parted: the margin is
half the standard deviation of the projected difference of a pair that just links.
Each tree parts other pairs, so that several trees together miss next to none.

1. The forest is fitted on a bounded sample (``max_sample``): directions per tree and level, a
   threshold per node. Thresholds lie where few vectors are, and a node that every threshold would
   send both ways in large part stays whole, so dense groups are compared as blocks instead of
   being cut at every level. Deep trees part more pairs than shallow ones. Trees are therefore
   added until none of some ten thousand pairs that link is parted by all of them: pairs of
   sample vectors, and sample vectors with made-up partners at just ``cosine``.
   Every vector is then sent to its leaves in all trees.
2. Within a leaf all cosines are computed in double precision, and only pairs of at least
   ``cosine`` link. A leaf of more than ``block`` vectors is dealt into blocks, and pairs of
   blocks are compared in tasks of their own; each copy of a vector goes to one pair of blocks.
3. A pair that meets in several leaves counts in the first of them: each vector carries the
   list of its leaves. A block returns a number of links and a component for each vector, so
   pairs are never spelled out, and the components of blocks are united at the end.

Equal vectors are one class from the start.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link
with nothing; vectors of different lengths do not link; a null id is smaller than all others;
ids are meant to be unique, rows that share one share its component and add up their links;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.components import connected_components
from lakeweir.llm.memory import freeing
from lakeweir.llm.samples import hash_sample
from lakeweir.llm.storage import Workspace

COSINE = 0.95
TREES = 4  # at least
MOST_TREES = 64
MOST_GROWTH = 1.3  # rows of both sides of a split to rows of the node
QUANTILES = np.linspace(0.2, 0.8, 25)  # of a node, tried as threshold
PROBES = 4096  # sample vectors whose pairs tell how many trees it takes
PROBE_PARTNERS = 4
PROBES_MADE_UP = 8
LEAF = 1000
BLOCK = 2048
MAX_SAMPLE = 32_768
LEAST_SAMPLE = 8  # sample vectors in a leaf
MAX_DEPTH = 24
FIRST_ID = int(np.iinfo(np.int64).min)
PAIRS_AT_ONCE = 200_000


@dataclass
class Forest:
    """``directions[t][level]`` is a unit vector; ``nodes[t]`` maps a node to its threshold.

    Node ``n`` has the children ``2 n`` and ``2 n + 1``; nodes without threshold are leaves.
    """

    directions: np.ndarray
    nodes: list[dict[int, float]]
    spill: float

    def leaves(self, unit: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their leaves in one tree; a row may have several."""
        rows, found = [], []
        stack = [(1, 0, np.arange(len(unit)))]
        while stack:
            node, level, at = stack.pop()
            threshold = self.nodes[tree].get(node)
            if threshold is None:
                rows.append(at)
                found.append(np.full(len(at), node, np.int64))
                continue
            place = unit[at] @ self.directions[tree, level, : unit.shape[1]]
            stack.append((2 * node, level + 1, at[place <= threshold + self.spill]))
            stack.append((2 * node + 1, level + 1, at[place > threshold - self.spill]))
        return np.concatenate(rows), np.concatenate(found)

    def parted(self, x: np.ndarray, y: np.ndarray, tree: int) -> np.ndarray:
        """Whether the pairs ``x[i]``, ``y[i]`` share no leaf of one tree."""
        apart = np.ones(len(x), bool)
        stack = [(1, 0, np.arange(len(x)))]
        while stack:
            node, level, at = stack.pop()
            threshold = self.nodes[tree].get(node)
            if threshold is None:
                apart[at] = False
                continue
            place = np.stack([x[at], y[at]]) @ self.directions[tree, level]
            left = (place <= threshold + self.spill).all(axis=0)
            right = (place > threshold - self.spill).all(axis=0)
            stack.append((2 * node, level + 1, at[left]))
            stack.append((2 * node + 1, level + 1, at[right]))
        return apart


def normalized(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # Scaling by the largest component first keeps squares within range.
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def probes(
    sample: np.ndarray, cosine: float, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that link: some of each sample vector, and made-up ones at just ``cosine``."""
    chosen = sample[rng.permutation(len(sample))[:PROBES]]
    x, y = [], []
    for lo in range(0, len(chosen), 256):
        linked = chosen[lo : lo + 256] @ chosen.T >= cosine
        linked[np.arange(len(linked)), lo + np.arange(len(linked))] = False
        draw = np.where(linked, rng.random(linked.shape), 2.0)
        best = np.argsort(draw, axis=1)[:, :PROBE_PARTNERS]
        row, k = np.nonzero(np.take_along_axis(linked, best, axis=1))
        x.append(chosen[lo + row])
        y.append(chosen[best[row, k]])
    chosen = np.repeat(chosen, PROBES_MADE_UP, axis=0)
    aside = rng.normal(size=chosen.shape)
    aside -= (aside * chosen).sum(axis=1, keepdims=True) * chosen
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    aside /= np.where(size > 0, size, 1)
    x.append(chosen)
    y.append(cosine * chosen + np.sqrt(max(1 - cosine**2, 0.0)) * aside)
    return np.concatenate(x), np.concatenate(y)


def best_split(place: np.ndarray, spill: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The threshold that leaves least to compare and parts few close vectors; who goes where."""
    thresholds = np.quantile(place, QUANTILES)
    order = np.sort(place)
    left = np.searchsorted(order, thresholds + spill, side="right") / len(place)
    right = 1 - np.searchsorted(order, thresholds - spill, side="right") / len(place)
    threshold = float(thresholds[np.argmin(left**2 + right**2 + (left + right - 1))])
    return threshold, place <= threshold + spill, place > threshold - spill


def fit_forest(
    sample: np.ndarray, rows: int, cosine: float, trees: int, leaf: int, seed: int = 0
) -> Forest:
    """Split the sample until leaves of all ``rows`` vectors are expected to have ``leaf`` or fewer.

    A node of which a split would send more than ``MOST_GROWTH - 1`` both ways stays whole.
    There are ``trees`` trees, or as many more as it takes until no probe is parted by all.
    """
    dim = sample.shape[1]
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(max(trees, MOST_TREES), MAX_DEPTH, dim))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    spill = 0.5 * np.sqrt(max(2 - 2 * cosine, 0.0) / dim)
    least = max(LEAST_SAMPLE, leaf * len(sample) / max(rows, 1))
    x, y = probes(sample, cosine, rng)
    forest = Forest(directions, [], spill)
    while len(forest.nodes) < trees or (len(x) and len(forest.nodes) < MOST_TREES):
        tree = len(forest.nodes)
        splits: dict[int, float] = {}
        stack = [(1, 0, np.arange(len(sample)))]
        while stack:
            node, level, at = stack.pop()
            if len(at) <= least or level == MAX_DEPTH:
                continue
            threshold, left, right = best_split(sample[at] @ directions[tree, level], spill)
            if left.sum() + right.sum() > MOST_GROWTH * len(at):
                continue
            splits[node] = threshold
            stack += [(2 * node, level + 1, at[left]), (2 * node + 1, level + 1, at[right])]
        forest.nodes.append(splits)
        apart = forest.parted(x, y, tree)
        x, y = x[apart], y[apart]
        if not splits:
            break  # one leaf holds every vector, so all pairs meet
    if len(x):
        warnings.warn(f"{len(x)} probe pairs are parted by all {len(forest.nodes)} trees")
    forest.directions = directions[: len(forest.nodes)]
    return forest


def vectors_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def fit_forests(
    classes: DataFrame, cosine: float, trees: int, leaf: int, max_sample: int
) -> dict[int, Forest]:
    """A forest for each length of more than ``leaf`` vectors; the others are one leaf each."""
    large = classes.groupBy("dim").count().filter(F.col("count") > leaf)
    sizes = {r["dim"]: r["count"] for r in large.collect()}
    drawn = hash_sample(classes, "id", max_sample).select("dim", "vector").toArrow()
    dims = drawn.column("dim").to_numpy()
    forests = {}
    for dim, rows in sizes.items():
        vectors = drawn.column("vector").filter(pa.array(dims == dim)).combine_chunks()
        if len(vectors):
            forests[dim] = fit_forest(normalized(vectors_of(vectors, dim)), rows, cosine, trees, leaf)
    return forests


def leaf_rows(forests: dict[int, Forest]) -> Callable:
    """From (dim, id, copies, vector): a row for each leaf of a vector, with all its leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                unit = normalized(vectors_of(part.column(3), int(dim)))
                whole = Forest(np.zeros((1, MAX_DEPTH, int(dim))), [{}], 0.0)
                forest = forests.get(int(dim), whole)
                rows, leaves = zip(*(forest.leaves(unit, t) for t in range(len(forest.nodes))))
                tree = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
                row, leaf = np.concatenate(rows), np.concatenate(leaves)
                code = tree * (1 << (MAX_DEPTH + 1)) + leaf
                order = np.lexsort((code, row))
                row, code = row[order], code[order]
                bounds = np.searchsorted(row, np.arange(len(unit) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(code))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(take) for c in part.columns), pa.array(code), lists.take(take)],
                    names=["dim", "id", "copies", "vector", "leaf", "leaves"],
                )

    return freeing(run)


def first_meeting(
    a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, leaf: int
) -> np.ndarray:
    """Whether pairs have no common leaf before ``leaf``. Unused places of ``a`` and ``b`` differ."""
    fresh = np.empty(len(at_a), bool)
    for lo in range(0, len(at_a), PAIRS_AT_ONCE):
        x, y = a[at_a[lo : lo + PAIRS_AT_ONCE]], b[at_b[lo : lo + PAIRS_AT_ONCE]]
        met = np.zeros(len(x), bool)
        for k in range(y.shape[1]):
            met |= ((x == y[:, k : k + 1]) & (x < leaf)).any(axis=1)
        fresh[lo : lo + PAIRS_AT_ONCE] = ~met
    return fresh


def padded(lists: pa.Array, filler: int) -> np.ndarray:
    size = lists.value_lengths().to_numpy()
    out = np.full((len(size), int(size.max())), filler, np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy()
    return out


def compare_blocks(cosine: float) -> Callable:
    """Links within a leaf, or between two blocks of a large one."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim, leaf, first, second = (k.as_py() for k in key)
        table = table.combine_chunks()

        def column(name: str) -> pa.Array:
            return table.column(name).combine_chunks() if table.num_rows else table.column(name)

        ids = column("id").to_numpy()
        weight = column("copies").to_numpy()
        unit = normalized(vectors_of(column("vector"), dim))
        block = column("block").to_numpy()
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        linked = unit[left] @ unit[right].T >= cosine
        if first == second:
            np.fill_diagonal(linked, False)
        x, y = np.nonzero(linked)
        lists = column("leaves")
        fresh = first_meeting(
            padded(lists, -1)[left], padded(lists, -2)[right], x, y, leaf
        )
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, left[x[fresh]], weight[right[y[fresh]]])
        if first != second:
            np.add.at(n, right[y[fresh]], weight[left[x[fresh]]])
        x, y = left[x], right[y]
        label = ids.copy()
        while True:
            lower = label.copy()
            np.minimum.at(lower, x, label[y])
            np.minimum.at(lower, y, label[x])
            if np.array_equal(lower, label):
                break
            label = lower
        seen = np.zeros(len(ids), bool)
        seen[x] = seen[y] = True
        return pa.table({"id": ids[seen], "n": n[seen], "peer": label[seen]})

    return run


def usable(vector: Column) -> Column:
    """Not null, with finite components that are not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    trees: int = TREES,
    leaf: int = LEAF,
    block: int = BLOCK,
    max_sample: int = MAX_SAMPLE,
) -> DataFrame:
    """Per vector: ``id``, ``n_links`` and ``component_id``, the smallest id it reaches."""
    spark = embeddings.sparkSession
    work = Workspace(spark, "embedding-dedup")
    first_id = F.lit(FIRST_ID)
    rows = embeddings.select(
        F.coalesce(F.col(id_col).cast("bigint"), first_id).alias("id"),
        F.when(usable(F.col(vector_col)), F.col(vector_col)).alias("vector"),
    )
    classes = (
        rows.filter("vector is not null")
        .groupBy("vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        .select(F.size("vector").alias("dim"), "id", "copies", "vector")
    )
    classes = work.store(classes, "classes")
    forests = fit_forests(classes, cosine, trees, leaf, max_sample)
    kind = classes.schema["vector"].dataType.simpleString()
    placed = work.store(
        classes.mapInArrow(
            leaf_rows(forests),
            f"dim int, id bigint, copies bigint, vector {kind}, leaf bigint, leaves array<bigint>",
        ),
        "leaves",
    )
    # One row per leaf, and the forest's leaves are bounded by the sample.
    blocks = F.ceil(F.count("*") / block).alias("blocks")
    sizes = placed.groupBy("dim", "leaf").agg(blocks)
    dealt = placed.join(F.broadcast(sizes), ["dim", "leaf"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks"))
    )
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    found = (
        dealt.withColumn("partner", partner)
        .withColumn("low", F.least("block", "partner"))
        .withColumn("high", F.greatest("block", "partner"))
        .groupBy("dim", "leaf", "low", "high")
        .applyInArrow(compare_blocks(cosine), "id bigint, n bigint, peer bigint")
    )
    found = work.store(found, "links")
    parts = connected_components(
        found.select(F.col("id").alias("a"), F.col("peer").alias("b")), work
    )
    linked = found.groupBy(F.col("id").alias("node_id")).agg(F.sum("n").alias("n"))
    moved = (
        classes.join(linked, F.col("id") == F.col("node_id"), "left")
        .join(parts, F.col("id") == F.col("node"), "left")
        .filter("copies > 1 or n is not null")
        .select(
            F.col("vector").alias("class_vector"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    component = F.coalesce("component", "id")
    return rows.join(moved, F.col("vector") == F.col("class_vector"), "left").select(
        F.when(F.col("id") != first_id, F.col("id")).alias("id"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(component != first_id, component).alias("component_id"),
    )
