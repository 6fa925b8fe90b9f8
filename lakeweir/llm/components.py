"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.storage import Workspace
from lakeweir.operators.joins import SALT, hot_list, profile, salted, spread_hot_keys

EDGES_PER_TASK = 200_000


def local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of the links of one partition, as links to their smallest nodes."""
    parts = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches]
    if not parts:
        return
    pairs = np.concatenate(parts, axis=1)
    nodes, at = np.unique(pairs, return_inverse=True)
    a, b = at.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["u", "v"]
    )


def connected_components(
    links: DataFrame, work: Workspace, edges_per_task: int = EDGES_PER_TASK
) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for all nodes of ``links`` (a, b).

    In each round tasks of a bounded number of links replace these by the stars of
    their own components; a node with more links than a task's share is dealt over several. If one task held all of them, that is the end. Otherwise
    alternating stars follow: in a large star each node's larger neighbours move to its smallest
    neighbour, in a small star the smaller ones do. Components are kept, and in a number of rounds
    that grows with the logarithm of their size each is one star. Each round is stored, so its
    lineage is one table.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = work.store(edges.distinct(), "edges")
    while True:
        tasks = -(-edges.count() // edges_per_task)
        dealt = edges.coalesce(1) if tasks <= 1 else dealt_by_root(edges, tasks)
        stars = dealt.mapInArrow(local_stars, "u bigint, v bigint")
        if tasks > 1:
            stars = alternated(work.store(stars.distinct(), "stars"), work)
        stars = work.store(stars, "edges")
        work.drop(edges)
        edges = stars
        if tasks <= 1 or is_forest_of_stars(edges):
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def dealt_by_root(edges: DataFrame, tasks: int) -> DataFrame:
    """Links of one root in one task, but for roots with more links than an even share."""
    hot = profile(edges, "v", tasks).hot
    if not hot:
        return edges.repartition(tasks, "v")
    edges = salted(edges, "v", hot_list(edges, "v", hot), None, first=True)
    return edges.repartition(tasks, "v", SALT).drop(SALT)


def with_nearest(links: DataFrame, nearest: DataFrame) -> DataFrame:
    """Links with the least neighbour ``m`` of their ``u``, of which there is one row each."""
    sides = spread_hot_keys(links, nearest, "u", "w", hot_dim=[])
    if sides is None:
        return links.join(nearest, F.col("u") == F.col("w"))
    links, nearest = sides[0], sides[1].withColumnRenamed(SALT, "w_salt")
    same = (F.col("u") == F.col("w")) & (F.col(SALT) == F.col("w_salt"))
    return links.join(nearest, same).drop(SALT, "w_salt")


def alternated(edges: DataFrame, work: Workspace) -> DataFrame:
    """One large and one small star."""
    both = edges.union(edges.select("v", "u"))
    nearest = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    large = (
        with_nearest(both.filter("v > u"), nearest)
        .select(F.col("v").alias("u"), F.least("m", F.col("u")).alias("v"))
        .distinct()
    )
    large = work.store(large, "large")
    nearest = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    pair = F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
    own = F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
    return (
        with_nearest(large, nearest)
        .select(F.explode(F.array(pair, own)).alias("e"))
        .select("e.u", "e.v")
        .filter("u <> v")
        .distinct()
    )


def is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one link to a smaller node, or only links to larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.filter("up > 1 or (up > 0 and down > 0)").isEmpty()
