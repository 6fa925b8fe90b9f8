"""Places of the elements of a linked list that is spread over many tasks.

A list is a table of ``node``, ``before`` (the node before it, null for the first) and ``steps``, its distance
from that node. A level contracts it: tasks of a bounded number of neighbouring node numbers
follow the links that stay inside the task, so each node knows its distance from a node of another
task. Only the nodes that others refer to that way make up the list of the next level. Where node numbers follow the
list, few remain. Where they do not, every fourth node goes by coin flips
instead: a node with heads after one with tails is skipped by its follower. So each level shrinks whatever
the numbering, and the number of levels grows with the logarithm of the list. When few enough are left, one task
ranks them, and the levels are undone: a node's place is that of the node it refers to plus its distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.storage import Workspace

NODES_PER_TASK = 200_000
COLUMNS = "node bigint, before bigint, steps bigint"


def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task, each led back to a node outside of the task or to the start."""
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    node = table.column(0).to_numpy()
    before = table.column(1).fill_null(-1).to_numpy().copy()
    steps = table.column(2).to_numpy().copy()
    order = np.argsort(node)
    node, before, steps = node[order], before[order], steps[order]
    while True:
        at = np.minimum(np.searchsorted(node, before), len(node) - 1)
        inside = np.flatnonzero((before >= 0) & (node[at] == before))
        if not len(inside):
            break
        # Each takes over what its own refers to, so the distances double.
        at = at[inside]
        before[inside], steps[inside] = before[at], steps[inside] + steps[at]
    yield pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(before, mask=before < 0), pa.array(steps)],
        names=["node", "before", "steps"],
    )


def skipped(level: int) -> F.Column:
    """Heads after tails: no two neighbours are skipped."""

    def heads(name: str) -> F.Column:
        return F.pmod(F.xxhash64(F.col(name), F.lit(level)), F.lit(2)) == 1

    return F.col("before").isNotNull() & heads("node") & ~heads("before")


def list_places(
    links: DataFrame, work: Workspace, nodes_per_task: int = NODES_PER_TASK
) -> DataFrame:
    """``node`` and ``place``, from 0, of each node of a list of (node, before, steps).

    Node numbers are 0 or more; the first node's ``before`` is null and its ``steps`` are its place.
    """
    levels: list[tuple[DataFrame, bool]] = []
    rest = work.store(links.select("node", "before", "steps"), "links")
    n, flip = rest.count(), False
    while n > nodes_per_task:
        if flip:
            marked = rest.withColumn("goes", skipped(len(levels)))
            gone = work.store(marked.filter("goes").drop("goes"), "skipped")
            own = gone.select(
                F.col("node").alias("s_node"),
                F.col("before").alias("s_before"),
                F.col("steps").alias("s_steps"),
            )
            kept = marked.filter("not goes").join(own, F.col("before") == F.col("s_node"), "left")
            rest = kept.select(
                "node",
                F.coalesce("s_before", "before").alias("before"),
                (F.col("steps") + F.coalesce("s_steps", F.lit(0))).alias("steps"),
            )
            levels.append((gone, False))
        else:
            dealt = rest.repartitionByRange(-(-n // nodes_per_task), "node")
            led = work.store(dealt.mapInArrow(follow, COLUMNS), "led")
            wanted = led.filter("before is not null").select(F.col("before").alias("w")).distinct()
            rest = led.join(wanted, F.col("node") == F.col("w"), "left_semi")
            levels.append((led, True))
        rest = work.store(rest, "kept")
        left = rest.count()
        flip = not flip and left > n * 3 // 4
        n = left
    places = rest.coalesce(1).mapInArrow(follow, COLUMNS)
    places = work.store(places.select("node", F.col("steps").alias("place")), "places")
    for level, whole in reversed(levels):
        known = places.select(F.col("node").alias("k_node"), "place")
        found = level.join(known, F.col("before") == F.col("k_node"), "left").select(
            "node", (F.col("steps") + F.coalesce("place", F.lit(0))).alias("place")
        )
        # A led level has all nodes, also those that stayed; skipped nodes are not among these.
        places = work.store(found if whole else found.union(places), "places")
    return places
