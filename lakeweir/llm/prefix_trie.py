"""Shared openings of conversations as a trie, with subtree sums by an Euler tour.

Conversations that begin with the same turns share the nodes of these turns. A node is the
sequence of the first ``depth`` turns; the root is the empty one. Steps:

* ``placed_turns`` numbers the turns of each conversation (``scans``), so a conversation of any length
  covers as many tasks as it needs. Texts are left behind here: a turn goes on as its digest.
* ``prefix_nodes``: the exclusive or of hashes of (place, digest) along a conversation names each
  prefix by 128 bits; rows with one name are a node.
* ``linked``: parents and children in one order by (name of the parent, number of the child) give each
  child its parent and the sibling before it, so a node with any number of children is no group in a task.
* ``tour``: an enter and an exit arc per node, each knowing the arc before it; ``list_places`` ranks that
  list over the cluster.
* Sums along the places of the arcs: what a subtree holds is what lies between its enter and exit arc.

A node's number is the place of its first row among all rows in order of conversation
and depth, so most links of the tour stay within a task at the first contraction.

Defined cases: a null role or text is empty; turns are in order of ``turn``, nulls first, then of role, of
the text's first 32 characters and its digest; equal rows each count as a turn; conversations without
id are left out, as no node could name them; an empty table has no nodes; other columns are ignored.
Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.list_ranking import NODES_PER_TASK, list_places
from lakeweir.llm.memory import freeing
from lakeweir.llm.scans import scanned
from lakeweir.llm.storage import Workspace

WORD = r"[^\x20\x09-\x0D]+"
NAME = ["depth", "x1", "x2"]
CHUNK_CHARS = 1 << 15
NOBODY = hashlib.sha256(b"").hexdigest()


def placed_turns(
    conversations: DataFrame,
    work: Workspace,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv``, ``place`` from 0, ``digest`` of role and text, ``n_words`` of each turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.left(text, F.lit(32)).alias("opening"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"),
    )
    order = ["turn", "role", "opening", "digest"]
    return scanned(turns, work, ["conv"], order).select("conv", "place", "digest", "n_words")


def prefix_nodes(turns: DataFrame, ids: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Nodes, and the node at which each conversation ends."""
    roots = ids.select(
        "conv", F.lit(0).cast("bigint").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("bigint").alias("n_words")
    )
    rows = roots.union(turns.select("conv", (F.col("place") + 1).alias("depth"), "digest", "n_words"))

    def hashed(*parts: Column) -> Column:
        return F.when(F.col("depth") == 0, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*parts))

    depth, digest = F.col("depth"), F.col("digest")
    rows = rows.select(
        "conv",
        "depth",
        "n_words",
        hashed(depth, digest).alias("h1"),
        hashed(digest, F.lit("second"), depth).alias("h2"),
    )
    rows = scanned(rows, work, ["conv"], ["depth"], xors=["h1", "h2"]).withColumnsRenamed(
        {"xor_h1": "x1", "xor_h2": "x2"}
    )
    nodes = rows.groupBy(*NAME).agg(
        F.min("conv").alias("conv_id"),
        F.min("index").alias("no"),
        F.count("*").alias("n_convs"),
        F.min(F.col("x1").bitwiseXOR(F.col("h1"))).alias("p1"),
        F.min(F.col("x2").bitwiseXOR(F.col("h2"))).alias("p2"),
        F.min("n_words").alias("n_words"),
    )
    last = rows.groupBy("conv").agg(F.max(F.struct(*NAME)).alias("last"))
    return work.store(nodes, "nodes"), last.select("last.*", "conv")


def linked(nodes: DataFrame, work: Workspace) -> DataFrame:
    """Of each node but the root: its parent, and the sibling before it (null for the first)."""
    none = F.lit(0).cast("bigint")
    parents = nodes.select(
        "depth", "x1", "x2", none.alias("side"), "no", F.col("no").alias("p_no"), F.col("conv_id").alias("p_conv")
    )
    children = nodes.filter("depth > 0").select(
        F.col("depth") - 1, "p1", "p2", none + 1, "no", none.alias("p_no"), none.alias("p_conv")
    )
    rows = scanned(
        parents.union(children), work, NAME, ["side", "no"], sums=["p_no", "p_conv"], lags=["no"]
    )
    return rows.filter("side = 1").select(
        "no",
        F.col("sum_p_no").alias("parent_no"),
        F.col("sum_p_conv").alias("parent_conv_id"),
        F.when(F.col("place") > 1, F.col("lag_no")).alias("sibling"),
    )


def tour(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The Euler tour as a list of arcs: ``2 * no`` enters node ``no``, ``2 * no + 1`` leaves it."""
    one = F.lit(1).cast("bigint")
    into = links.select(
        (2 * F.col("no")).alias("node"),
        F.coalesce(2 * F.col("sibling") + 1, 2 * F.col("parent_no")).alias("before"),
        one.alias("steps"),
    )
    root = nodes.filter("depth = 0").select(
        2 * F.col("no"), F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    )
    out = nodes.select(
        2 * F.col("no") + 1,
        F.when(F.col("n_children") == 0, 2 * F.col("no")).otherwise(2 * F.col("last_child") + 1),
        one,
    )
    return into.union(root).union(out)


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (name, conv) in order: comma-joined ids of a node, in chunks of bounded size."""
    names = [*NAME, "first", "ids"]
    for batch in batches:
        out: list[list] = []
        size = 0
        for *name, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if out and out[-1][:3] == name and size < CHUNK_CHARS:
                out[-1][4].append(str(conv))
                size += len(out[-1][4][-1]) + 1
            else:
                out.append([*name, conv, [str(conv)]])
                size = len(out[-1][4][0])
        columns = [pa.array(c, pa.int64()) for c in list(zip(*out))[:4]] if out else []
        if out:
            columns.append(pa.array([",".join(row[4]) for row in out], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (name, first, ids) in order: SHA-256 of all ids of a node, a chunk in memory at a time."""
    current, state = None, None

    def done() -> pa.RecordBatch:
        columns = [pa.array([v], pa.int64()) for v in current]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([state.hexdigest()])], names=[*NAME, "ends_sha256"]
        )

    for batch in batches:
        finished = []
        for *name, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if name != current:
                if state is not None:
                    finished.append(done())
                current, state = name, hashlib.sha256()
                state.update(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
    if state is not None:
        yield done()


def digests_of_ends(last: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending and joined by commas.

    A digest is made one byte after the other, so ids of one node have to meet: as chunks of joined
    text made in the tasks of a range order, and read one by one from a sorted stream.
    """
    name = "depth bigint, x1 bigint, x2 bigint"
    rows = last.select(*NAME, "conv").repartitionByRange(*NAME, "conv")
    parts = rows.sortWithinPartitions(*NAME, "conv").mapInArrow(
        freeing(joined_ids), f"{name}, first bigint, ids string"
    )
    parts = parts.repartition(*NAME).sortWithinPartitions(*NAME, "first")
    return parts.mapInArrow(freeing(digests), f"{name}, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, ids: DataFrame, work: Workspace, nodes_per_task: int = NODES_PER_TASK
) -> DataFrame:
    """One row per node of the trie of ``turns`` (of ``placed_turns``).

    ``ids`` lists all conversations once (``conv``), also those without turns, which end at
    the root. A node is named by ``conv_id``, the smallest conversation that begins with it, and ``depth``;
    its last turn is turn ``depth`` of that conversation. ``n_leaves`` and ``saved_tokens`` sum over its
    subtree; ``saved_tokens`` are the words that need not be stored again.
    """
    nodes, last = prefix_nodes(turns, ids, work)
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")
    )
    children = children.agg(F.count("*").alias("n_children"), F.max("no").alias("last_child"))
    nodes = nodes.join(children, NAME, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))
    )
    nodes = work.store(nodes, "nodes")
    links = work.store(linked(nodes, work), "links")
    places = list_places(tour(nodes, links), work, nodes_per_task)

    leaf = (F.col("n_children") == 0).cast("bigint")
    own = nodes.select("no", leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"))
    enters = F.col("node") % 2 == 0
    arcs = places.select(
        F.expr("node div 2").alias("no"), F.col("place").alias("at"), enters.alias("enters")
    ).join(own, "no")
    none = F.lit(0).cast("bigint")
    arcs = arcs.select(
        "no",
        "at",
        F.when(F.col("enters"), F.col("leaf")).otherwise(none).alias("leaf"),
        F.when(F.col("enters"), F.col("saved")).otherwise(none).alias("saved"),
    )
    sums = scanned(arcs, work, [], ["at"], sums=["leaf", "saved"]).groupBy("no")
    # Sums never fall along the tour. The enter arc's own value lies within its subtree.
    sums = sums.agg(
        *(
            (F.max(f"sum_{c}") - F.min(f"sum_{c}") + F.sum(c)).alias(name)
            for c, name in (("leaf", "n_leaves"), ("saved", "saved_tokens"))
        )
    )
    return (
        nodes.join(digests_of_ends(last), NAME, "left")
        .join(links.select("no", "parent_conv_id"), "no", "left")
        .join(sums, "no")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
        )
    )
