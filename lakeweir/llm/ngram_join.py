"""Near-duplicate documents by a grouped prefix join on word shingles.

Two documents link when their sets of ``words``-word shingles have a Jaccard similarity
of ``percent`` hundredths or more. The join is exact.

1. Each set is put into one order for all documents: shingles of crowded buckets of a count
   table of fixed size last, the fuller the later, and the rest by hash. Sets that share that much share a
   shingle among the first ``n - ceil(t * n) + 1``, the prefix.
2. Shingles that lie in one prefix only are found by an aggregate and leave the prefixes; the
   others are sent on as a bitmap. Equal sets are one class. Classes with equal prefix and
   size are one group. Step 3 joins groups; steps 4 and 5 join single classes, as what they look
   for are links between classes of one group or of several that step 3 left apart.
3. The groups of a shingle, sorted by size, are first paired each with the next one
   only. Verified pairs make components. Large families of near copies mostly
   become one component here, by as many pairs as they have members.
4. ``HUB_ROUNDS`` times, one class of each component of a shingle is paired with one of the
   largest, which unites what the chains left apart.
5. What remains are classes that may link across components. For shingles of up to
   ``LONG_LIST`` classes these are joined in pairs. For longer lists they make clusters, and
   whole sets are compared within a cluster, all outside of its largest component with
   all others, in tasks of two blocks. Tasks return a component for each class they link, so
   pairs are never spelled out.
6. Groups are expanded to their classes for verification, which counts common shingles of
   whole sets. Classes are expanded to documents at the end.

Sizes and the place of a shingle in the prefix rule out pairs early.

Defined cases: a null text is empty; a document without words has no shingles and links with
nothing; with fewer words than a shingle the whole sequence is the only shingle; rows
with equal texts are linked; rows that share an id are one node, so their components are one;
a null id is a node like any other and smaller than all; ids are integers; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.llm.bitmaps import build_bitmap, perhaps_in
from lakeweir.llm.components import connected_components
from lakeweir.llm.memory import freeing
from lakeweir.llm.storage import Workspace
from lakeweir.llm.words import (
    M1,
    M2,
    NOT_SPACE,
    Words,
    chunks,
    hash_words,
    mix,
    ngrams,
    signed,
    split,
)

SHINGLE = 5
PERCENT = 80
CROWD = 8  # shingles of a bucket that count as crowded
LONG_LIST = 256  # classes of a shingle from which on blocks are compared instead of pairs
HUB_ROUNDS = 2
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 500_000
CROWD_BITS = 24
CROWD_BUCKETS = 1 << CROWD_BITS
MOST_COUNTED = int(np.iinfo(np.uint16).max)
FIRST_ID = int(np.iinfo(np.int64).min)


def shingles(w: Words, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each shingle, with repeats."""
    h, _ = hash_words(w)
    room, text = w.room(), w.text_of_word()
    at = np.flatnonzero(room >= words)
    texts, hashes = [text[at]], [ngrams(h, words)[at]]
    counts = np.diff(w.first)
    for size in range(1, words):
        short = np.flatnonzero(counts == size)
        if len(short):
            texts.append(short)
            hashes.append(mix(ngrams(h, size)[w.first[short]] + np.uint64(size)))
    return np.concatenate(texts), np.concatenate(hashes)


def crowd_rows(words: int) -> Callable:
    """Buckets that hold clearly more shingles than the mean bucket of the task, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CROWD_BUCKETS, np.uint16)
        for batch in batches:
            for w in split(batch.column(0), NOT_SPACE, lower=True):
                _, h = shingles(w, words)
                bucket, n = np.unique(h & np.uint64(CROWD_BUCKETS - 1), return_counts=True)
                # A count stays at the most its type holds.
                counts[bucket] = np.minimum(counts[bucket] + n, MOST_COUNTED)
        mean = counts.mean()
        bucket = np.flatnonzero(counts >= mean + 2 * np.sqrt(mean) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(counts[bucket].astype(np.int64))], names=["bucket", "n"]
        )

    return freeing(run)


def crowding(texts: DataFrame, words: int) -> np.ndarray:
    """Per bucket 0, or more the more crowded it is; one byte for each of a fixed number."""
    rows = texts.mapInArrow(crowd_rows(words), "bucket bigint, n bigint")
    level = F.floor(F.log2(F.sum("n"))).cast("int")
    table = np.zeros(CROWD_BUCKETS, np.uint8)
    crowded = rows.groupBy("bucket").agg(level.cast("byte").alias("level"), F.sum("n").alias("n"))
    for batch in crowded.filter(F.col("n") >= CROWD).select("bucket", "level").toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table


def ordered_sets(
    w: Words, words: int, crowds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle in the common order, and bounds of the texts."""
    text, h = shingles(w, words)
    level = crowds[(h & np.uint64(CROWD_BUCKETS - 1)).astype(np.int64)]
    order = np.lexsort((h, level, text))
    text, h = text[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    text, h = text[keep], h[keep]
    return text, h, np.searchsorted(text, np.arange(w.texts + 1))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def signatures(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, whatever the order of its members."""
    return sums(mix(h * M1), bounds), sums(mix(h * M2 + M1), bounds)


def prefix_rows(words: int, percent: int, crowds: Broadcast) -> Callable:
    """From (id, text): set size, signatures of set and prefix, and the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for w in split(batch.column(1), NOT_SPACE, lower=True):
                text, h, bounds = ordered_sets(w, words, crowds.value)
                n = np.diff(bounds)
                s1, s2 = signatures(h, bounds)
                size = np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)
                at = np.arange(len(h)) - bounds[text]
                h = h[at < size[text]]
                cut = np.concatenate([[0], np.cumsum(size)])
                p1, _ = signatures(h, cut)
                prefix = pa.ListArray.from_arrays(
                    pa.array(cut.astype(np.int32)), pa.array(signed(h))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(w.lo, w.texts),
                        pa.array(n),
                        pa.array(signed(s1)),
                        pa.array(signed(s2)),
                        pa.array(signed(mix(p1 + n.astype(np.uint64)))),
                        prefix,
                    ],
                    names=["id", "n", "s1", "s2", "prefix_key", "prefix"],
                )

    return freeing(run)


def shared_rows(known: Broadcast) -> Callable:
    """Keeps of each prefix what the bitmap lets through, with its place in the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(batch.num_columns - 1)
            h = prefix.flatten().to_numpy().view(np.uint64)
            row = pc.list_parent_indices(prefix).to_numpy()
            begin = np.searchsorted(row, np.arange(len(prefix) + 1))
            keep = perhaps_in(known.value, h)
            place = (np.arange(len(h)) - begin[row])[keep]
            bounds = np.searchsorted(row[keep], np.arange(len(prefix) + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays(
                [pa.array(signed(h[keep])), pa.array(place)], names=["token", "place"]
            )
            tokens = pa.ListArray.from_arrays(pa.array(bounds), items)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], tokens], names=[*batch.schema.names[:-1], "tokens"]
            )

    return freeing(run)


def wanted_rows(wanted: Broadcast) -> Callable:
    """From (id, hash of id, hash of text, text): the rows whose id the bitmap lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).to_numpy()
            keep = np.flatnonzero(perhaps_in(wanted.value, key.view(np.uint64)))
            rows = np.stack([key[keep], batch.column(2).to_numpy()[keep]], axis=1)
            _, first = np.unique(rows, axis=0, return_index=True)
            yield batch.take(pa.array(keep[np.sort(first)])).select([0, 3])

    return freeing(run)


def similar_rows(words: int, percent: int) -> Callable:
    """From (a, b, text of a, text of b): the pairs whose whole sets are similar enough."""
    none = np.zeros(CROWD_BUCKETS, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.add(pc.binary_length(batch.column(2)), pc.binary_length(batch.column(3)))
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(size, 0).to_numpy())])
            for lo, hi in chunks(ends):
                part = batch.slice(lo, hi - lo)
                texts = pa.concat_arrays([part.column(2), part.column(3)])
                turn = np.arange(2 * (hi - lo)).reshape(2, -1).T.ravel()
                for w in split(texts.take(pa.array(turn)), NOT_SPACE, lower=True, limit=1 << 60):
                    text, h, bounds = ordered_sets(w, words, none)
                    pair = text // 2
                    order = np.lexsort((h, pair))
                    pair, h = pair[order], h[order]
                    both = (pair[1:] == pair[:-1]) & (h[1:] == h[:-1])
                    common = np.bincount(pair[1:][both], minlength=hi - lo)
                    union = np.diff(bounds[::2]) - common
                    keep = (common > 0) & (common * 100 >= union * percent)
                    yield part.select([0, 1]).filter(pa.array(keep))

    return freeing(run)


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Per document: ``id``, ``n_shingles`` and ``component_id``, the smallest id it reaches."""
    spark = documents.sparkSession
    work = Workspace(spark, "ngram-join")
    first_id = F.lit(FIRST_ID)
    texts = documents.select(
        F.coalesce(F.col(id_col).cast("bigint"), first_id).alias("id"),
        F.col(text_col).alias("text"),
    )
    crowds = spark.sparkContext.broadcast(crowding(texts.select("text"), words))
    rows = texts.mapInArrow(
        prefix_rows(words, percent, crowds),
        "id bigint, n bigint, s1 bigint, s2 bigint, prefix_key bigint, prefix array<bigint>",
    )
    rows = work.store(rows, "prefixes")
    shared = (
        rows.select(F.explode("prefix").alias("token")).groupBy("token").count().filter("count > 1")
    )
    known = build_bitmap(shared, "token")
    docs = rows.mapInArrow(
        shared_rows(known),
        "id bigint, n bigint, s1 bigint, s2 bigint, prefix_key bigint, "
        "tokens array<struct<token:bigint,place:bigint>>",
    )
    docs = work.store(docs, "documents")
    work.drop(rows)
    # Equal sets, by their smallest id.
    classes = (
        docs.filter("n > 0")
        .groupBy("n", "s1", "s2")
        .agg(
            F.min("id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("prefix_key").alias("prefix_key"),
            F.first("tokens").alias("tokens"),
        )
    )
    classes = work.store(classes, "classes")
    listed = classes.filter("size(tokens) > 0").select("rep", "n", "prefix_key", "tokens")

    pairs = work.store(neighbour_pairs(listed, percent), "neighbours")
    links = verified(texts, pairs, words, percent, work)
    parts = connected_components(links.select("a", "b").union(shared_id_links(docs, classes, work)), work)

    def united(new: DataFrame) -> DataFrame:
        known = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return connected_components(known.union(new), work)

    for find in (hub_pairs,) * HUB_ROUNDS + (short_list_pairs,):
        found = work.store(find(listed, parts, pairs, percent), "pairs")
        if not found.isEmpty():
            parts = united(verified(texts, found, words, percent, work))
            pairs = pairs.union(found)
    rest = work.store(open_clusters(listed, parts, pairs, percent, work), "clusters")
    if not rest.isEmpty():
        parts = united(linked_in_blocks(texts, rest, words, percent, work))

    component = F.coalesce("component", "rep")
    moved = (
        classes.join(parts, F.col("rep") == F.col("node"), "left")
        .filter((F.col("copies") > 1) | (component != F.col("rep")))
        .select(*[F.col(c).alias(f"class_{c}") for c in ("n", "s1", "s2")], component.alias("component"))
    )
    same_class = [F.col(c) == F.col(f"class_{c}") for c in ("n", "s1", "s2")]
    none = F.lit(None).cast("bigint")
    return (
        docs.select("id", "n", "s1", "s2")
        .join(moved, same_class, "left")
        .select(
            F.when(F.col("id") != first_id, F.col("id")).alias("id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn(
            "component_id",
            F.when(F.col("component_id") == first_id, none).otherwise(F.col("component_id")),
        )
    )


def shared_id_links(docs: DataFrame, classes: DataFrame, work: Workspace) -> DataFrame:
    """Links between the classes that one id has texts in: an id is one node."""
    same = F.struct("n", "s1", "s2")
    several = (
        docs.filter("n > 0")
        .groupBy(F.col("id").alias("node"))
        .agg(F.min(same).alias("lo"), F.max(same).alias("hi"))
        .filter("lo <> hi")
        .select("node")
    )
    several = work.store(several, "shared-ids")
    held = docs.join(several, F.col("id") == F.col("node"), "left_semi")
    held = held.filter("n > 0").select("id", "n", "s1", "s2").distinct()
    reps = held.join(classes.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"]).select("id", "rep")
    # The id itself stands between its classes, so no group of them is formed.
    return reps.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))


def may_link(n1: Column, n2: Column, place1: Column, place2: Column, percent: int) -> Column:
    """Sizes are close enough, and what follows the first common shingle can suffice."""
    sizes = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
    most = F.least(n1 - place1, n2 - place2)
    return sizes & (most * (100 + percent) >= (n1 + n2) * percent)


def neighbour_pairs(listed: DataFrame, percent: int) -> DataFrame:
    """For each shingle, its groups in order of size, each paired with the next one.

    Within a group the classes are paired the same way.
    """
    groups = listed.groupBy("n", "prefix_key").agg(
        F.min("rep").alias("gid"), F.first("tokens").alias("tokens")
    )
    postings = groups.select("gid", "n", F.inline("tokens"))
    order = Window.partitionBy("token").orderBy("n", "gid")
    before = F.lag(F.struct("gid", "n", "place")).over(order)
    across = (
        postings.withColumn("before", before)
        .filter("before is not null")
        .filter(
            may_link(
                F.col("n"), F.col("before.n"), F.col("place"), F.col("before.place"), percent
            )
        )
        .select(F.col("before.gid").alias("x"), F.col("gid").alias("y"))
    )
    order = Window.partitionBy("n", "prefix_key").orderBy("rep")
    within = listed.select(F.lag("rep").over(order).alias("x"), F.col("rep").alias("y"))
    return (
        across.union(within.filter("x is not null"))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def postings_of(listed: DataFrame, parts: DataFrame) -> DataFrame:
    """Classes by shingle, with the component each is in so far."""
    return (
        listed.join(parts, F.col("rep") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .select("rep", "n", "component", F.inline("tokens"))
    )


def hub_pairs(listed: DataFrame, parts: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """For each shingle, one class of each component, paired with one of the largest component.

    So components of one family are united by a few pairs instead of all pairs between them.
    """
    member = F.struct("rep", "n", "place")
    hubs = (
        postings_of(listed, parts)
        .groupBy("token", "component")
        .agg(
            F.count("*").alias("members"),
            F.min_by(member, F.xxhash64("token", "rep", "component")).alias("hub"),
        )
    )
    largest = Window.partitionBy("token").orderBy(F.desc("members"), "component")
    main = F.first("hub").over(largest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = may_link(
        F.col("hub.n"), F.col("main.n"), F.col("hub.place"), F.col("main.place"), percent
    )
    return (
        hubs.withColumn("main", main)
        .filter(near)
        .select(
            F.least("hub.rep", "main.rep").alias("a"), F.greatest("hub.rep", "main.rep").alias("b")
        )
        .filter("a <> b")
        .distinct()
        .join(done, ["a", "b"], "left_anti")
    )


def mixed_lists(postings: DataFrame) -> DataFrame:
    """Shingles of several components: ``mixed_token``, ``main`` component and ``size``."""
    return (
        postings.groupBy("token", "component")
        .agg(F.count("*").alias("members"))
        .groupBy(F.col("token").alias("mixed_token"))
        .agg(
            F.max_by("component", F.struct("members", "component")).alias("main"),
            F.count("*").alias("parts"),
            F.sum("members").alias("size"),
        )
        .filter("parts > 1")
        .drop("parts")
    )


def short_list_pairs(
    listed: DataFrame, parts: DataFrame, done: DataFrame, percent: int
) -> DataFrame:
    """Pairs that may link across components, of shingles of fewer than ``LONG_LIST`` classes.

    One side of a pair is outside of the shingle's largest component.
    """
    postings = postings_of(listed, parts)
    lists = mixed_lists(postings).filter(F.col("size") < LONG_LIST)
    mixed = postings.join(lists, F.col("token") == F.col("mixed_token")).drop("mixed_token")
    out = mixed.filter("component <> main").select(
        *[F.col(c).alias(f"o_{c}") for c in ("rep", "n", "component", "token", "place")]
    )
    crossing = (
        (F.col("token") == F.col("o_token"))
        & (F.col("component") != F.col("o_component"))
        & ((F.col("component") == F.col("main")) | (F.col("rep") > F.col("o_rep")))
        & may_link(F.col("n"), F.col("o_n"), F.col("place"), F.col("o_place"), percent)
    )
    return (
        out.join(mixed, crossing)
        .select(F.least("rep", "o_rep").alias("a"), F.greatest("rep", "o_rep").alias("b"))
        .filter("a <> b")
        .distinct()
        .join(done, ["a", "b"], "left_anti")
    )


def open_clusters(
    listed: DataFrame, parts: DataFrame, done: DataFrame, percent: int, work: Workspace
) -> DataFrame:
    """Classes that may still link across components: ``rep``, ``n``, ``component``, ``cluster``
    and whether it is ``outside`` of its cluster's largest component.

    By size and place a class of a shingle may link with classes of a range of sizes. Where
    ranges overlap, neighbours in order of size are joined, so that any two classes that
    may link are in one cluster, by no more edges than there are classes.
    """
    postings = postings_of(listed, parts)
    mixed = mixed_lists(postings).filter(F.col("size") >= LONG_LIST).select("mixed_token")
    largest = F.floor((F.col("n") - F.col("place")) * (100 + percent) / percent) - F.col("n")
    order = Window.partitionBy("token").orderBy("low", "rep")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    edges = (
        postings.join(mixed, F.col("token") == F.col("mixed_token"))
        .withColumn("low", F.least("n", largest))
        .withColumn("high", F.greatest("n", largest))
        .withColumn("reach", reach)
        .withColumn("before", F.lag("component").over(order))
        .filter("low <= reach and component <> before")
        .select(F.col("component").alias("a"), F.col("before").alias("b"))
    )
    clusters = connected_components(edges, work).select(
        F.col("node").alias("part"), F.col("component").alias("cluster")
    )
    members = (
        listed.select("rep", "n")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select("rep", "n", F.coalesce("component", "rep").alias("component"))
        .join(clusters, F.col("component") == F.col("part"))
        .drop("part")
    )
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy(F.col("cluster").alias("main_cluster")).agg(
        F.max_by("component", F.struct("size", "component")).alias("main"),
        F.sum("size").alias("classes"),
    )
    rows = (
        members.join(main, F.col("cluster") == F.col("main_cluster"))
        .withColumn("outside", F.col("component") != F.col("main"))
        .select("rep", "n", "component", "cluster", "outside", "classes")
    )
    # Two classes whose pair is verified already need nothing more.
    two = rows.filter("classes = 2").groupBy("cluster").agg(
        F.min("rep").alias("a"), F.max("rep").alias("b")
    )
    closed = two.join(done, ["a", "b"], "left_semi").select("cluster")
    return rows.join(closed, "cluster", "left_anti").drop("classes")


def block_rows(words: int, percent: int) -> Callable:
    """Links between two blocks of a cluster, as a local component for each linked class."""
    none = np.zeros(CROWD_BUCKETS, np.uint8)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, low, high = (k.as_py() for k in key)
        ids, part, block, outside = (
            table.column(c).to_numpy() for c in ("rep", "component", "block", "outside")
        )
        texts = table.column("text")
        found = list(split(texts, NOT_SPACE, lower=True, limit=1 << 60))
        label = ids.copy()
        seen = np.zeros(len(ids), bool)
        for w in found:
            text, h, _ = ordered_sets(w, words, none)
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            common = common_counts(text, h, left, right, len(ids))
            size = np.bincount(text, minlength=len(ids))
            union = size[left][:, None] + size[right][None, :] - common
            good = (common > 0) & (common * 100 >= union * percent)
            good &= part[left][:, None] != part[right][None, :]
            good &= outside[left][:, None] | outside[right][None, :]
            x, y = np.nonzero(good)
            x, y = left[x], right[y]
            seen[x] = seen[y] = True
            while True:
                lower = label.copy()
                np.minimum.at(lower, x, label[y])
                np.minimum.at(lower, y, label[x])
                if np.array_equal(lower, label):
                    break
                label = lower
        return pa.table({"a": ids[seen], "b": label[seen]})

    return run


def common_counts(
    text: np.ndarray, h: np.ndarray, left: np.ndarray, right: np.ndarray, texts: int
) -> np.ndarray:
    """Common shingles of each text of ``left`` and each of ``right``, from (text, shingle) rows."""
    at_left, at_right = np.full(texts, -1), np.full(texts, -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    own, other = at_left[text] >= 0, at_right[text] >= 0
    a, ha = at_left[text[own]], h[own]
    b, hb = at_right[text[other]], h[other]
    order = np.argsort(hb, kind="stable")
    b, hb = b[order], hb[order]
    begin = np.searchsorted(hb, ha, side="left")
    count = np.searchsorted(hb, ha, side="right") - begin
    total = np.zeros(len(left) * len(right), np.int64)
    ends = np.concatenate([[0], np.cumsum(count)])
    for lo, hi in chunks(ends):
        n = count[lo:hi]
        row = np.repeat(a[lo:hi], n)
        where = np.repeat(begin[lo:hi] - ends[lo:hi] + ends[lo], n) + np.arange(n.sum())
        total += np.bincount(row * len(right) + b[where], minlength=len(total))
    return total.reshape(len(left), len(right))


def linked_in_blocks(
    texts: DataFrame, members: DataFrame, words: int, percent: int, work: Workspace
) -> DataFrame:
    """Links across components within each cluster, enough of them to unite what is linked.

    A cluster is dealt into blocks of bounded size; tasks compare pairs of blocks. Classes of
    the largest component are only compared with those outside of it.
    """
    blocks = F.greatest(
        F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)
    )
    sizes = members.groupBy(F.col("cluster").alias("c"), F.col("outside").alias("o")).agg(
        blocks.alias("blocks")
    )
    per_cluster = sizes.groupBy("c").agg(
        F.coalesce(F.max(F.when(F.col("o"), F.col("blocks"))), F.lit(0)).alias("out"),
        F.coalesce(F.max(F.when(~F.col("o"), F.col("blocks"))), F.lit(0)).alias("main"),
    )
    # Blocks of classes outside come first, so a pair of blocks has one of them.
    dealt = (
        members.join(per_cluster, F.col("cluster") == F.col("c"))
        .withColumn(
            "block",
            F.when(F.col("outside"), F.pmod(F.xxhash64("rep"), F.col("out"))).otherwise(
                F.col("out") + F.pmod(F.xxhash64("rep"), F.col("main"))
            ),
        )
        .withColumn(
            "partners",
            F.when(
                F.col("outside"), F.sequence(F.lit(0).cast("bigint"), F.col("out") + F.col("main") - 1)
            ).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("out") - 1)),
        )
        .select("rep", "component", "cluster", "outside", "block", "partners")
    )
    chosen = chosen_texts(texts, members.select("rep"), work)
    links = (
        chosen.join(dealt, F.col("id") == F.col("rep"))
        .withColumn("partner", F.explode("partners"))
        .withColumn("low", F.least("block", "partner"))
        .withColumn("high", F.greatest("block", "partner"))
        .select("cluster", "low", "high", "rep", "component", "outside", "block", "text")
        .groupBy("cluster", "low", "high")
        .applyInArrow(block_rows(words, percent), "a bigint, b bigint")
        .filter("a <> b")
        .distinct()
    )
    links = work.store(links, "links")
    work.drop(chosen)
    return links


def chosen_texts(texts: DataFrame, reps: DataFrame, work: Workspace) -> DataFrame:
    """Texts of about the documents ``reps``, by a bitmap that the reading tasks hold."""
    wanted = build_bitmap(reps.select(F.xxhash64("rep").alias("key")), "key")
    chosen = texts.select(
        "id", F.xxhash64("id").alias("key"), F.xxhash64("text").alias("row"), "text"
    ).mapInArrow(wanted_rows(wanted), "id bigint, text string")
    return work.store(chosen, "texts")


def verified(
    texts: DataFrame, pairs: DataFrame, words: int, percent: int, work: Workspace
) -> DataFrame:
    """The pairs whose whole sets are similar enough, from the texts of their documents."""
    reps = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    chosen = chosen_texts(texts, reps, work)
    left = chosen.select(F.col("id").alias("a"), F.col("text").alias("of_a"))
    right = chosen.select(F.col("id").alias("b"), F.col("text").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
    links = work.store(
        both.mapInArrow(similar_rows(words, percent), "a bigint, b bigint").distinct(), "links"
    )
    work.drop(chosen)
    return links
