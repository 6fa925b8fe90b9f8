"""Dimension joins.

A dimension is broadcast only after its size has been measured. Beyond the
limit both sides are shuffled on the key. The rows of keys heavier than an even share of
the shuffle are dealt over several tasks, as many as the key holds shares, and their partners
are sent to each of these. Heavy keys are found by a mergeable sketch, in the same pass
that measures a dimension, and in one pass over the key of a fact.

A stream is joined with a stored copy of the dimension that lies in sorted buckets of key and
salt, so that no micro-batch shuffles it. Its heavy keys are those of the backlog when it first starts; they
are stored with the copy.

Adaptive skew splitting stays on as well, but is not relied on: it compares
bytes, and a partition of equal keys compresses so well that it can hold a third
of all rows and pass for a small one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.operators.buckets import bucketed_copy
from lakeweir.session import scratch_path
from lakeweir.sinks.files import is_stored, snapshot

BROADCAST_BYTES = 64 << 20
SALT = "__salt"
PLACE = "__place"
HOT = "__hot"
OTHER_HOT = "__other_hot"
SALTS = "__salts"
OTHER_SALTS = "__other_salts"


def width_of(df: DataFrame) -> Column | None:
    """Bytes of a row as counted from its types and texts, or None if a type has no simple size."""
    fixed = 0
    texts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
        fixed += 16
    return reduce(Column.__add__, texts, F.lit(fixed)).cast("bigint")


def measured_bytes(df: DataFrame) -> int | None:
    """Size of the rows as counted by one aggregate, or None if it cannot be told."""
    width = width_of(df)
    if width is None:
        return None
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).collect()[0]["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True when the measured size of a static table is within ``limit``."""
    if df.isStreaming or limit <= 0:
        return False
    size = measured_bytes(df)
    return size is not None and size <= limit


@dataclass(frozen=True)
class Profile:
    """What one pass over a side tells: its bytes, and its heavy keys with the shares each holds."""

    bytes: int | None
    hot: list[tuple]


# Types whose values the sketch can hold; keys of other types are counted by an aggregate.
SKETCHED = (
    T.BooleanType, T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
)
LARGEST_SKETCH = 1_000_000


def profile(df: DataFrame, on: str, tasks: int) -> Profile:
    """Size of a table, and its keys with more rows than an even share of ``tasks``.

    The sketch holds 16 items per task, so its counts are off by less than a quarter of a share
    and no such key is missed; a key just below a share may be listed too. There are fewer
    than ``2 * tasks`` of them, whatever the size of the table.
    """
    width = width_of(df)
    size = F.lit(None).cast("bigint") if width is None else F.coalesce(F.sum(width), F.lit(0))
    rows = F.count(F.col(on))
    if not isinstance(df.schema[on].dataType, SKETCHED):
        row = df.agg(size.alias("bytes"), rows.alias("rows")).collect()[0]
        return Profile(row["bytes"], counted_hot_keys(df, on, max(1, -(-row["rows"] // tasks))))
    items = min(LARGEST_SKETCH, max(1024, 16 * tasks))
    top = F.call_function("approx_top_k", F.col(on), F.lit(min(2 * tasks + 1, items)), F.lit(items))
    row = df.agg(size.alias("bytes"), rows.alias("rows"), top.alias("top")).collect()[0]
    share = max(1, -(-row["rows"] // tasks))
    hot = [
        (r["item"], -(-r["count"] // share))
        for r in row["top"]
        if r["item"] is not None and r["count"] > share
    ]
    return Profile(row["bytes"], hot)


def counted_hot_keys(df: DataFrame, on: str, share: int) -> list[tuple]:
    counts = df.filter(F.col(on).isNotNull()).groupBy(F.col(on).alias(HOT))
    hot = counts.agg(F.count("*").alias("rows")).filter(F.col("rows") > share).collect()
    return [(r[HOT], -(-r["rows"] // share)) for r in hot]


def hot_list(df: DataFrame, on: str, hot: list[tuple]) -> DataFrame:
    """Heavy keys as a table of ``HOT`` and ``SALTS``."""
    schema = T.StructType(
        [T.StructField(HOT, df.schema[on].dataType), T.StructField(SALTS, T.LongType())]
    )
    return df.sparkSession.createDataFrame(hot, schema)


def salted(
    df: DataFrame,
    on: str,
    own: DataFrame | None,
    other: DataFrame | None,
    first: bool,
    place: Column | None = None,
) -> DataFrame:
    """Rows of keys that are hot here are dealt over the key's salts by their place; rows
    of keys that are hotter on the other side go to all of them.

    The place is that within the reading task, so equal rows are dealt out as well. A task that reads
    files again finds its rows in the same places. A table whose tasks may
    see other orders when repeated should be stored before.
    """
    none = F.lit(1).cast("bigint")
    if own is None and other is None:
        return df.withColumn(SALT, F.lit(0).cast("bigint"))
    df = df.withColumn(PLACE, F.monotonically_increasing_id() if place is None else place)
    mine = theirs = none
    if own is not None:
        df = df.join(F.broadcast(own), F.col(on) == F.col(HOT), "left")
        mine = F.coalesce(F.col(SALTS), none)
    if other is not None:
        other = other.withColumnsRenamed({HOT: OTHER_HOT, SALTS: OTHER_SALTS})
        df = df.join(F.broadcast(other), F.col(on) == F.col(OTHER_HOT), "left")
        theirs = F.coalesce(F.col(OTHER_SALTS), none)
    deals = mine >= theirs if first else mine > theirs
    # Keys may come in a rhythm, so places are hashed.
    one = F.array(F.pmod(F.xxhash64(F.col(PLACE)), mine))
    every = F.sequence(F.lit(0).cast("bigint"), theirs - 1)
    df = df.withColumn(SALT, F.explode(F.when(deals, one).otherwise(every)))
    return df.drop(PLACE, HOT, SALTS, OTHER_HOT, OTHER_SALTS)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread_hot_keys(
    fact: DataFrame, dim: DataFrame, on: str, dim_on: str, hot_dim: list[tuple] | None = None
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with a salt, so that no task of their join gets a whole hot key.

    Of a key that is hot on both sides the heavier side is dealt out. The lists of hot keys are
    compared by the same equality as the join, so the key types may differ. None if nothing
    is hot. ``hot_dim`` saves the pass over a dimension that has been profiled.
    """
    width = shuffle_width(fact)
    if hot_dim is None:
        hot_dim = profile(dim, dim_on, width).hot
    hot = (profile(fact, on, width).hot, hot_dim)
    if hot == ([], []):
        return None
    sides = ((fact, on), (dim, dim_on))
    lists = [hot_list(df, key, keys) if keys else None for (df, key), keys in zip(sides, hot)]
    return salted(fact, on, *lists, first=True), salted(dim, dim_on, *lists[::-1], first=False)


def stored_hot_keys(df: DataFrame | None, on: str, path: str, known: list[tuple] | None = None):
    """Hot keys as they were when ``path`` was first asked for, or None if there are none."""
    if df is None:
        return None
    keys = hot_list(df, on, [])
    if not is_stored(keys, path):
        hot = profile(df, on, shuffle_width(df)).hot if known is None else known
        keys = hot_list(df, on, hot)
    stored = snapshot(keys.coalesce(1), path)
    return None if stored.isEmpty() else stored


def stream_sides(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    dim_on: str,
    place: Column,
    copy: str,
    backlog: DataFrame | None = None,
    hot_dim: list[tuple] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A stream and a static table, both with a salt, the table stored in buckets of key and salt.

    ``backlog`` is a batch of the stream's rows, in which its heavy keys are looked for. ``place`` must be
    an integer of the row itself (such as a message offset), so a task that runs again sends every
    row to the same salt. What lies at ``copy`` already is used as it is, hot keys included.
    """
    copy = copy.rstrip("/")
    hot_fact = stored_hot_keys(backlog, on, f"{copy}/hot-fact")
    hot_here = stored_hot_keys(dim, dim_on, f"{copy}/hot-dim", hot_dim)
    dim = salted(dim, dim_on, hot_here, hot_fact, first=False)
    stored = bucketed_copy(dim, [dim_on, SALT], f"{copy}/rows", shuffle_width(dim))
    return salted(fact, on, hot_fact, hot_here, first=True, place=place), stored


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    dim_on: str | None = None,
    place: Column | None = None,
    backlog: DataFrame | None = None,
    dim_copy: str | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of ``fact`` with a static ``dim``.

    With ``dim_on`` the keys are compared and both are kept; without it the
    key is emitted once. The sides are aliased ``fact`` and ``dim``, so shared
    column names stay selectable as ``fact.x`` and ``dim.x``. NULL keys never
    match. Select the needed columns before calling: only those are measured.

    For a stream and a dimension beyond the limit ``place``, ``backlog`` and ``dim_copy`` are those
    of ``stream_sides``; the copy lies in the scratch folder if no path is given.
    """
    key = dim_on or on
    known = Profile(None, [])
    if broadcast_limit > 0 or not fact.isStreaming:
        known = profile(dim, key, shuffle_width(dim))
    if known.bytes is not None and known.bytes <= broadcast_limit:
        return _join(fact, F.broadcast(dim), on, dim_on, False)
    if fact.isStreaming:
        copy = dim_copy or scratch_path(fact.sparkSession, "dim")
        if place is None:
            place = F.lit(0)
        hot = known.hot if broadcast_limit > 0 else None
        sides = stream_sides(fact, dim, on, key, place, copy, backlog, hot)
    else:
        sides = spread_hot_keys(fact, dim, on, key, known.hot)
    if sides is None:
        return _join(fact, dim.hint("merge"), on, dim_on, False)
    return _join(sides[0], sides[1].hint("merge"), on, dim_on, True)


def _join(
    fact: DataFrame, dim: DataFrame, on: str, dim_on: str | None, salted: bool
) -> DataFrame:
    left, right = fact.alias("fact"), dim.alias("dim")
    if dim_on is None:
        return left.join(right, on=[on, SALT] if salted else [on], how="inner").drop(SALT)
    condition = F.col(f"fact.{on}") == F.col(f"dim.{dim_on}")
    if not salted:
        return left.join(right, condition, "inner")
    condition &= F.col(f"fact.{SALT}") == F.col(f"dim.{SALT}")
    joined = left.join(right, condition, "inner")
    return joined.drop(F.col(f"fact.{SALT}"), F.col(f"dim.{SALT}"))
