"""Group averages, alone and over a dimension join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.functions.numeric import (
    PARTS,
    PLACES,
    carried,
    exact_sums,
    rounded_average,
    rounded_ratio,
)
from lakeweir.operators.joins import BROADCAST_BYTES, SALT, fits_broadcast, stream_sides
from lakeweir.session import scratch_path
from lakeweir.sinks.files import snapshot

KEY = "__key"
ROWS = "__rows"


def average_by(
    df: DataFrame,
    keys: Iterable[str],
    measures: Mapping[str, str],
    places: int = PLACES,
) -> DataFrame:
    """Rounded averages per group; ``measures`` maps output name to column.

    Works on a table and, as a running aggregate, on a stream. NULL is a key
    like any other.
    """
    aggregates = [
        rounded_average(column, places).alias(name) for name, column in measures.items()
    ]
    return df.groupBy(*keys).agg(*aggregates)


def collapse(dim: DataFrame, keys: Iterable[str], measures: Mapping[str, str]) -> DataFrame:
    """One row per key with the exact sums of every measure."""
    parts = []
    for name, column in measures.items():
        sums = carried(exact_sums(column))
        parts += [sums[part].alias(f"__{part}_{name}") for part in PARTS]
    return dim.groupBy(*keys).agg(*parts)


def average_joined(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    dim_on: str,
    fact_keys: Iterable[str],
    dim_keys: Iterable[str],
    measures: Mapping[str, str],
    places: int = PLACES,
    place: Column | None = None,
    backlog: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    dim_copy: str | None = None,
) -> DataFrame:
    """Averages of ``dim`` measures over ``fact JOIN dim``, grouped by keys of both sides.

    An average needs only sums and counts, so the pairs of the join are never
    spelled out more than necessary. The dimension is collapsed to one row per
    join key and group before the join. If it then fits a broadcast, the fact
    side is not shuffled at all. If not, a batch fact is collapsed as well, to
    one counted row per join key and group: a key that holds a third of all
    rows shrinks inside the map tasks, before the shuffle. A streaming fact
    cannot be aggregated twice: its heavy keys are salted by ``place``, and the dimension is
    stored in buckets, which no micro-batch shuffles (``stream_sides``).

    With ``dim_copy`` the collapsed dimension is stored at that path now and read
    from there, so the micro-batches of a stream do not each read and collapse
    the dimension again.
    """
    fact_keys, dim_keys = list(fact_keys), list(dim_keys)
    columns = dict.fromkeys([*dim_keys, *measures.values()])
    dim = dim.filter(F.col(dim_on).isNotNull()).select(F.col(dim_on).alias(KEY), *columns)
    parts = collapse(dim, [KEY, *dim_keys], measures)
    if dim_copy:
        parts = snapshot(parts, dim_copy)
    small = fits_broadcast(parts, broadcast_limit)
    carried = [F.col(on).alias(KEY), *fact_keys]
    rows = fact.filter(F.col(on).isNotNull())

    join_keys = [KEY]
    if small:
        rows = rows.select(*carried, F.lit(1).cast("bigint").alias(ROWS))
        parts = F.broadcast(parts)
    elif fact.isStreaming:
        copy = f"{dim_copy.rstrip('/')}-dealt" if dim_copy else scratch_path(fact.sparkSession, "dim")
        if backlog is not None:
            backlog = backlog.select(F.col(on).alias(KEY))
        place = F.lit(0) if place is None else place
        rows = rows.select(*carried, place.alias("__offset"))
        rows, parts = stream_sides(rows, parts, KEY, KEY, F.col("__offset"), copy, backlog)
        join_keys.append(SALT)
        rows = rows.select(KEY, *fact_keys, SALT, F.lit(1).cast("bigint").alias(ROWS))
    else:
        rows = rows.select(*carried).groupBy(KEY, *fact_keys).agg(F.count("*").alias(ROWS))

    if not small:
        parts = parts.hint("merge")  # compressed files can look small enough to broadcast
    weight = F.col(ROWS)
    averages = [
        rounded_ratio(
            {part: F.sum(F.col(f"__{part}_{name}") * weight) for part in PARTS}, places
        ).alias(name)
        for name in measures
    ]
    return rows.join(parts, join_keys, "inner").groupBy(*fact_keys, *dim_keys).agg(*averages)
