"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.operators.joins import BROADCAST_BYTES, fits_broadcast
from lakeweir.session import scratch_path
from lakeweir.sources.files import quoted


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows (NULL equals NULL, NaN equals NaN, 0.0 equals -0.0).

    The plan is a partial and a final aggregate, so copies within a map task
    are gone before the shuffle.
    """
    return df.dropDuplicates()


DIGEST = "__digest"


def drop_wide_duplicate_rows(
    df: DataFrame, broadcast_limit: int = BROADCAST_BYTES
) -> DataFrame:
    """As ``drop_duplicate_rows``, for wide rows of which few repeat.

    64-bit digests of the rows are counted first. Rows whose digest is alone stay where they are; only
    those whose digest repeats are shuffled whole and compared, so digests that meet by chance remove
    nothing. The repeated digests are stored and broadcast. If their measured size is beyond
    ``broadcast_limit``, much of the table repeats and all rows are compared. ``df`` is read three times
    and must not change meanwhile; a column ``__digest`` of its own is refused.
    """
    if "collate" in df.schema.simpleString():  # hashes tell apart what such texts hold equal
        return drop_duplicate_rows(df)
    if DIGEST in df.columns:
        raise ValueError(f"{DIGEST} is taken")
    spark = df.sparkSession
    columns = [df[quoted(name)] for name in df.columns]
    # Hashing skips NULLs, which would give moved NULLs one digest.
    digest = F.xxhash64(*[part for c in columns for part in (c.isNull(), c)])
    marked = df.withColumn(DIGEST, digest)
    path = scratch_path(spark, "digests")
    marked.groupBy(DIGEST).agg(F.count("*").alias("n")).filter("n > 1").select(
        DIGEST
    ).write.parquet(path)
    repeated = spark.read.parquet(path)
    if not fits_broadcast(repeated, broadcast_limit):
        return drop_duplicate_rows(df)
    alone = marked.join(F.broadcast(repeated), DIGEST, "left_anti").drop(DIGEST)
    several = marked.join(F.broadcast(repeated), DIGEST, "left_semi").drop(DIGEST)
    return alone.union(drop_duplicate_rows(several))


def latest_by_key(
    changes: DataFrame,
    keys: Iterable[str],
    version: str | Iterable[str] = ("batch_id", "timestamp"),
) -> DataFrame:
    """The newest row per key of a change log, exactly one.

    ``max`` of a struct combines inside the map tasks, so a key with many
    versions is never collected in one place as a window would do. ``version`` may be several
    columns; those the table lacks are left out. A replayed batch repeats its number but
    has a later ``timestamp``. Of rows equal in all of them one is taken whole.
    """
    keys = list(keys)
    version = [version] if isinstance(version, str) else list(version)
    version = [c for c in version if c in changes.columns]
    rest = [c for c in changes.columns if c not in (*keys, *version)]
    newest = F.max(F.struct(*version, *rest)).alias("newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "newest.*")
