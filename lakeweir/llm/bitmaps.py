"""A set of hashes as a bitmap of fixed size that every task can hold.

The size does not depend on the data, so it may be broadcast at any scale. A
bitmap only says "surely not in the set" or "perhaps": what passes is always
decided by an exact join or aggregate afterwards. The fuller the bitmap, the
less it saves; the result stays the same.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB
PART = 15  # log2 of the bits in one row of Spark's bitmap aggregate


def build_bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> Broadcast:
    """Broadcast bitmap of the lowest ``bits`` bits of a column of longs.

    Rows are dealt by the part of the bitmap they belong to, so each part is
    made in one task and the driver receives the fixed number of parts.
    """
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    parts = (
        hashes.select(place.alias("place"))
        .withColumn("part", F.shiftright("place", PART))
        .repartition("part")
        .groupBy("part")
        .agg(
            F.bitmap_construct_agg(
                F.col("place").bitwiseAND(F.lit((1 << PART) - 1))
            ).alias("bitmap")
        )
    )
    whole = np.zeros(1 << max(bits - 3, PART - 3), np.uint8)
    width = 1 << (PART - 3)
    for row in parts.toLocalIterator():
        whole[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(
            row["bitmap"], np.uint8
        )
    return hashes.sparkSession.sparkContext.broadcast(whole)


def perhaps_in(bitmap: np.ndarray, h: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether each unsigned hash may be in the set."""
    place = h & np.uint64((1 << bits) - 1)
    byte = bitmap[(place >> np.uint64(3)).astype(np.int64)]
    return (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
