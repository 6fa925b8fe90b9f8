"""Labelled rows: held-out split and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; NULL for a null id."""
    return F.crc32(id_.cast("string")) % modulus


def hash_sample(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows, or all if there are fewer, chosen by a hash of the id.

    Running it again gives the same rows.
    """
    share = min(1.0, rows / max(df.count(), 1))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30))
    return df.filter(draw < F.lit(int(share * (1 << 30))))


def held_out(id_: Column, modulus: int, value: int) -> Column:
    """Rows kept from learning; a null id is not held out, as it has no label."""
    return F.coalesce(remainder(id_, modulus) == value, F.lit(False))
