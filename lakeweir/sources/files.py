"""CSV, Parquet and line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


# Classes of a text by the narrowest type that holds it. Numbers widen upwards.
INT, LONG, DECIMAL, DOUBLE = 1, 2, 3, 4
DATE, TIMESTAMP = 1, 2
# The classes of each family as bits of one number.
FAMILIES = {
    "number": {INT: 1, LONG: 2, DECIMAL: 4, DOUBLE: 8},
    "time": {DATE: 16, TIMESTAMP: 32},
    "truth": {1: 64},
    "other": {1: 128},
}
# A whole number beyond bigint has 19 digits or more and sets the bit of its digits, too.
LEAST_DIGITS, MOST_DIGITS, FIRST_DIGITS_BIT = 19, 38, 8
# All that a cast to double takes, and little else.
DOUBLE_SHAPE = (
    "^[\\x00-\\x20]*+[+-]?(?:(?:[0-9]++[.]?[0-9]*+|[.][0-9]++)(?:[eE][+-]?[0-9]++)?[fFdD]?"
    "|0[xX][0-9a-fA-F.]++[pP][+-]?[0-9]++[fFdD]?|(?i:nan|inf|infinity))[\\x00-\\x20]*+$"
)


def text_class(text: Column) -> Column:
    """The bit of a text's class, and for a whole number beyond ``bigint`` that of its digits.

    The families are those of Spark's inference: a text is a number, a day or time, a truth value or
    something else, in this order. An empty text is NULL and has no class.

    A cast of a number that fails raises an error inside Spark, which takes some ten times as long as
    the other tests together. So texts are cast to a number only where their shape promises success.
    """
    text = F.nullif(text, F.lit(""))
    number, time = FAMILIES["number"], FAMILIES["time"]
    digits = F.length(F.regexp_replace(text, "^[+-]?0*", ""))
    digits_bit = F.call_function("shiftleft", F.lit(1), digits - (LEAST_DIGITS - FIRST_DIGITS_BIT))
    value = text.try_cast("bigint")
    whole = (
        F.when(F.length(text) <= 9, number[INT])
        .when(
            (F.length(text) <= 18) | (digits <= 19),
            F.when(value.between(-(1 << 31), (1 << 31) - 1), number[INT])
            .when(value.isNotNull(), number[LONG])
            .otherwise(digits_bit + number[DECIMAL]),
        )
        .when(digits <= MOST_DIGITS, digits_bit + number[DECIMAL])
        .otherwise(number[DOUBLE])
    )
    return (
        F.when(text.rlike("^[+-]?[0-9]+(?:\\r\\n?|\\n)?\\z"), whole)
        .when(text.rlike(DOUBLE_SHAPE) & text.try_cast("double").isNotNull(), number[DOUBLE])
        .when(~text.contains(":") & text.try_cast("date").isNotNull(), time[DATE])
        .when(text.try_cast("timestamp").isNotNull(), time[TIMESTAMP])
        .when(F.lower(text).isin("true", "false"), FAMILIES["truth"][1])
        .when(text.isNotNull(), FAMILIES["other"][1])
    )


def highest(bits: int, family: str) -> int | None:
    """The highest class of a family among the bits of a column's texts."""
    return max((c for c, bit in FAMILIES[family].items() if bits & bit), default=None)


def most_digits(bits: int) -> int | None:
    digits = bits >> FIRST_DIGITS_BIT
    return LEAST_DIGITS + digits.bit_length() - 1 if digits else None


def type_of(number: int | None, digits: int | None, time: int | None, truth: int | None,
            other: int | None) -> str:
    """The type that holds all texts of a column, from the highest class in each family."""
    if other or sum(family is not None for family in (number, time, truth)) != 1:
        return "string"
    if number:
        return {INT: "int", LONG: "bigint", DECIMAL: f"decimal({max(digits or 0, 20)},0)",
                DOUBLE: "double"}[number]
    if time:
        return "date" if time == DATE else "timestamp"
    return "boolean"


def read_csv_once(spark: SparkSession, path: str, copy: str) -> DataFrame:
    """CSV with a header and inferred types, parsed in one pass.

    The pass stores the texts as Parquet at ``copy`` and observes the classes in each column on the
    way. Their union is the same however often a task is repeated. The copy is then cast as it is read.
    Types are those of Spark's inference; days and times are in Spark's default formats.
    """
    texts = spark.read.option("header", True).csv(path)
    unions = [
        F.bit_or(text_class(F.col(quoted(name)))).alias(f"bits_{place}")
        for place, name in enumerate(texts.columns)
    ]
    if not unions:
        return texts
    seen = Observation("classes")
    texts.observe(seen, *unions).write.mode("overwrite").parquet(copy)
    found = seen.get
    types = []
    for place in range(len(texts.columns)):
        bits = found.get(f"bits_{place}") or 0
        number, time, truth, other = (highest(bits, family) for family in FAMILIES)
        types.append(type_of(number, most_digits(bits), time, truth, other))
    stored = spark.read.schema(texts.schema).parquet(copy)
    return stored.select(
        *[
            F.col(quoted(name)).try_cast(kind).alias(name)
            for name, kind in zip(texts.columns, types)
        ]
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_line_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of messages, one per line of the text files below ``path``."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(F.col("value").cast("binary").alias("value"))
