"""Numeric casts, measure checks, rounding and averages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 2


def to_number(column: Column | str, data_type: str = "float", nan_as_null: bool = False) -> Column:
    """Cast text to a number; what is not a number becomes NULL, never an error."""
    column = F.col(column) if isinstance(column, str) else column
    number = column.try_cast(data_type)
    return F.when(~F.isnan(number), number) if nan_as_null else number


def valid_measures(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Rows whose measures are all present and not NaN.

    The NULL test stays on the bare column so that it reaches the scan. Text
    that is no number is neither NULL nor NaN and is kept, and a later average
    skips it; ``strict`` drops such rows too.
    """
    tests = []
    for name in columns:
        column = F.col(name)
        tests.append(column.isNotNull())
        data_type = df.schema[name].dataType
        if isinstance(data_type, T.StringType):
            number = to_number(column, "double")
            tests.append(~F.isnan(number))
            if strict:
                tests.append(number.isNotNull())
        elif isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
            tests.append(~F.isnan(column))
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def round_half_up(column: Column | str, places: int = PLACES) -> Column:
    return F.round(column, places)


# A measure is added as whole number, four and five further decimals.
MID, LOW = 10**4, 10**5
LARGEST = 9e18
PARTS = ("whole", "mid", "low", "odd", "n")


def exact_sums(column: Column | str) -> dict[str, Column]:
    """Aggregates that add up a measure by integers, so the order of rows cannot show.

    The integers hold nine decimals. ``odd`` adds what they cannot hold: NaN, infinities,
    measures of ``LARGEST`` or more, and what a measure has beyond its ninth decimal. ``n`` counts what
    is a number.
    """
    column = F.col(column) if isinstance(column, str) else column
    number = column.try_cast("double")
    held = ~F.isnan(number) & (F.abs(number) < F.lit(LARGEST))
    floor = F.floor(number)
    rest = F.when(held, F.rint((number - floor) * float(MID * LOW)))
    # The double nearest to the nine decimals, so 0.1 has nothing beyond them.
    beyond = number - (floor + rest / float(MID * LOW))
    rest = rest.cast("bigint")
    return {
        "whole": F.sum(F.when(held, floor)),
        "mid": F.sum(F.call_function("div", rest, F.lit(LOW))),
        "low": F.sum(rest % LOW),
        "odd": F.sum(F.when(~held, number).when(beyond != 0, beyond)),
        "n": F.count(number),
    }


def carried(sums: dict[str, Column]) -> dict[str, Column]:
    """The same sums with ``low`` and ``mid`` below their limits, fit to be added up again."""
    mid = sums["mid"] + F.call_function("div", sums["low"], F.lit(LOW))
    return {
        **sums,
        "whole": sums["whole"] + F.call_function("div", mid, F.lit(MID)),
        "mid": mid % MID,
        "low": sums["low"] % LOW,
    }


def rounded_ratio(sums: dict[str, Column], places: int = PLACES) -> Column:
    """Average from the sums of ``exact_sums``, rounded half up; NULL without numbers.

    Decimals beyond the ninth are added as one double and kept to the eighteenth. Beside measures
    too large for integers the average is one of doubles, as of Spark's ``avg``.
    """

    def decimal(part: Column, unit: str) -> Column:
        return part.cast("decimal(20,0)") * F.lit(unit).cast("decimal(10,9)")

    odd = sums["odd"]
    total = (
        sums["whole"].cast("decimal(20,0)")
        + decimal(sums["mid"], "0.0001")
        + decimal(sums["low"], "0.000000001")
    )
    n = sums["n"].cast("decimal(20,0)")
    small = F.abs(odd) < 1.0
    # What lies beyond nine decimals is divided alone, as both together need more digits than a decimal has.
    tail = F.when(small, odd / sums["n"]).cast("decimal(38,24)")
    average = F.try_divide(total, n)
    average = average.cast("decimal(38,18)") + F.coalesce(tail.cast("decimal(28,18)"), F.lit(0))
    large = F.try_divide(F.coalesce(total.cast("double"), F.lit(0.0)) + odd, sums["n"])
    return F.when(odd.isNull() | small, F.round(average, places).cast("double")).otherwise(
        F.round(large, places)
    )


def rounded_average(column: Column | str, places: int = PLACES) -> Column:
    """Average that skips NULL, propagates NaN and rounds half up, whatever the partitioning."""
    return rounded_ratio(exact_sums(column), places)
