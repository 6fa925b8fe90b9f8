"""Rows of a table by a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.storage import Workspace
from lakeweir.operators.joins import fits_broadcast

BROADCAST_BYTES = 32 << 20


def without(documents: DataFrame, gone: DataFrame, keys: dict[str, F.Column]) -> DataFrame:
    """Rows of ``documents`` that are not listed in ``gone``.

    ``keys`` gives for each column of ``gone`` the expression it is compared with; nulls are equal.
    The list is stored, measured and broadcast within a limit; beyond it both sides are shuffled.
    """
    gone = Workspace(documents.sparkSession, "selection").store(gone.distinct(), "gone")
    if fits_broadcast(gone, BROADCAST_BYTES):
        gone = F.broadcast(gone)
    same = [gone[name].eqNullSafe(column) for name, column in keys.items()]
    return documents.join(gone, same, "left_anti")
