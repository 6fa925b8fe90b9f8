"""Running averages of a message stream joined with a static table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.numeric import valid_measures
from lakeweir.functions.records import from_records
from lakeweir.functions.stamps import stamp
from lakeweir.operators.averages import average_joined
from lakeweir.operators.joins import BROADCAST_BYTES
from lakeweir.schemas import EVENT_RESULTS, GROUP_KEYS

MEASURES = {"avg_height": "height", "avg_weight": "weight"}


def build_enriched_stream(
    records: DataFrame,
    bio: DataFrame,
    schema: T.StructType = EVENT_RESULTS,
    on: str = "athlete_id",
    bio_on: str | None = None,
    event_keys: Iterable[str] = ("sport", "medal", "country_noc"),
    bio_keys: Iterable[str] = ("sex",),
    output_keys: Iterable[str] = GROUP_KEYS,
    measures: Mapping[str, str] = MEASURES,
    backlog: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    bio_copy: str | None = None,
) -> DataFrame:
    """Messages to stamped running averages; the same plan serves a batch of messages.

    The country is that of the event. Rows of ``bio`` without valid measures
    are dropped before the join. With ``bio_copy`` what the join needs of
    ``bio`` is stored at that path once, instead of being read for every batch. ``backlog`` are
    the messages there are by now, as a batch: if ``bio`` is too large to broadcast, keys that are
    heavy there are dealt over several tasks.
    """
    # Only fields that are used are parsed.
    used = {on, *event_keys}
    narrowed = T.StructType([field for field in schema.fields if field.name in used])
    if backlog is not None:
        key = T.StructType([schema[on]])
        backlog = from_records(backlog, key)
    averages = average_joined(
        from_records(records, narrowed, keep=["offset"]),
        valid_measures(bio, measures.values()),
        on=on,
        dim_on=bio_on or on,
        fact_keys=event_keys,
        dim_keys=bio_keys,
        measures=measures,
        place=F.col("offset"),
        backlog=backlog,
        broadcast_limit=broadcast_limit,
        dim_copy=bio_copy,
    )
    return stamp(averages.select(*output_keys, *measures))
