from __future__ import annotations

import json
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeweir.functions.records import (
    envelope_schema,
    from_envelopes,
    from_records,
    to_envelopes,
    to_records,
)
from lakeweir.functions.stamps import stamp
from lakeweir.schemas import EVENT_RESULTS
from tests.helpers import plan_of, struct

SMALL = struct(a="string", n="integer", b="boolean")


@pytest.mark.parametrize(
    "value,fields",
    [
        ('{"a":"x","n":1,"b":true}', ("x", 1, True)),
        ("{bad", (None, None, None)),
        ('{"a":"x","n":"7","b":"true"}', ("x", None, None)),
        ('{"a":"x","n":1.5,"b":1}', ("x", None, None)),
        (None, (None, None, None)),
        ("{}", (None, None, None)),
        ('{"A":"up"}', (None, None, None)),
        ('{"a":"x","n":1', (None, None, None)),
    ],
)
def test_parse(spark, value, fields):
    df = spark.createDataFrame([(value, 9)], "value string, offset long")
    df = df.withColumn("value", F.col("value").cast("binary"))
    assert from_records(df, SMALL).collect() == [fields]
    assert from_records(df, SMALL, keep=["offset"]).collect() == [(*fields, 9)]


def test_null_fields_are_left_out(spark):
    df = spark.createDataFrame([("x", None, True)], SMALL)
    assert to_records(df).first()["value"] == '{"a":"x","b":true}'


def test_microseconds_survive(spark):
    moment = datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(moment, moment)], "t timestamp, n timestamp_ntz")
    assert from_records(to_records(df), df.schema).collect() == df.collect()


text = st.text(st.characters(exclude_categories=["Cs"]), max_size=12)
event = st.tuples(
    *[
        st.one_of(
            st.none(),
            {
                "string": text,
                "int": st.integers(-(2**31), 2**31 - 1),
                "boolean": st.booleans(),
            }[f.dataType.simpleString()],
        )
        for f in EVENT_RESULTS.fields
    ]
)


@settings(max_examples=15, deadline=None)
@given(st.lists(event, min_size=1, max_size=20))
def test_round_trip(spark, rows):
    df = spark.createDataFrame(rows, EVENT_RESULTS).coalesce(1)
    assert from_records(to_records(df), EVENT_RESULTS).collect() == df.collect()


def test_envelope(spark):
    schema = struct(id="long", s="string", d="double", i="integer", b="boolean", f="float")
    df = spark.createDataFrame([(1, "ä\"", 2.5, 3, True, 0.5), (None,) * 6], schema).coalesce(1)
    messages = to_envelopes(df)
    first = json.loads(messages.first()["value"])
    assert first["payload"] == {"id": 1, "s": 'ä"', "d": 2.5, "i": 3, "b": True, "f": 0.5}
    assert [f["type"] for f in first["schema"]["fields"]] == [
        "int64", "string", "double", "int32", "boolean", "float"]
    assert from_envelopes(messages, schema).collect() == df.collect()


def test_envelope_needs_known_types():
    with pytest.raises(ValueError, match="no envelope type"):
        envelope_schema(struct(t="timestamp"))


def test_envelope_without_payload_gives_nulls(spark):
    df = spark.createDataFrame([('{"schema":{}}',), ("junk",)], "value string")
    assert from_envelopes(df, SMALL).collect() == [(None, None, None)] * 2


def test_one_stamp_per_query(spark):
    stamps = stamp(spark.range(0, 1000, 1, 8)).select("timestamp").distinct().collect()
    assert len(stamps) == 1 and stamps[0][0] is not None


def test_messages_are_parsed_once(spark):
    df = spark.createDataFrame([('{"a":"x"}',)], "value string")
    kept = from_records(df, SMALL).filter(F.col("a").isNotNull()).groupBy("a").count()
    assert plan_of(kept, "simple").count("from_json") == 1
