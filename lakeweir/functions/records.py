"""Rows to message values and back."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default JSON formats stop at milliseconds; these keep microseconds.
JSON_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Type names of the JSON schema envelope.
ENVELOPE_TYPES = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "string": "string",
    "binary": "bytes",
}


def json_value(df: DataFrame) -> Column:
    """The whole row as one JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), JSON_FORMATS)


def to_records(df: DataFrame) -> DataFrame:
    """One keyless JSON message per row."""
    return df.select(json_value(df).alias("value"))


def fields_of(data: Column) -> Column:
    """The fields of a parsed struct as columns.

    ``inline`` keeps later filters above the parsing. With ``data.*`` they would
    be pushed below it, and every message would be parsed a second time there.
    """
    return F.inline(F.array(data))


def from_records(records: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Parse message values; a malformed message gives NULL fields, not an error.

    ``keep`` names message columns (such as ``offset``) to carry along.
    """
    data = F.from_json(F.col("value").cast("string"), schema, JSON_FORMATS)
    return records.select(fields_of(data), *keep)


def envelope_schema(schema: T.StructType) -> str:
    """The ``schema`` half of an envelope, as JSON text."""
    fields = []
    for field in schema.fields:
        name = field.dataType.simpleString()
        if name not in ENVELOPE_TYPES:
            raise ValueError(f"cast {field.name}: {name} has no envelope type")
        fields.append(
            {"type": ENVELOPE_TYPES[name], "optional": field.nullable, "field": field.name}
        )
    return json.dumps({"type": "struct", "fields": fields, "optional": False})


def to_envelopes(df: DataFrame) -> DataFrame:
    """One message per row holding the schema beside the payload."""
    payload = F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]),
        {**JSON_FORMATS, "ignoreNullFields": "false"},
    )
    head = F.lit('{"schema":' + envelope_schema(df.schema) + ',"payload":')
    return df.select(F.concat(head, payload, F.lit("}")).alias("value"))


def from_envelopes(
    records: DataFrame, schema: T.StructType, keep: Iterable[str] = ()
) -> DataFrame:
    """Read the payload of enveloped messages."""
    wrapper = T.StructType([T.StructField("payload", schema)])
    parsed = F.from_json(F.col("value").cast("string"), wrapper, JSON_FORMATS)
    return records.select(fields_of(parsed["payload"]), *keep)
