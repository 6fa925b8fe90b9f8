from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def struct(**fields: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


def plan_of(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
