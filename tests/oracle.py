"""Compare registered queries with their SQL equivalents run by DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def kinds(rows: list[tuple]) -> list[set[str]]:
    return [{type(v).__name__ for v in column if v is not None} for column in zip(*rows)]


def difference(df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or None. Columns are matched by name, rows in any order."""
    names = sorted(df.columns)
    spark_rows = [tuple(plain(r[n]) for n in names) for r in df.collect()]
    result = con.execute(sql)
    found = [d[0] for d in result.description]
    if sorted(found) != names:
        return f"columns {names} against {sorted(found)}"
    order = [found.index(n) for n in names]
    sql_rows = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows against {len(sql_rows)}"
    if kinds(spark_rows) != kinds(sql_rows):
        return f"types {kinds(spark_rows)} against {kinds(sql_rows)}"
    left, right = Counter(spark_rows), Counter(sql_rows)
    if left != right:
        extra, missing = left - right, right - left
        return f"{sum(extra.values())} rows differ: {list(extra)[:2]} against {list(missing)[:2]}"
    return None


def main() -> int:
    from lakeweir.queries import ALL
    from lakeweir.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:] or list(ALL)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    spark: SparkSession = build_session("oracle", conf, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            text = difference(ALL[name].run(spark, sf_dir), ALL[name].sql, con)
        except Exception as error:  # report every query, not only the first broken one
            text = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += text is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {text or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
