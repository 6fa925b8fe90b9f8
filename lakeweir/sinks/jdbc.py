"""Appending to database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeweir.config import JdbcConfig


def jdbc_write_options(
    conn: JdbcConfig,
    table: str,
    column_types: str | None = None,
    batch_rows: int = 10_000,
    connections: int | None = None,
) -> dict[str, str]:
    options = {
        "url": conn.url,
        "driver": conn.driver,
        "dbtable": table,
        "user": conn.user,
        "password": conn.password,
        "batchsize": str(batch_rows),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    if connections:
        options["numPartitions"] = str(connections)
    return options


def write_jdbc(
    df: DataFrame,
    conn: JdbcConfig,
    table: str,
    column_types: str | None = None,
    batch_rows: int = 10_000,
    connections: int | None = None,
) -> None:
    """Append rows; ``column_types`` is the column DDL used if the table is created.

    A repeated batch is appended again. Store ``batch_id`` with the rows and
    read through ``latest_by_key``. ``connections`` bounds how many tasks
    write at once.
    """
    options = jdbc_write_options(conn, table, column_types, batch_rows, connections)
    df.write.format("jdbc").options(**options).mode("append").save()
