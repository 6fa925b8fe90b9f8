"""CSV and Parquet tables, and the lake layers built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.plans.lake import (
    GoldTable,
    Lake,
    bronze_to_silver,
    landing_to_bronze,
    run_lake,
    run_rows,
    silver_to_gold,
)
from lakeweir.queries.base import Query, sql_average, sql_clean, table
from lakeweir.session import scratch_path
from lakeweir.sinks.files import write_parquet
from lakeweir.sources.files import read_csv, read_csv_once, read_parquet

TABLES = ("customer", "orders")
GOLD = GoldTable(
    name="balances",
    fact="orders",
    dim="customer",
    on="o_custkey",
    dim_on="c_custkey",
    fact_keys=("o_orderstatus", "o_orderpriority"),
    dim_keys=("c_mktsegment", "c_nationkey"),
    output_keys=("o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey"),
    measures={"avg_balance": "c_acctbal"},
    number="double",
)


def land(spark: SparkSession, sf_dir: str, name: str) -> str:
    """CSV copies of the tables, every row twice so that silver has work to do."""
    landing = scratch_path(spark, name)
    for t in TABLES:
        rows = table(spark, sf_dir, t)
        rows.union(rows).write.option("header", True).csv(f"{landing}/{t}.csv")
    return landing


def csv_infer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path)


def csv_infer_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found while the text of the CSV is stored."""
    path = scratch_path(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return order_day(read_csv_once(spark, path, scratch_path(spark, "orders-text")))


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/part.parquet")


def parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes to one place: only the second one is left."""
    path = scratch_path(spark, "part")
    write_parquet(table(spark, sf_dir, "supplier"), path)
    write_parquet(table(spark, sf_dir, "part"), path)
    return read_parquet(spark, path)


def order_day(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def lake_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(scratch_path(spark, "lake"))
    landing_to_bronze(spark, land(spark, sf_dir, "landing"), lake, TABLES)
    return order_day(read_parquet(spark, lake.path("bronze", "orders")))


def lake_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(scratch_path(spark, "lake"))
    landing_to_bronze(spark, land(spark, sf_dir, "landing"), lake, TABLES)
    bronze_to_silver(spark, lake, TABLES)
    return order_day(read_parquet(spark, lake.path("silver", "orders")))


def lake_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold step alone, over tables stored as silver."""
    lake = Lake(scratch_path(spark, "lake"))
    for t in TABLES:
        write_parquet(table(spark, sf_dir, t), lake.path("silver", t))
    silver_to_gold(spark, lake, GOLD)
    return read_parquet(spark, lake.path("gold", GOLD.name)).drop("timestamp")


def lake_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(scratch_path(spark, "lake"))
    run_lake(spark, land(spark, sf_dir, "landing"), lake, TABLES, GOLD)
    return read_parquet(spark, lake.path("gold", GOLD.name)).drop("timestamp")


def lake_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each step of a run read, joined and wrote."""
    lake = Lake(scratch_path(spark, "lake"))
    run_lake(spark, land(spark, sf_dir, "landing"), lake, TABLES, GOLD)
    return run_rows(spark, lake).drop("run")


BRONZE_SQL = """
    SELECT o_orderkey::int AS o_orderkey, o_custkey::int AS o_custkey, o_orderstatus,
           o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
"""

QUERIES = [
    Query(
        "csv_infer_scan",
        csv_infer_scan,
        """SELECT c_custkey::int AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
           FROM customer""",
    ),
    Query("csv_infer_once", csv_infer_once, BRONZE_SQL),
    Query("parquet_scan", parquet_scan, "SELECT * FROM part"),
    Query("parquet_overwrite", parquet_overwrite, "SELECT * FROM part"),
    Query("lake_bronze", lake_bronze, f"{BRONZE_SQL} UNION ALL {BRONZE_SQL}"),
    Query(
        "lake_silver",
        lake_silver,
        f"""SELECT DISTINCT o_orderkey, o_custkey, {sql_clean("o_orderstatus")} AS o_orderstatus,
                   o_totalprice, o_orderdate, {sql_clean("o_orderpriority")} AS o_orderpriority
            FROM ({BRONZE_SQL})""",
    ),
    Query(
        "lake_gold",
        lake_gold,
        f"""SELECT o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey,
                   {sql_average("c_acctbal::float")} AS avg_balance
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    ),
    Query(
        "lake_end_to_end",
        lake_end_to_end,
        f"""SELECT o_orderstatus, {sql_clean("o_orderpriority")} AS o_orderpriority,
                   c_mktsegment, c_nationkey, {sql_average("c_acctbal::float")} AS avg_balance
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    ),
    Query(
        "lake_run_rows",
        lake_run_rows,
        """WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n FROM orders),
                cs AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM customer)),
                os AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM orders)),
                j AS (SELECT DISTINCT o.*, c.* FROM orders o JOIN customer c ON o_custkey = c_custkey),
                g AS (SELECT o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey FROM j GROUP BY ALL)
           SELECT 'bronze' AS step, 'customer' AS table_name, 2 * n AS rows_read,
                  NULL::bigint AS rows_joined, 2 * n AS rows_written FROM c
           UNION ALL SELECT 'bronze', 'orders', 2 * n, NULL, 2 * n FROM o
           UNION ALL SELECT 'silver', 'customer', 2 * c.n, NULL, cs.n FROM c, cs
           UNION ALL SELECT 'silver', 'orders', 2 * o.n, NULL, os.n FROM o, os
           UNION ALL SELECT 'gold', 'orders', n, NULL, NULL FROM os
           UNION ALL SELECT 'gold', 'customer', n, NULL, NULL FROM cs
           UNION ALL SELECT 'gold', 'balances', NULL, (SELECT count(*) FROM j),
                            (SELECT count(*) FROM g)""",
    ),
]
