"""The batch lake: landed CSV to bronze, silver and gold Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeweir.functions.numeric import to_number
from lakeweir.functions.stamps import stamp
from lakeweir.functions.text import clean_text_columns
from lakeweir.operators.averages import average_joined
from lakeweir.operators.duplicates import drop_duplicate_rows
from lakeweir.operators.joins import BROADCAST_BYTES
from lakeweir.operators.metrics import joined_rows, log, log_sample, stored_rows
from lakeweir.schemas import GROUP_KEYS
from lakeweir.session import scratch_path
from lakeweir.sinks.files import remove, write_parquet
from lakeweir.sources.files import read_csv, read_csv_once, read_parquet

TABLES = ("athlete_bio", "athlete_event_results")


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"


@dataclass(frozen=True)
class GoldTable:
    """What the gold layer averages; the defaults give the athletes' averages.

    The country is that of the athlete, not of the event.
    """

    name: str = "avg_stats"
    fact: str = "athlete_event_results"
    dim: str = "athlete_bio"
    on: str = "athlete_id"
    dim_on: str = "athlete_id"
    fact_keys: tuple[str, ...] = ("sport", "medal")
    dim_keys: tuple[str, ...] = ("sex", "country_noc")
    output_keys: tuple[str, ...] = GROUP_KEYS
    measures: Mapping[str, str] = field(
        default_factory=lambda: {"avg_weight": "weight", "avg_height": "height"}
    )
    nan_as_null: bool = False
    # A float adds its error of some 1e-8 to averages; "double" averages decimals as written.
    number: str = "float"


def landing_to_bronze(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    tables: Iterable[str] = TABLES,
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, int]:
    """Store each landed CSV table as Parquet; returns rows per table.

    Types are inferred for tables that have no entry in ``schemas``, in the one pass over the CSV
    that stores its text (``read_csv_once``).
    """
    schemas = schemas or {}

    def store(table: str) -> int:
        path, target = f"{landing}/{table}.csv", lake.path("bronze", table)
        if table in schemas:
            return write_parquet(read_csv(spark, path, schemas[table]), target, f"bronze {table}")
        copy = scratch_path(spark, f"landed-{table}")
        try:
            return write_parquet(read_csv_once(spark, path, copy), target, f"bronze {table}")
        finally:
            remove(spark, copy)

    return {table: store(table) for table in tables}


def silver_rows(bronze: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Cleaned text, then one of each set of equal rows."""
    return drop_duplicate_rows(clean_text_columns(bronze, exclude))


def bronze_to_silver(
    spark: SparkSession,
    lake: Lake,
    tables: Iterable[str] = TABLES,
    exclude: Iterable[str] = (),
) -> dict[str, int]:
    """Clean and de-duplicate each table.

    Cleaning strips minus signs and hyphens from numbers kept as text, too;
    ``exclude`` leaves such columns alone.
    """
    exclude = tuple(exclude)
    return {
        table: write_parquet(
            silver_rows(read_parquet(spark, lake.path("bronze", table)), exclude),
            lake.path("silver", table),
            f"silver {table}",
        )
        for table in tables
    }


def gold_averages(
    fact: DataFrame,
    dim: DataFrame,
    gold: GoldTable,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Averages of the dimension's measures, cast to ``gold.number`` first."""
    numbers = {m: to_number(m, gold.number, gold.nan_as_null) for m in gold.measures.values()}
    averages = average_joined(
        fact,
        dim.withColumns(numbers),
        on=gold.on,
        dim_on=gold.dim_on,
        fact_keys=gold.fact_keys,
        dim_keys=gold.dim_keys,
        measures=gold.measures,
        broadcast_limit=broadcast_limit,
    )
    return averages.select(*gold.output_keys, *gold.measures)


def silver_to_gold(spark: SparkSession, lake: Lake, gold: GoldTable | None = None) -> int:
    """Write the stamped averages; returns the number of groups."""
    gold = gold or GoldTable()
    averages = gold_averages(
        read_parquet(spark, lake.path("silver", gold.fact)),
        read_parquet(spark, lake.path("silver", gold.dim)),
        gold,
    )
    return write_parquet(stamp(averages), lake.path("gold", gold.name), f"gold {gold.name}")


# One row per table that a step reads or writes; what does not apply is NULL.
RUN_ROWS = "table_name string, rows_read bigint, rows_joined bigint, rows_written bigint"
RunRows = list[tuple[str, int | None, int | None, int | None]]


def layer_rows(
    spark: SparkSession, lake: Lake, tables: Iterable[str], source: str | None, target: str
) -> RunRows:
    """Rows read and written per table. Bronze keeps each row it reads."""
    rows: RunRows = []
    for table in tables:
        written = stored_rows(spark, lake.path(target, table))
        read = stored_rows(spark, lake.path(source, table)) if source else written
        rows.append((table, read, None, written))
    return rows


def gold_rows(spark: SparkSession, lake: Lake, gold: GoldTable) -> RunRows:
    """Rows of both sides, of their join and of the averages."""
    fact, dim = (read_parquet(spark, lake.path("silver", t)) for t in (gold.fact, gold.dim))
    joined = joined_rows(fact, dim, gold.on, gold.dim_on)
    return [
        (gold.fact, fact.count(), None, None),
        (gold.dim, dim.count(), None, None),
        (gold.name, None, joined, stored_rows(spark, lake.path("gold", gold.name))),
    ]


def record_rows(spark: SparkSession, lake: Lake, run: str, step: str, rows: RunRows) -> None:
    """Counts of a step in the table of runs; a repeated step replaces its own."""
    counts = spark.createDataFrame(rows, RUN_ROWS).coalesce(1)
    counts.write.mode("overwrite").parquet(f"{lake.runs}/run={run}/step={step}")
    for row in rows:
        log.info("run %s, %s: %s read %s, joined %s, written %s", run, step, *row)


def run_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    """The table of runs: rows read, joined and written, by run, step and table."""
    return read_parquet(spark, lake.runs)


def sample_tables(spark: SparkSession, lake: Lake, layer: str, tables: Iterable[str]) -> None:
    for table in tables:
        log_sample(read_parquet(spark, lake.path(layer, table)), f"{layer} {table}")


def run_lake(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    tables: Iterable[str] = TABLES,
    gold: GoldTable | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
    exclude: Iterable[str] = (),
    retries: int = 1,
    run: str | None = None,
) -> str:
    """The three steps in order. Each replaces its tables, so it can simply run again.

    Returns the name of the run, under which each step's counts are kept (``run_rows``). They are
    taken from the stored files, and the number of joined rows from a pass over both join keys.
    """
    tables, exclude, gold = tuple(tables), tuple(exclude), gold or GoldTable()
    run = run or uuid.uuid4().hex

    def bronze() -> None:
        landing_to_bronze(spark, landing, lake, tables, schemas)
        record_rows(spark, lake, run, "bronze", layer_rows(spark, lake, tables, None, "bronze"))
        sample_tables(spark, lake, "bronze", tables)

    def silver() -> None:
        bronze_to_silver(spark, lake, tables, exclude)
        record_rows(spark, lake, run, "silver", layer_rows(spark, lake, tables, "bronze", "silver"))
        sample_tables(spark, lake, "silver", tables)

    def averages() -> None:
        silver_to_gold(spark, lake, gold)
        record_rows(spark, lake, run, "gold", gold_rows(spark, lake, gold))
        sample_tables(spark, lake, "gold", [gold.name])

    for step in (bronze, silver, averages):
        with_retries(step, retries, f"lake step {step.__name__}")
    return run


def with_retries(step: Callable[[], object], retries: int, name: str) -> object:
    for attempt in range(retries + 1):
        try:
            return step()
        except Exception:
            if attempt == retries:
                raise
            log.exception("%s failed, attempt %d of %d", name, attempt + 1, retries + 1)
