"""Every registered query against DuckDB, and the driver's contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from lakeweir.queries import ALL
from tests.helpers import plan_of
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ALL))
def test_equals_sql(spark, con, name):
    assert difference(ALL[name].run(spark, SF_DIR), ALL[name].sql, con) is None


def test_contract(spark):
    df = contract.entry(spark)
    assert df.columns == ["sport", "medal", "sex", "country_noc", "avg_weight", "avg_height"]
    assert df.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


SHUFFLE_FREE = [
    "filter_valid_measures", "clean_text_native", "clean_all_text_columns", "numeric_try_cast",
    "round_half_up", "json_serialize_records", "json_parse_records", "enrich_join_inner",
    "enrich_join_dim_country", "parquet_scan", "json_envelope_decode",
]


@pytest.mark.parametrize("name", SHUFFLE_FREE)
def test_no_shuffle(spark, name):
    plan = plan_of(ALL[name].run(spark, SF_DIR))
    assert "hashpartitioning" not in plan and "Python" not in plan


def test_flagship_plan(spark):
    plan = plan_of(ALL["gold_avg_stats"].run(spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string,l_linestatus:string>" in plan
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan
    assert "BroadcastHashJoin" in plan and plan.count("Arguments: hashpartitioning") == 2


def test_no_cross_join_anywhere(spark):
    for name in ("gold_avg_stats_wide_dim", "enrich_join_inner", "topic_copy_diff"):
        plan = plan_of(ALL[name].run(spark, SF_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
