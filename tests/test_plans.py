"""Physical plans of the main queries."""

import pytest

import __spark_entry__ as entry
from tidemart.session import work_path

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


NARROW = ["P1_drop_bad", "P6_cart_add", "P13_page", "K3_fanout", "J1_dim_route", "F1_validate_id_card", "F2_chinese_amount"]


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


@pytest.mark.parametrize("name", ["P6_cart_add", "P1_drop_bad", "P13_page", "P11_displays"])
def test_one_parse(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("parseJson") == 1, plan


def test_columns_are_pruned(spark):
    plan = plan_of(spark, "A2_median")
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in plan


def test_point_get_reaches_the_scan(spark):
    path = work_path(spark, "kv")
    spark.range(100).selectExpr("string(id) AS row_key", "id").write.parquet(path)
    from tidemart.sources.tables import get

    plan = get(spark.read.parquet(path), "42")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(row_key,42)" in plan


def test_work_path_needs_a_shared_folder(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
