"""Plans of queries whose tasks would grow with the input."""

import pytest
from conftest import final_plan, plan_of

from assayline import sources
from registry import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def many_partitions(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", kept)


@pytest.mark.parametrize("name", ["silver_measures", "flag_iqr_outliers"])
def test_results_are_not_dealt_to_a_few_parameters(spark, many_partitions, name):
    plan = final_plan(QUERIES[name](spark, SMALL))
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_the_suites_build_each_table_once(spark):
    # All tables are staged by then; before, the stations were built for every suite.
    assert "l_suppkey" not in plan_of(QUERIES["quality_suites"](spark, SMALL))


def test_the_type_of_a_landed_value_is_looked_up_once(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1, "parts": [{"code": "a"}]}')
    plan = final_plan(sources.field_profile(spark, str(tmp_path), depth=1))
    # Once in the final plan and once in the initial one.
    assert plan.count(".schemaOfVariant(") in (1, 2)


def test_stations_are_sorted_without_the_label(spark):
    lines = plan_of(QUERIES["build_stations"](spark, SMALL)).splitlines()
    limits = [line for line in lines if "WindowGroupLimit" in line]
    assert limits and not any("nom_commune_norm" in line for line in limits)
