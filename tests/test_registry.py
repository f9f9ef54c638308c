"""Registered queries against their SQL, on given and on skewed tables."""

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from conftest import ROOT, plan_of
from pyspark.sql import functions as F

sys.path.insert(0, str(ROOT / "tools"))

from check_oracle import normal  # noqa: E402

from registry import ORACLES, QUERIES, views  # noqa: E402

GIVEN = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not GIVEN.exists(), reason="test tables are not here")

# Runs that repeat what the job tests cover, on larger inputs.
LONG = {"medallion_run", "quality_suites"}
SKEWED = (
    "latest_per_key", "first_per_key", "flag_iqr_outliers", "silver_measures",
    "silver_conformity", "build_stations", "status_rollup", "period_stats", "region_rollup",
    "region_of_statuses", "best_worst_k", "violation_profile", "map_points", "weighted_top",
    "quality_rules", "step_metrics", "partitioned_roundtrip", "filter_members",
)


def database(folder):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        name = f"{file}/*.parquet" if file.is_dir() else str(file)
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{name}'")
    return con


@pytest.fixture(scope="module")
def given():
    return database(GIVEN)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The given tables with about a third of the rows on one key."""
    folder = tmp_path_factory.mktemp("skewed")
    part = F.rand(7) < 0.34
    hot = {
        "lineitem": {"l_orderkey": 1, "l_linenumber": 1, "l_suppkey": 2},
        "orders": {"o_custkey": 3},
        "customer": {"c_nationkey": 4},
        "events": {"event_type": "hot"},
        "documents": {"lang": "hot"},
    }
    for file in GIVEN.glob("*.parquet"):
        df = spark.read.parquet(str(file))
        chosen = df.withColumn("__hot", part)
        for column, value in hot.get(file.stem, {}).items():
            kind = df.schema[column].dataType
            chosen = chosen.withColumn(
                column, F.when(F.col("__hot"), F.lit(value).cast(kind)).otherwise(F.col(column))
            )
        chosen.drop("__hot").write.parquet(str(folder / file.name))
    return str(folder), database(folder)


def compare(spark, folder, con, name):
    mine = QUERIES[name](spark, str(folder)).toPandas()
    relation = con.sql(ORACLES[name])
    theirs = pd.DataFrame(relation.fetchall(), columns=relation.columns)
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normal(mine) == normal(theirs)
    return len(mine)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query_equals_its_sql(spark, given, name):
    compare(spark, GIVEN, given, name)


@pytest.mark.parametrize("name", SKEWED)
def test_query_equals_its_sql_on_skewed_tables(spark, skewed, name):
    folder, con = skewed
    assert compare(spark, folder, con, name) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize(
    "name",
    ["status_rollup", "period_stats", "region_rollup", "violation_profile", "kpi_summary",
     "page_conformite_commune", "series_default", "filter_members", "map_points", "weighted_top"],
)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, str(GIVEN)))
    for part in ("CartesianProduct", "NestedLoop", "Python", "InPandas", "RDDScan"):
        assert part not in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    page = QUERIES["page_evolution_parametres"](spark, str(GIVEN))
    scans = [line for line in plan_of(page).splitlines() if "FileScan parquet" in line]
    lines = [line for line in scans if "lineitem" in line]
    assert lines and all("l_shipdate" not in line for line in lines)
    wanted = views.table(spark, str(GIVEN), "orders").filter("o_orderkey = 5").select("o_custkey")
    assert "EqualTo(o_orderkey,5)" in plan_of(wanted)
