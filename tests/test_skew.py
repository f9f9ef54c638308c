"""One key with a third of the rows, and joins too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from assayline import operators as op
from assayline.plans import gold

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.shuffle.partitions": "16",
}
N = 200_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    key = F.when(F.rand(1) < 0.34, F.lit(1)).otherwise((F.rand(2) * 5000).cast("int"))
    spark.range(0, N, 1, 16).select(
        "id", key.cast("string").alias("k"), F.rand(3).alias("v")
    ).write.parquet(path)
    before = {name: spark.conf.get(name, None) for name in NO_BROADCAST}
    for name, value in NO_BROADCAST.items():
        spark.conf.set(name, value)
    yield spark.read.parquet(path)
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run(df):
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("== Initial Plan ==")[0]


def test_hot_group_is_split_in_the_outlier_join(hot):
    rows, plan = run(op.flag_iqr_outliers(hot, "v", "k"))
    assert len(rows) == N and "SortMergeJoin(skew=true)" in plan


def test_hot_place_is_split_in_the_region_join(spark, hot, tmp_path):
    name = F.concat(F.lit("n"), F.col("k"))
    conformity = hot.select(
        F.lit(2024).alias("annee_prelevement"), F.lit("01").alias("code_departement"),
        F.lit("D").alias("nom_departement_norm"), F.col("k").alias("code_commune"),
        name.alias("nom_commune_norm"), F.col("id").cast("string").alias("code_prelevement"),
        F.lit("C").alias("conformite_globale"),
    )
    code = F.col("id").cast("string")
    spark.range(5000).select(
        code.alias("code_commune"), F.concat(F.lit("n"), code).alias("nom_commune_norm"),
        (F.col("id") % 7).cast("string").alias("code_region_geo"), F.col("id").alias("population"),
        F.lit(1.0).alias("longitude"), F.lit(1.0).alias("latitude"),
        F.lit(True).alias("_coords_valides"),
    ).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    population = gold.region_population(dim)
    rows, plan = run(gold.region_rollup(conformity, dim, population, "2025-01-01 00:00:00"))
    assert sum(r.nb_prelevements_total for r in rows) == N and "skew=true" in plan
    statuses = gold.status_rollup(conformity, dim, unique_samples=True)
    added = gold.region_of_statuses(statuses, population, "2025-01-01 00:00:00")
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, rows))


def test_hot_key_leaves_one_row_per_task_before_the_shuffle(hot):
    rows, plan = run(op.latest_per_key(hot, ["k"], ["v"]))
    assert len(rows) == hot.select("k").distinct().count()
    assert plan.count("WindowGroupLimit") == 2
