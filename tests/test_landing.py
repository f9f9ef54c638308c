"""Arrival order, lost pages, external tables, exact quantiles, the command line."""

import math
import random

import pytest
from conftest import ROOT, final_plan, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_jobs import MOMENT, landed
from test_sources import rows, save

import submit
from assayline import operators as op
from assayline import schemas, sources
from assayline.plans import bronze, jobs, quality, serving, silver
from assayline.sources import Layout

RECORD = T.StructType([T.StructField("k", T.LongType())])


def test_page_ten_comes_after_page_two(spark):
    schema = "code string, nom string, _source_file string, _page long, _position int, _in_lines boolean"
    files = [("page_2.json", 0, "two"), ("page_10.json", 0, "ten"), ("page_9.json", 5, "nine")]
    df = spark.createDataFrame([("1", n, f"s3a://x/{f}", None, p, False) for f, p, n in files], schema)
    assert rows(bronze.dedupe_geo(df)) == [("1", "ten")]
    lines = [("1", "late", "f", 7, 0, True), ("1", "early", "f", 2, 9, True), ("2", "x", "f", None, 0, True)]
    assert rows(bronze.dedupe_geo(spark.createDataFrame(lines, schema))) == [("1", "late"), ("2", "x")]


def test_lines_without_ordinals_cannot_be_ordered(spark):
    schema = "code string, nom string, _source_file string, _page long, _position int, _in_lines boolean"
    df = spark.createDataFrame([("1", "a", "f", None, 0, True), ("1", "b", "f", None, 0, True)], schema)
    with pytest.raises(Exception, match="occurs twice"):
        bronze.dedupe_geo(df).collect()


def page(count, following, *keys):
    return {"count": count, "next": following, "data": [{"k": k} for k in keys]}


def test_a_repeated_page_does_not_make_up_for_a_lost_one(spark, tmp_path):
    whole = save(tmp_path / "whole", p1=page(4, "x", 1, 2), p2=page(4, None, 3, 4))
    assert sources.page_completeness(spark, whole, RECORD).first()["is_complete"]
    twice = save(tmp_path / "twice", p1=page(4, "x", 1, 2), p1again=page(4, "x", 1, 2), p3=page(4, None))
    found = sources.page_completeness(spark, twice, RECORD).first()
    assert (found["n_records"], found["is_complete"]) == (2, False)


def test_each_folder_is_held_against_its_own_count(spark, tmp_path):
    for name, n in (("a", 1), ("b", 3)):
        save(tmp_path / name, p=page(n, None, *range(10, 10 + min(n, 2))))
    found = sources.page_completeness(spark, str(tmp_path / "*"), RECORD).first()
    assert (found["declared_count"], found["n_records"], found["is_complete"]) == (4, 3, False)


def test_torn_pages_are_kept_and_can_stop_the_job(spark, tmp_path):
    landing = landed(tmp_path / "in")
    torn = tmp_path / "in" / "udi" / "torn.json"
    torn.write_text('{"count": 9, "data": [{"code_com')
    layout = Layout(root=str(tmp_path / "out"))
    assert jobs.bronze(spark, layout, landing, only="communes_udi") == {"communes_udi": 2}
    rejects = spark.read.parquet(layout.path("bronze", "rejects_communes_udi")).collect()
    assert [(r.reason, r._source_file.endswith("torn.json")) for r in rejects] == [("unreadable", True)]
    with pytest.raises(jobs.LandingError, match="communes_udi"):
        jobs.bronze(spark, Layout(root=str(tmp_path / "strict")), landing, strict=True)
    assert not (tmp_path / "strict" / "bronze").exists()


def test_torn_collections_are_kept_and_can_stop_the_job(spark, tmp_path):
    landing = landed(tmp_path / "in")
    places = landing.paths["geo_communes"]
    torn = f"{places}/torn.json"
    with open(torn, "w") as file:
        file.write('{"type": "FeatureCollection", "features": [{"properties": {"code": "1')
    layout = Layout(root=str(tmp_path / "out"))
    assert jobs.bronze(spark, layout, landing, only="geo_communes")["geo_communes"] > 0
    rejects = spark.read.parquet(layout.path("bronze", "rejects_geo_communes")).collect()
    assert [(r.reason, r._source_file.endswith("torn.json")) for r in rejects] == [("unreadable", True)]
    found = {r.source: r.is_complete for r in jobs.completeness(spark, landing).collect()}
    assert (found["geo_communes"], found["communes_udi"]) == (False, True)
    with pytest.raises(jobs.LandingError, match="geo_communes"):
        jobs.bronze(spark, Layout(root=str(tmp_path / "strict")), landing, strict=True)
    assert not (tmp_path / "strict" / "bronze").exists()


def test_drift_of_a_landing(spark, tmp_path):
    landing = landed(tmp_path / "in")
    page = {"count": 1, "next": None, "data": [{"code_commune": 7, "couleur": "bleu"}]}
    save(tmp_path / "in" / "udi", odd=page)
    found = jobs.drift(spark, landing, ["communes_udi"])
    got = {r.field: r.status for r in found.collect()}
    assert got["code_commune"] == "retyped" and got["couleur"] == "unknown"


def test_external_tables_see_later_partitions_and_keep_codes(spark, tmp_path):
    schema = T.StructType().add("k", "long").add("dep", "string").add("y", "integer")
    layout = Layout(root=str(tmp_path))
    for n, (dep, year) in enumerate([("01", 2023), ("2A", 2024), ("01", 2025)]):
        part = spark.createDataFrame([(n, dep, year)], schema)
        sources.write_table(part, layout, "gold", "t", ["y", "dep"], mode="append")
        sources.register_external(spark, "`ext_late`", layout.path("gold", "t"), schema, ["y", "dep"])
        assert spark.table("ext_late").count() == n + 1
    got = spark.table("ext_late")
    assert dict(got.dtypes)["dep"] == "string"
    assert rows(got.select("dep").distinct()) == [("01",), ("2A",)]
    assert rows(got.filter("dep = '01' AND y = 2025").select("k")) == [(2,)]
    spark.sql("DROP TABLE ext_late")


def test_exact_quantiles_equal_sorting(spark):
    pick = random.Random(3)
    values = [pick.choice((0.0, -1e-300, 3e9, pick.gauss(0, 1), float(round(pick.gauss(0, 3))))) for _ in range(4000)]
    data = [("hot" if i % 3 else str(i % 7), v) for i, v in enumerate(values)]
    data += [(None, 5.0), (None, None), ("nulls", None), ("odd", math.inf), ("odd", -math.inf), ("odd", 1.0)]
    df = spark.createDataFrame(data, "k string, v double")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r.q for r in op.exact_quantiles(df, ["k"], "v", wanted).collect()}
    for key in {k for k, v in data if v is not None}:
        mine = sorted(v for k, v in data if k == key and v is not None)
        assert got[key] == [mine[max(1, math.ceil(q * len(mine))) - 1] for q in wanted], key
    assert "nulls" not in got


@pytest.mark.parametrize("low,high", [(1e9, 1e9 + 1e6), (-1e15 - 50, -1e15), (0.0, 1e-300), (7.0, 7.0)])
def test_exact_quantiles_of_values_close_together(spark, low, high):
    pick = random.Random(9)
    data = [("hot", pick.uniform(low, high)) for _ in range(3000)] + [(None, low), (None, high)]
    data += [("far", v) for v in (math.nan, math.inf, -math.inf, low)]
    df = spark.createDataFrame(data, "k string, v double")
    wanted = [0.0, 0.3, 0.5, 1.0]
    got = {r.k: r.q for r in op.exact_quantiles(df, ["k"], "v", wanted).collect()}
    for key in ("hot", None):
        mine = sorted(v for k, v in data if k == key)
        assert got[key] == [mine[max(1, math.ceil(q * len(mine))) - 1] for q in wanted]
    assert got["far"][:3] == [-math.inf, low, low] and math.isnan(got["far"][3])
    whole = op.exact_quantiles(df.filter("k = 'hot'"), [], "v", [0.5]).collect()
    assert [r.q for r in whole] == [[got["hot"][2]]]


def test_no_task_ranks_a_hot_group_far_from_zero(spark):
    """The values of a hot group share two slices, but no part of one."""
    df = spark.range(200_000).select(
        (F.col("id") % 3 == 0).cast("int").alias("k"), (F.rand(4) * 1e6 + 1e9).alias("v")
    )
    values = df.filter("k = 1").select("v")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    part = F.floor((F.col("v") - low) / (high - low) * op.quantiles.PARTS)
    most = values.groupBy(part.alias("p")).count().agg(F.max("count")).first()[0]
    slices = values.select(op.quantiles.slice_of(F.col("v")).alias("s")).distinct().count()
    assert slices <= 2 and most < 200


def stats_of(spark, rows, schema="g string, v double, f boolean"):
    df = spark.createDataFrame(rows, schema)
    return op.median_and_sums(df, ["g"], "v", {"flagged": F.col("f").cast("int")})


def test_medians_and_sums_equal_sorting(spark):
    pick = random.Random(8)
    rows_ = [
        (pick.choice(["hot", "hot", "a", None]), pick.choice([None, 0.0, 1.5, pick.gauss(0, 9)]),
         pick.random() < 0.3)
        for _ in range(3000)
    ] + [("nulls", None, True), ("nan", math.nan, False), ("nan", 1.0, False)]
    for r in stats_of(spark, rows_).collect():
        mine = [x for x in rows_ if x[0] == r.g]
        values = sorted((v for _, v, _ in mine if v is not None), key=lambda v: (v != v, v))
        assert (r.n, r.flagged, r.n_values) == (len(mine), sum(f for *_, f in mine), len(values))
        if not values:
            assert (r.total, r.low, r.high, r.median) == (None, None, None, None)
        elif r.g != "nan":
            assert math.isclose(r.total, sum(values), rel_tol=1e-9)
            assert (r.low, r.high, r.median) == (values[0], values[-1], values[(len(values) + 1) // 2 - 1])
        else:
            assert r.median == 1.0
    assert stats_of(spark, []).count() == 0


def test_medians_are_one_scan_filters_reach_it_and_unread_ones_cost_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 7).cast("string").alias("g"), F.rand(1).alias("v"),
                             F.lit(True).alias("f")).write.parquet(path)
    made = op.median_and_sums(spark.read.parquet(path), ["g"], "v", {"k": F.lit(1)})
    plan = plan_of(made.filter("g = '3'"))
    assert plan.split("== Physical Plan ==")[1].count("FileScan parquet") == 1
    assert "EqualTo(g,3)" in plan
    assert "Window" not in plan_of(made.select("g", "n", "total")).split("== Physical Plan ==")[1]


def test_no_task_takes_a_hot_group_of_quantiles(spark):
    df = spark.range(200_000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.rand(4).alias("v"))
    slices = df.groupBy("k", op.quantiles.slice_of(F.col("v")).alias("s")).count()
    assert slices.agg(F.max("count")).first()[0] < 2_000


def test_building_plans_starts_no_job_and_leaves_no_folder(spark, tmp_path):
    import os

    root = sources.staging_root(spark).removeprefix("file:")
    before = sorted(os.listdir(root)) if os.path.isdir(root) else []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans")
    df = spark.range(50).selectExpr("id AS k", "CAST(id AS double) AS v", "CAST(id % 3 AS string) AS code_commune")
    op.flag_iqr_outliers(df, "v", "k")
    op.exact_quantiles(df, ["k"], "v", [0.5])
    op.filter_members(df, "code_commune", df.select("code_commune"))
    quality.check(df, {"s": [quality.not_null("k"), quality.unique(["k"])]})
    silver.result_bounds(df.selectExpr("v AS resultat_parse", "k AS code_parametre"))
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    after = sorted(os.listdir(root)) if os.path.isdir(root) else []
    assert before == after


def test_members_are_met_in_a_semi_join(spark):
    df = spark.range(30).selectExpr("CAST(id AS string) AS k")
    chosen = spark.createDataFrame([("3",), ("7",), (None,)], "m string")
    none = chosen.filter("m = 'x'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = op.filter_members(df, "k", chosen)
        assert rows(found) == [("3",), ("7",)]
        assert "LeftSemi" in final_plan(found)
        assert op.filter_members(df, "k", none).count() == 30
        with_null = df.selectExpr("CASE WHEN k <> '3' THEN k END AS k")
        assert op.filter_members(with_null, "k", none).count() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_labels_are_categorised_in_generated_code(spark):
    df = spark.createDataFrame([("Nitrates (en NO3)",), ("pH",), (None,)], "libelle_parametre_norm string")
    plain, bound = silver.categorise_stored(df), silver.categorise(df)
    assert rows(plain) == rows(bound)
    assert "lambda" not in plan_of(plain)


def test_steps_are_counted_while_they_run(spark, tmp_path):
    layout = Layout(root=str(tmp_path / "out"))
    jobs.run(spark, layout, landed(tmp_path / "in"), last="bronze", moment=MOMENT)
    metrics = op.Metrics()
    stored = jobs.silver(spark, layout, MOMENT, metrics=metrics)
    seen = metrics.get()
    raw = sources.read_table(spark, layout, "bronze", "resultats_dis", schemas.BRONZE["resultats_dis"])
    assert seen["landed"]["n_rows"] == raw.count()
    typed = silver.type_results(silver.dedupe_results(raw))
    assert seen["deduped"]["n_rows"] == seen["typed"]["n_rows"] == typed.count()
    assert seen["typed"]["n_null_result"] == typed.filter("resultat_parse IS NULL").count()
    assert seen["clean"]["n_rows"] == seen["measures"]["n_rows"] == stored["mesures"]


def test_default_label_is_of_the_year_and_an_offered_one_is_kept(spark):
    statuses = spark.createDataFrame([(2024,), (2025,)], "annee_prelevement int")
    stats = spark.createDataFrame(
        [(2024, "A"), (2024, "B"), (2025, "C")], "annee_prelevement int, libelle_parametre_norm string"
    )
    ask = lambda **k: tuple(serving.defaults(statuses, stats, "C", **k).first())
    assert ask() == (2025, "C") and ask(year=2024) == (2024, "A")
    assert ask(year=2024, asked="B") == (2024, "B") and ask(year=2025, asked="B") == (2025, "C")


def test_submit_in_catalog_mode(spark, tmp_path, capsys):
    landed(tmp_path / "in")
    for given, name in (("geo", "geo_communes"), ("udi", "communes_udi"), ("res", "resultats_dis")):
        (tmp_path / "in" / name).symlink_to(tmp_path / "in" / given)
    names = [f"--namespace={layer}=sub_{layer}" for layer in ("bronze", "silver", "gold")]
    submit.main([*names, "--landing", str(tmp_path / "in"), "--with-quality"])
    shown = capsys.readouterr().out
    assert "gold.conformite_commune: 2 rows" in shown and "TOTAL" in shown
    assert "step landed: {'n_rows': " in shown and "n_outliers" in shown
    assert spark.table("sub_silver.quality_results").count() > 50
    spark.sql("USE default")
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA sub_{layer} CASCADE")
    with pytest.raises(SystemExit):
        submit.parsed([])
    assert submit.parsed(["--root", "x", "--only", "communes_udi"]).only == ["communes_udi"]
    assert (ROOT / "submit.py").exists() and schemas.SILVER and MOMENT


def test_submit_takes_limits_of_the_quality_job():
    plain = submit.parsed(["--root", "x"])
    assert plain.ranges == quality.RANGES
    assert (plain.filled, plain.known_status) == (quality.NON_NULL_SHARE, quality.STATUS_SHARE)
    asked = submit.parsed(["--root", "x", "--range", "pH=6.5:9", "--filled", "0.5"])
    assert asked.ranges == {**quality.RANGES, "pH": (6.5, 9.0)} and asked.filled == 0.5
    for wrong in ("acidity=1:2", "pH=9:6", "pH=6", "pH=a:b"):
        with pytest.raises(SystemExit):
            submit.parsed(["--root", "x", "--range", wrong])
