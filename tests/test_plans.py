import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import schemas
from assayline.plans import bronze, gold, jobs, quality, reports, serving, silver

MOMENT = "2025-06-01 00:00:00"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def filled(spark, schema, *records):
    """Rows of a contract schema; columns left out are null."""
    data = [tuple(r.get(n) for n in schema.names) for r in records]
    return spark.createDataFrame(data, schema)


# Bronze -------------------------------------------------------------------


def test_dedupe_geo_keeps_the_last_arrival(spark):
    schema = "code string, nom string, _source_file string, _position int"
    df = spark.createDataFrame(
        [("1", "a", "f1", 0), ("1", "b", "f2", 0), ("1", "c", "f2", 1), ("2", "d", "f1", 1),
         (None, "e", "f9", 0)], schema,
    )
    assert rows(bronze.dedupe_geo(df)) == [("1", "c"), ("2", "d")]
    uncoded = df.filter("code is null").unionByName(df.filter("code is null"))
    assert rows(bronze.dedupe_geo(uncoded)) == [(None, "e"), (None, "e")]


def test_land_results(spark):
    df = spark.createDataFrame(
        [("2025-02-26T12:55:00Z", [("r", "n")]), ("bad", None)],
        "date_prelevement string, reseaux array<struct<code:string,nom:string>>",
    )
    got = bronze.land_results(df, "origin", MOMENT)
    assert rows(got.select("_partition_annee", "reseaux", "_source_api")) == [
        (2025, '[{"code":"r","nom":"n"}]', "origin"), (None, None, "origin"),
    ]
    assert got.schema["_ingestion_timestamp"].dataType == T.TimestampType()


# Silver -------------------------------------------------------------------


def raw(spark, *records):
    schema = schemas.BRONZE["resultats_dis"]
    base = {"code_prelevement": "S1", "code_parametre": "P1", "code_commune": "64945",
            "date_prelevement": "2025-02-26T12:55:00Z", "libelle_parametre": " Nitrates ",
            "nom_commune": " Tourne"}
    return filled(spark, schema, *[{**base, **r} for r in records]).withColumn(
        "_ingestion_timestamp", F.coalesce("_ingestion_timestamp", F.lit(MOMENT).cast("timestamp"))
    )


def test_type_results(spark):
    df = raw(
        spark,
        {"resultat_alphanumerique": "<0,01"},
        {"resultat_alphanumerique": " <0,01", "resultat_numerique": 3.0},
        {"resultat_alphanumerique": "ND", "date_prelevement": "2025-13-01T00:00:00Z"},
    )
    got = silver.type_results(df).select(
        "annee_prelevement", "mois_prelevement", "resultat_parse", "est_sous_seuil", "est_sur_seuil"
    )
    assert rows(got) == [
        (2025, 2, 0.01, True, False), (2025, 2, 3.0, False, False), (None, None, None, False, False),
    ]


def test_clean_results(spark):
    df = raw(
        spark,
        {"resultat_alphanumerique": "1", "libelle_unite": "MG/L",
         "conformite_limites_bact_prelevement": " n"},
        {"resultat_alphanumerique": "1", "libelle_unite": "MG/L",
         "conformite_limites_bact_prelevement": " n"},
        {"code_parametre": "P2", "resultat_alphanumerique": "ND", "nom_distributeur": "EAU64"},
        {"code_parametre": None},
        {"code_commune": None, "code_parametre": "P3"},
        {"date_prelevement": "", "code_parametre": "P4"},
    )
    got = silver.clean_results(df).select(
        "code_parametre", "libelle_parametre_norm", "nom_commune_norm", "libelle_unite_norm",
        "conformite_bact_limite_norm", "nom_distributeur", "_resultat_manquant",
    )
    assert rows(got) == [
        ("P1", "NITRATES", "TOURNE", "mg/L", "N", "INCONNU", False),
        ("P2", "NITRATES", "TOURNE", "INCONNUE", None, "EAU64", True),
    ]


def test_key_conditions_are_checked_before_the_dedupe_shuffle(spark, tmp_path):
    raw(spark, {}).select(*schemas.BRONZE["resultats_dis"].names).write.parquet(str(tmp_path / "r"))
    df = spark.read.schema(schemas.BRONZE["resultats_dis"]).parquet(str(tmp_path / "r"))
    plan = plan_of(silver.clean_results(df)).split("== Physical Plan ==")[1]
    assert "PushedFilters: [IsNotNull(code_parametre)]" in plan
    assert plan.index("Exchange") < plan.index("isnotnull(gettimestamp")
    assert "libelle_parametre_web" not in plan


def test_dedupe_takes_the_newest_load(spark):
    df = raw(spark, {"resultat_alphanumerique": "1"}, {"resultat_alphanumerique": "2"})
    newer = df.withColumn(
        "_ingestion_timestamp",
        F.expr("_ingestion_timestamp + make_interval(0,0,0,0,0,0,int(resultat_alphanumerique))"),
    )
    kept = silver.dedupe_results(silver.type_results(newer.repartition(5)))
    assert [r.resultat_alphanumerique for r in kept.collect()] == ["2"]


def test_conformity_status(spark):
    names = list(silver.STATUS_COLUMNS.values())
    given = {"P1": "CCCC", "P2": "NCCC", "P3": "SC-C"}
    records = [
        {"code_prelevement": k, **{n: None if s == "-" else s for n, s in zip(names, v, strict=True)}}
        for k, v in given.items()
    ]
    df = filled(spark, schemas.SILVER["conformite"], *records, records[0]).drop("conformite_globale")
    got = silver.build_conformity(df, MOMENT)
    assert got.columns == schemas.SILVER["conformite"].names
    assert dict(rows(got.select("code_prelevement", "conformite_globale"))) == {
        "P1": "C", "P2": "N", "P3": "S",
    }


def test_measures_have_the_contract_columns(spark):
    df = raw(spark, {"resultat_alphanumerique": "1"})
    got = silver.build_measures(
        silver.categorise(silver.flag_outliers(silver.clean_results(df))), MOMENT
    )
    assert got.schema.simpleString() == schemas.SILVER["mesures"].simpleString()
    assert got.first().categorie_parametre == "CHIMIE"


def test_stations(spark):
    networks = filled(
        spark, schemas.RAW_NETWORKS,
        {"code_commune": "64945", "nom_commune": " Tourne ", "code_reseau": "R", "nom_quartier": "Q",
         "debut_alim": "2010-10-16", "annee": "2026"},
        {"code_commune": "64945", "nom_commune": " Tourne ", "code_reseau": "R", "nom_quartier": "Q",
         "debut_alim": "2010-10-16", "annee": "2026"},
        {"code_commune": "99999", "nom_commune": "X", "code_reseau": "R", "debut_alim": "x",
         "annee": "x"},
    )
    geo = silver.clean_geo(
        filled(spark, schemas.BRONZE["geo_communes"],
               {"code": "64945", "nom": "Tourne", "codeDepartement": "64", "codeRegion": "75",
                "population": 80441, "longitude": -0.37, "latitude": 43.29})
    )
    got = silver.build_stations(networks, geo, MOMENT)
    assert got.schema.simpleString() == schemas.SILVER["stations"].simpleString()
    picked = got.select("code_commune", "nom_commune_norm", F.col("debut_alim").cast("string"),
                        "annee", "code_region_geo", "population", "_coords_valides")
    assert rows(picked) == [
        ("64945", "TOURNE", "2010-10-16", 2026, "75", 80441, True),
        ("99999", "X", None, None, None, None, None),
    ]


def test_explode_networks(spark):
    df = spark.createDataFrame(
        [("S1", '[{"code":"a","nom":"A"},{"code":"b","nom":"B"}]'), ("S2", None), ("S3", "[]"),
         ("S4", "broken")], "code_prelevement string, reseaux string")
    got = silver.explode_networks(df).select("code_prelevement", "code_reseau", "nom_reseau")
    assert rows(got) == [("S1", "a", "A"), ("S1", "b", "B")]


# Gold ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def dim(spark):
    return gold.entity_dim(
        filled(
            spark, schemas.SILVER["stations"],
            {"code_commune": "64901", "nom_commune_norm": "TOURNE", "code_region_geo": "75",
             "population": 1000, "longitude": -0.37, "latitude": 43.29, "_coords_valides": True},
            {"code_commune": "64902", "nom_commune_norm": "ARVELLE", "code_region_geo": "75",
             "population": 500, "longitude": -0.35, "latitude": 43.28, "_coords_valides": True},
        )
    )


def sample(code, status, commune="64901", name="TOURNE"):
    return {"code_prelevement": code, "conformite_globale": status, "annee_prelevement": 2025,
            "code_departement": "64", "nom_departement_norm": "PYRENEES-ATLANTIQUES",
            "code_commune": commune, "nom_commune_norm": name}


@pytest.fixture(scope="module")
def conformity(spark):
    return filled(
        spark, schemas.SILVER["conformite"],
        sample("P1", "C"), sample("P2", "N"), sample("P3", "C"),
        sample("P4", "S", "64902", "ARVELLE"), sample("P5", "C", "64902", "ARVELLE VILLE"),
    )


def test_status_rollup(conformity, dim):
    got = gold.status_rollup(conformity, dim, MOMENT)
    assert got.schema.simpleString() == schemas.GOLD["conformite_commune"].simpleString()
    by_name = {r.nom_commune_norm: r for r in got.collect()}
    tourne = by_name["TOURNE"]
    assert (tourne.nb_prelevements_total, tourne.nb_prelevements_conformes,
            tourne.nb_prelevements_non_conformes) == (3, 2, 1)
    assert (tourne.taux_conformite_pct, tourne.taux_non_conformite_pct) == (66.67, 33.33)
    assert tourne.population == 1000 and tourne.code_region_geo == "75"
    assert by_name["ARVELLE"].nb_prelevements_sans_objet == 1
    # Same code, other name: no geography.
    assert by_name["ARVELLE VILLE"].code_region_geo is None
    assert sum(r.nb_prelevements_total for r in by_name.values()) == conformity.count()


def test_unique_samples_are_counted_without_their_own_shuffle(conformity, dim):
    plain = gold.status_rollup(conformity, dim, MOMENT, unique_samples=True)
    text = plan_of(plain).split("== Physical Plan ==")[1]
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning(annee" in line]
    assert len(shuffled) == 1 and "code_prelevement" not in shuffled[0]
    assert rows(plain) == rows(gold.status_rollup(conformity, dim, MOMENT))


def test_rollup_comes_before_the_join(conformity, dim):
    plan = gold.status_rollup(conformity, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_period_stats(spark, dim):
    base = {"annee_prelevement": 2025, "mois_prelevement": 1, "code_departement": "64",
            "code_commune": "64901", "nom_commune_norm": "TOURNE", "code_parametre": "NIT",
            "libelle_parametre_norm": "NITRATES", "categorie_parametre": "CHIMIE",
            "libelle_unite_norm": "mg/L"}
    facts = [(False, False, 10.0), (True, False, None), (False, True, 14.0)]
    df = filled(
        spark, schemas.SILVER["mesures"],
        *[{**base, "_resultat_manquant": m, "_est_outlier": o, "resultat_parse": v}
          for m, o, v in facts],
    )
    got = gold.period_stats(df, dim, MOMENT)
    assert got.schema.simpleString() == schemas.GOLD["evolution_parametres"].simpleString()
    r = got.first()
    assert (r.nb_mesures, r.nb_resultats_manquants, r.nb_outliers) == (3, 1, 1)
    assert (r.pct_resultats_manquants, r.pct_outliers) == (33.33, 33.33)
    assert (r.valeur_moyenne, r.valeur_mediane, r.valeur_min, r.valeur_max) == (12.0, 10.0, 10.0, 14.0)


def test_region_rollup(conformity, dim):
    population = gold.region_population(dim)
    assert rows(population) == [("75", 1500)]
    direct = gold.region_rollup(conformity, dim, population, MOMENT)
    assert direct.schema.simpleString() == schemas.GOLD["qualite_region"].simpleString()
    got = {r.code_region_geo: r for r in direct.collect()}
    assert (got["75"].nb_communes, got["75"].nb_prelevements_total) == (2, 4)
    assert got["75"].population_couverte == 1500 and got["75"].taux_conformite_pct == 50.0
    assert got[None].nb_prelevements_total == 1 and got[None].population_couverte is None
    statuses = gold.status_rollup(conformity, dim, MOMENT)
    assert rows(gold.region_of_statuses(statuses, population, MOMENT)) == rows(direct)


def test_region_rollup_counts_a_shared_sample_once(spark, dim):
    df = filled(spark, schemas.SILVER["conformite"], sample("P1", "C"),
                sample("P1", "C", "64902", "ARVELLE"))
    got = gold.region_rollup(df, dim, gold.region_population(dim)).first()
    assert (got.nb_communes, got.nb_prelevements_total, got.nb_prelevements_conformes) == (2, 1, 2)


def test_best_and_worst(spark):
    names = [("TOURNE", 100.0), ("ARVELLE", 60.0), ("MONTSAC", 20.0)]
    df = filled(
        spark, schemas.GOLD["top10_communes"],
        *[{"nom_commune_norm": n, "code_commune": n, "taux_conformite_pct": r,
           "nb_prelevements_total": 10} for n, r in names],
    ).drop("rang", "classement_type", "_gold_timestamp")
    got = gold.best_worst(df, 2, MOMENT)
    assert rows(got.select("classement_type", "rang", "nom_commune_norm")) == [
        ("MOINS_CONFORME", 1, "MONTSAC"), ("MOINS_CONFORME", 2, "ARVELLE"),
        ("PLUS_CONFORME", 1, "TOURNE"), ("PLUS_CONFORME", 2, "ARVELLE"),
    ]


def test_scores_collapse_years(conformity, dim):
    one = gold.status_rollup(conformity, dim, MOMENT)
    other = one.withColumn("annee_prelevement", F.lit(2024))
    scores = {r.nom_commune_norm: r for r in gold.score_rollup(one.unionByName(other)).collect()}
    assert scores["TOURNE"].nb_prelevements_total == 6
    assert scores["TOURNE"].taux_conformite_pct == 66.67 and scores["TOURNE"].population == 1000


def test_violations(spark, conformity, dim):
    def m(sample_code, value, flagged, limit):
        return {"code_prelevement": sample_code, "code_parametre": "NIT", "resultat_parse": value,
                "_est_outlier": flagged, "est_sous_seuil": False, "limite_qualite_parametre": limit}

    measures = filled(spark, schemas.SILVER["mesures"], m("P2", 1.0, True, None),
                      m("P2", 4.0, False, "<=50"), m("P1", 9.0, True, None))
    got = gold.violation_profile(gold.failed_samples(conformity), measures, dim, MOMENT)
    assert got.schema.simpleString() == schemas.GOLD["non_conformites"].simpleString()
    r = got.first()
    assert got.count() == 1 and r.nom_commune_norm == "TOURNE"
    assert (r.nb_prelevements_non_conformes, r.nb_mesures_associees) == (1, 2)
    assert (r.nb_mesures_avec_seuil_reglementaire, r.nb_outliers, r.pct_outliers) == (1, 1, 50.0)
    assert (r.valeur_moyenne, r.valeur_max) == (2.5, 4.0)


# Quality ------------------------------------------------------------------


def verdicts(results):
    return {(r.suite, r.rule, r["column"]): r for r in results.collect()}


def test_value_rules(spark):
    data = [("a", float(i)) for i in range(19)] + [(None, None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = verdicts(quality.check(df, {"s": [
        quality.not_null("k", 0.95), quality.not_null("k"), quality.between("v", 0, 18),
        quality.in_set("k", ["b"], 0.95), quality.unique(["k"]), quality.unique(["v"]),
        quality.row_count(21), quality.not_null("absent"), quality.column_exists(df, "v"),
        quality.column_type(df, "v", ["LongType"]), quality.columns_match(df, ["k", "v"]),
    ]}))
    # The looser and the strict rule share a key; the strict one comes last.
    assert not got["s", "not_null", "k"].success
    assert got["s", "between", "v"].success and got["s", "between", "v"].n_checked == 19
    assert got["s", "in_set", "k"].n_unexpected == 19 and not got["s", "in_set", "k"].success
    assert got["s", "unique", "k"].n_unexpected == 19 and got["s", "unique", "v"].success
    assert not got["s", "row_count_at_least", None].success
    assert not got["s", "not_null", "absent"].success
    assert got["s", "column_exists", "v"].success
    assert not got["s", "column_type_in_list", "v"].success
    assert got["s", "columns_match_ordered_list", None].success


def test_ratio_of_exactly_mostly_holds(spark):
    df = spark.range(20).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    assert quality.check(df, {"s": [quality.not_null("v", 0.95)]}).first().success
    worse = df.unionByName(df.filter("v is null"))
    assert not quality.check(worse, {"s": [quality.not_null("v", 0.95)]}).first().success


def test_empty_tables_hold(spark):
    df = spark.createDataFrame([], "k string, v double")
    results = quality.check(df, {"s": [quality.not_null("k", 0.95), quality.between("v", 0, 1),
                                       quality.unique(["k"]), quality.row_count(0)]})
    assert all(r.success for r in results.collect())


def test_value_rules_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    filled(spark, schemas.SILVER["mesures"], {"libelle_parametre_norm": "PH", "resultat_parse": 7.0}
           ).write.parquet(path)
    df = spark.read.schema(schemas.SILVER["mesures"]).parquet(path)
    results = quality.check_measures(df)
    assert plan_of(results).split("== Physical Plan ==")[1].count("FileScan parquet") == 1
    summary = {r.suite: r.success for r in quality.suite_summary(results).collect()}
    assert len(summary) == 6 and summary["silver_mesures_range_pH_suite"]
    assert not summary["silver_mesures_schema_suite"]
    fewer = quality.check_measures(df, {"pH": (8.0, 9.0)})
    assert {r.suite: r.success for r in quality.suite_summary(fewer).collect()} == {
        "silver_mesures_schema_suite": False, "silver_mesures_range_pH_suite": False,
    }


def test_quality_views(spark):
    df = filled(spark, schemas.SILVER["mesures"],
                {"libelle_parametre_norm": "PH", "resultat_parse": 7.0},
                {"libelle_parametre_norm": "PH", "resultat_parse": None},
                {"libelle_parametre_norm": "TURBIDITÉ", "resultat_parse": 1.0})
    assert quality.view_rows(df, "pH").count() == 1
    assert quality.view_rows(df, "turbidite_ntu").count() == 1


# Serving ------------------------------------------------------------------


@pytest.fixture(scope="module")
def statuses(spark):
    def r(year, code, name, rate, total, lon=1.0, **more):
        return {"annee_prelevement": year, "code_commune": code, "nom_commune_norm": name,
                "taux_conformite_pct": rate, "nb_prelevements_total": total, "longitude": lon,
                "latitude": lon, "code_departement": "01", **more}

    return filled(
        spark, schemas.GOLD["conformite_commune"],
        r(2024, "a", "A", 50.0, 10), r(2025, "a", "A", 80.0, 4), r(2025, "b", "B", None, 0, None),
        r(2025, "c", "C", 80.0, 6, code_departement="64"), r(2025, None, None, 10.0, 1),
        r(2025, "a", "A bis", 90.0, 2, None),
    )


@pytest.fixture(scope="module")
def stats(spark):
    def r(year, month, code, name, mean, n, unit="mg/L", label="NITRATES (EN NO3)"):
        return {"annee_prelevement": year, "mois_prelevement": month, "code_commune": code,
                "nom_commune_norm": name, "valeur_moyenne": mean, "nb_mesures": n,
                "nb_resultats_manquants": 0 if mean else n, "libelle_unite_norm": unit,
                "libelle_parametre_norm": label, "code_departement": "01", "valeur_min": mean,
                "valeur_max": mean}

    return filled(
        spark, schemas.GOLD["evolution_parametres"],
        r(2025, 1, "a", "A", 10.0, 3), r(2025, 2, "a", "A", None, 1), r(2024, 12, "a", "A", 2.0, 1),
        r(2025, 1, "b", "", 7.0, 9, ""), r(2025, None, "a", "A", 1.0, 1),
        r(2025, 1, "c", "C", 3.0, 0), r(2025, 1, "d", "D", 5.0, 2, label="PH"),
        r(2025, 3, None, None, 4.0, 50),
    )


def test_pages(statuses):
    first = serving.page(statuses, "conformite_commune", limit=2)
    names = [r.nom_commune_norm for r in first.rows.collect()]
    assert names == ["A bis", "A"] and first.total.first().row_count == 6
    rest = serving.page(statuses, "conformite_commune", limit=1000, offset=2)
    tail = [r.nom_commune_norm for r in rest.rows.collect()]
    assert tail == ["C", None, "B", "A"]
    assert serving.page(statuses, "conformite_commune", offset=99).rows.count() == 0
    assert serving.page(statuses, "conformite_commune", offset=99).total.first()[0] == 6
    assert "TakeOrderedAndProject" in plan_of(first.rows)


def test_page_filters(statuses):
    def total(**filters):
        return serving.page(statuses, "conformite_commune", **filters).total.first().row_count

    assert total(annee_prelevement=2025, code_commune=None) == 5
    assert total(code_departement=1) == 5 and total(code_departement="64") == 1
    assert total(min_taux_conformite_pct=80.0) == 3
    counted = serving.page(statuses, "conformite_commune", code_commune="a").with_total()
    assert [r.row_count for r in counted.collect()] == [3, 3, 3]


@pytest.mark.parametrize(
    "table, options",
    [("conformite_commune", {"limit": 0}), ("conformite_commune", {"limit": 1001}),
     ("conformite_commune", {"offset": -1}), ("top10_communes", {"limit": 21}),
     ("evolution_parametres", {"mois_prelevement": 13}), ("conformite_commune", {"nope": 1}),
     ("top10_communes", {"classement_type": "X"}),
     ("non_conformites", {"min_taux_conformite_pct": 1.0})],
)
def test_page_arguments_are_checked(statuses, table, options):
    with pytest.raises(ValueError):
        serving.page(statuses, table, **options)


def test_menus(statuses, stats):
    menus = serving.menu_values(statuses, stats, year=2025, dept=1)
    assert [r[0] for r in menus["years"].collect()] == [2025, 2024]
    assert [r[0] for r in menus["parameters"].collect()] == ["NITRATES (EN NO3)", "PH"]
    assert [tuple(r) for r in menus["communes"].collect()] == [("a", "A"), ("a", "A bis"), ("b", "B")]


def test_weighted_top(stats):
    got = serving.weighted_top(stats, "NITRATES (EN NO3)", year=2025)
    picked = [(r.code_commune, r.nb_mesures, r.valeur_moyenne_ponderee) for r in got.collect()]
    # A missing mean weighs in as zero; a place without measures is left out.
    assert picked == [("b", 9, 7.0), ("a", 5, 6.2), (None, 50, 4.0)]
    fair = serving.weighted_top(stats, "NITRATES (EN NO3)", year=2025, exclude_missing=True)
    assert {r.code_commune: r.valeur_moyenne_ponderee for r in fair.collect()}["a"] == 7.75
    assert [r.code_commune for r in serving.top_bars(got, 2).collect()] == ["a", "b"]


def test_kpi_summary(statuses, stats):
    got = serving.kpi_summary(statuses, stats, "NITRATES (EN NO3)", year=2025).first()
    assert tuple(got) == (5, 13, round((80 * 4 + 80 * 6 + 10 + 90 * 2) / 13, 2), 64)
    chosen = serving.kpi_summary(statuses, stats, None, 2025, communes=["a", "zz"]).first()
    assert tuple(chosen) == (2, 6, round((80 * 4 + 90 * 2) / 6, 2), 5)
    unknown = serving.kpi_summary(statuses, stats, None, 2025, communes=["zz"]).first()
    assert unknown.nb_communes == 5
    none = serving.kpi_summary(statuses, stats, None, 1900).first()
    assert tuple(none) == (0, 0, None, 0)


def test_most_measured_and_series(stats):
    label = stats.filter("libelle_parametre_norm like 'NIT%'")
    assert [r.code_commune for r in serving.most_measured(label).collect()] == ["a", "c"]
    got = serving.series(stats, "NITRATES (EN NO3)")
    assert [(r.nom_commune_norm, r.periode, r.valeur_moyenne) for r in got.collect()] == [
        ("A", "2024-12", 2.0), ("A", "2025-01", 10.0), ("A", "2025-02", None), ("C", "2025-01", 3.0),
    ]
    chosen = serving.series(stats, "NITRATES (EN NO3)", 2025, ["b"])
    assert [(r.nom_commune_norm, r.periode) for r in chosen.collect()] == [("INCONNUE", "2025-01")]
    assert serving.series_unit(stats, "NITRATES (EN NO3)").first()[0] == "mg/L"


def test_map_points(statuses):
    got = serving.map_points(statuses, 2025)
    picked = [(r.code_commune, r.nom_commune_norm, r.metric_value, r.size_value, r.marker_size,
               r.population) for r in got.collect()]
    assert picked == [("a", "A", 90.0, 2.0, 12, 0), ("c", "C", 80.0, 6.0, 12, 0),
                      ("a", "A", 80.0, 4.0, 12, 0)]


def test_defaults(statuses, stats):
    assert tuple(serving.defaults(statuses, stats).first()) == (2025, "NITRATES (EN NO3)")
    other = stats.filter("libelle_parametre_norm = 'PH'")
    assert serving.defaults(statuses, other).first()[1] == "PH"


# Reports ------------------------------------------------------------------


def test_reports(spark):
    ok = spark.range(3)
    report = reports.layer_report(
        spark, {"good": lambda: ok, "gone": lambda: spark.read.parquet("/no/such/folder")}
    )
    assert rows(report) == [("TOTAL", 3, None), ("gone", None, "PATH_NOT_FOUND"), ("good", 3, None)]
    assert rows(reports.table_counts({"a": ok, "b": ok})) == [("a", 3), ("b", 3)]


def test_step_metrics(spark):
    df = raw(spark, {"resultat_alphanumerique": "1"}, {"resultat_alphanumerique": "1"},
             {"resultat_alphanumerique": "ND", "date_prelevement": "x"})
    typed = silver.type_results(df)
    assert tuple(reports.typed_metrics(typed).first()) == (3, 1, 1, 1)
    assert tuple(reports.missing_metrics(typed).first()) == (3, 2, 1)
    flagged = spark.createDataFrame([(True,), (False,), (False,)], "_est_outlier boolean")
    assert tuple(reports.outlier_metrics(flagged).first()) == (3, 1, 33.33)
    assert reports.preview(df, ["code_prelevement"], 2).count() == 2


# Jobs ---------------------------------------------------------------------


def test_stage_ranges():
    assert jobs.stage_range("bronze", "gold") == ["bronze", "silver", "gold"]
    assert jobs.stage_range("silver", "gold", True) == ["silver", "quality", "gold"]
    assert jobs.stage_range("gold", "gold", True) == ["gold"]
    for bad in (("gold", "bronze"), ("x", "gold"), ("bronze", "x")):
        with pytest.raises(ValueError):
            jobs.stage_range(*bad)
