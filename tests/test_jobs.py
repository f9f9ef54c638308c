import pytest
from test_sources import feature, save

from assayline import schemas
from assayline.plans import jobs, reports
from assayline.plans.quality import RANGES
from assayline.sources import Layout, read_table, register_views

# Ordered statements a reader of the gold views runs, and their rows here.
STATEMENTS = {
    "SELECT annee_prelevement, nom_commune_norm, taux_conformite_pct FROM gold_conformite_commune "
    "ORDER BY annee_prelevement DESC, taux_conformite_pct DESC LIMIT 100": 2,
    "SELECT annee_prelevement, mois_prelevement, libelle_parametre_norm, valeur_moyenne "
    "FROM gold_evolution_parametres WHERE libelle_parametre_norm = 'NITRATES (EN NO3)' "
    "ORDER BY annee_prelevement, mois_prelevement LIMIT 100": 2,
    "SELECT annee_prelevement, code_region_geo, taux_conformite_pct FROM gold_qualite_region "
    "ORDER BY annee_prelevement DESC, taux_conformite_pct DESC LIMIT 100": 2,
    "SELECT classement_type, rang, nom_commune_norm, taux_conformite_pct "
    "FROM gold_top10_communes ORDER BY classement_type, rang": 4,
    "SELECT annee_prelevement, nom_commune_norm, libelle_parametre_norm, "
    "nb_prelevements_non_conformes FROM gold_non_conformites "
    "ORDER BY nb_prelevements_non_conformes DESC LIMIT 100": 1,
}
MOMENT = "2025-06-01 00:00:00"


def result(sample, parameter, label, text, commune="01001", name="Bourg", year=2024, **more):
    return {"code_prelevement": sample, "code_parametre": parameter, "libelle_parametre": label,
            "resultat_alphanumerique": text, "code_commune": commune, "nom_commune": name,
            "code_departement": commune[:2], "nom_departement": "Dep",
            "date_prelevement": f"{year}-03-01T08:00:00Z", "libelle_unite": "mg/l",
            "conformite_limites_bact_prelevement": "C", "conformite_limites_pc_prelevement": "C",
            "conformite_references_bact_prelevement": "C",
            "conformite_references_pc_prelevement": "C",
            "reseaux": [{"code": "R1", "nom": "Réseau"}], **more}


def network(commune, name):
    return {"code_commune": commune, "nom_commune": name, "nom_quartier": "Q", "code_reseau": "R1",
            "nom_reseau": "Réseau", "debut_alim": "2010-10-16", "annee": "2024"}


def place(code, name, region, point):
    made = feature(code, name, point)
    made["properties"].update(codeDepartement=code[:2], codeRegion=region, population=100)
    return made


def landed(root, acidity="7,2"):
    bad = {"conformite_limites_bact_prelevement": "n"}
    paths = {
        "geo_communes": save(
            root / "geo", a={"features": [place("01001", "Old", "84", [5.0, 46.0])]},
            b={"features": [place("01001", "Bourg", "84", [5.2, 46.2]),
                            place("2A004", "Ajaccio", "94", "none")]}),
        "communes_udi": save(root / "udi", a={"count": 2, "next": None, "data": [
            network("01001", "Bourg"), network("2A004", "Ajaccio")]}),
        "resultats_dis": save(
            root / "res",
            p1={"count": 5, "next": "x", "data": [
                result("S1", "NIT", "Nitrates (en NO3)", "<0,5"),
                result("S1", "NIT", "Nitrates (en NO3)", "<0,5"),
                result("S1", "PH", "pH", acidity)]},
            p2={"count": 5, "next": None, "data": [
                result("S2", "NIT", "Nitrates (en NO3)", "60", "2A004", "Ajaccio", 2025, **bad),
                result("S3", "PH", "pH", "ND", date_prelevement="nonsense")]},
            p3={"error": "unavailable"}),
    }
    return jobs.Landing(paths, {name: f"https://example.org/{name}" for name in paths})


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return landed(tmp_path_factory.mktemp("landing"))


def test_whole_run(spark, landing, tmp_path):
    layout = Layout(root=str(tmp_path))
    done = jobs.run(spark, layout, landing, with_quality=True, moment=MOMENT)
    assert list(done) == ["bronze", "silver", "quality", "gold"]
    assert done["bronze"] == {"geo_communes": 2, "communes_udi": 2, "resultats_dis": 5}
    assert done["silver"] == {"stations": 2, "mesures": 3, "conformite": 2}
    assert done["gold"] == {"conformite_commune": 2, "qualite_region": 2, "top10_communes": 4,
                            "evolution_parametres": 3, "non_conformites": 1}

    def table(layer, name, schema):
        return read_table(spark, layout, layer, name, schema)

    statuses = table("gold", "conformite_commune", schemas.GOLD["conformite_commune"])
    got = {r.code_commune: r for r in statuses.collect()}
    assert got["01001"].code_departement == "01" and got["2A004"].code_departement == "2A"
    assert got["01001"].longitude == 5.2 and got["01001"].nom_commune_norm == "BOURG"
    assert got["01001"].taux_conformite_pct == 100.0 and got["2A004"].taux_conformite_pct == 0.0
    bronze = table("bronze", "resultats_dis", schemas.BRONZE["resultats_dis"])
    assert {r.reseaux for r in bronze.collect()} == {'[{"code":"R1","nom":"Réseau"}]'}
    assert {r._partition_annee for r in bronze.collect()} == {2024, 2025, None}
    violations = table("gold", "non_conformites", schemas.GOLD["non_conformites"]).first()
    assert (violations.code_commune, violations.valeur_max) == ("2A004", 60.0)
    suites = {r.suite: r.success for r in done["quality"].groupBy("suite").agg(
        {"success": "min"}).toDF("suite", "success").collect()}
    assert len(suites) == 9 and suites["silver_stations_uniqueness_suite"]
    register_views(spark, layout, "gold", schemas.GOLD, "gold_")
    for statement, n in STATEMENTS.items():
        assert spark.sql(statement).count() == n
    report = reports.report_of(spark, layout, "gold", schemas.GOLD)
    assert {r.table_name: r.row_count for r in report.collect()}["TOTAL"] == 12


def test_run_again_and_in_parts(spark, landing, tmp_path):
    layout = Layout(root=str(tmp_path))
    assert jobs.bronze(spark, layout, landing, only="communes_udi") == {"communes_udi": 2}
    first = jobs.run(spark, layout, landing, moment=MOMENT)
    again = jobs.run(spark, layout, first="silver", moment=MOMENT)
    assert again == {k: first[k] for k in ("silver", "gold")}
    with pytest.raises(ValueError):
        jobs.bronze(spark, layout, landing, only="nope")
    with pytest.raises(ValueError):
        jobs.run(spark, layout)


def test_gate_stops_on_failed_suites(spark, landing, tmp_path):
    layout = Layout(root=str(tmp_path / "good"))
    jobs.run(spark, layout, landing, last="silver", moment=MOMENT)
    assert jobs.quality(spark, layout, gate=True).filter("not success").isEmpty()
    layout = Layout(root=str(tmp_path / "bad"))
    acid = landed(tmp_path / "acid", "3,9")
    jobs.run(spark, layout, acid, last="silver", moment=MOMENT)
    assert [r.rule for r in jobs.quality(spark, layout).filter("not success").collect()] == ["between"]
    with pytest.raises(jobs.QualityError, match="silver_mesures_range_pH_suite"):
        jobs.run(spark, layout, first="silver", with_quality=True, gate=True, moment=MOMENT)
    wider = {**RANGES, "pH": (3.0, 10.0)}
    jobs.run(spark, layout, first="silver", last="silver", with_quality=True, gate=True,
             moment=MOMENT, ranges=wider)


def test_catalog_run(spark, landing):
    names = {layer: f"run_{layer}" for layer in ("bronze", "silver", "gold")}
    layout = Layout(namespaces=names)
    done = jobs.run(spark, layout, landing, with_quality=True, moment=MOMENT)
    assert done["gold"]["conformite_commune"] == 2
    assert spark.table("run_gold.conformite_commune").count() == 2
    spark.sql("USE default")
    for name in names.values():
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_a_further_batch_is_added(spark, tmp_path):
    layout = Layout(root=str(tmp_path / "out"), compression="zstd")
    one, two = landed(tmp_path / "one"), landed(tmp_path / "two")
    first = jobs.bronze(spark, layout, one, only="resultats_dis", moment=MOMENT)
    both = jobs.bronze(spark, layout, two, only="resultats_dis", moment=MOMENT, append=True)
    assert both["resultats_dis"] == 2 * first["resultats_dis"] > 0
    assert list((tmp_path / "out" / "bronze" / "resultats_dis").rglob("*.zstd.parquet"))
    with pytest.raises(ValueError, match="landed whole"):
        jobs.bronze(spark, layout, two, only="geo_communes", append=True)
