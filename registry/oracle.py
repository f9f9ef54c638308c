"""SQL of the contract-shaped views and of every registered query."""

import re

_LABEL = """CASE l_linenumber WHEN 1 THEN 'Nitrates (en NO3)' WHEN 2 THEN ' pH'
 WHEN 3 THEN 'Turbidité néphélométrique NFU' WHEN 4 THEN 'Nitrites (en NO2) '
 WHEN 5 THEN 'Conductivité à 25°C' WHEN 6 THEN 'Escherichia coli'
 WHEN 7 THEN 'Tritium (activité)' END"""
_UNIT = """CASE l_linenumber WHEN 1 THEN 'mg/l' WHEN 3 THEN 'NFU' WHEN 4 THEN ' MG/L'
 WHEN 5 THEN 'us/cm' WHEN 6 THEN 'n/(100mL)' WHEN 7 THEN 'Bq/L' END"""
_CATEGORY = """CASE l_linenumber WHEN 7 THEN 'RADIOACTIVITE' WHEN 6 THEN 'MICROBIOLOGIE'
 ELSE 'CHIMIE' END"""
_RESULT_TEXT = """CASE WHEN l_tax = 0 THEN ' nd ' WHEN l_tax = 0.01 THEN '1e-3'
 WHEN l_tax = 0.02 THEN '< 0,5' WHEN l_tax = 0.03 THEN '≤3' WHEN l_tax = 0.04 THEN '-1,25'
 WHEN l_tax > 0.05 THEN CASE l_returnflag WHEN 'A' THEN '<' WHEN 'R' THEN ' >' ELSE '' END
   || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_linestatus = 'O' THEN ',' ELSE '.' END
   || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END"""


def parsed(text: str) -> str:
    plain = f"replace(regexp_replace(trim({text}), '[<>≤≥~]', '', 'g'), ',', '.')"
    return (
        f"CASE WHEN regexp_matches({plain}, '^-?[0-9]+(\\.[0-9]+)?$') "
        f"THEN TRY_CAST({plain} AS DOUBLE) END"
    )


def bbox(lon: str, lat: str) -> str:
    return f"(({lon} BETWEEN -5.5 AND 9.6) AND ({lat} BETWEEN 41.0 AND 51.2))"


def worst(*columns: str) -> str:
    bad = " OR ".join(f"coalesce({c} = 'N', false)" for c in columns)
    good = " AND ".join(f"coalesce({c} = 'C', false)" for c in columns)
    return f"CASE WHEN {bad} THEN 'N' WHEN {good} THEN 'C' ELSE 'S' END"


def unit_norm(c: str) -> str:
    t = f"trim({c})"
    return (
        f"CASE {t} WHEN 'ug/l' THEN 'ug/L' WHEN 'mg/l' THEN 'mg/L' WHEN 'MG/L' THEN 'mg/L' "
        f"WHEN 'us/cm' THEN 'uS/cm' WHEN 'ntu' THEN 'NTU' WHEN 'NFU' THEN 'NTU' ELSE {t} END"
    )


_NAME = (
    "CASE WHEN o_orderpriority = '5-LOW' THEN upper(c_name) || ' ECARTS' ELSE upper(c_name) END"
)
_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'C' WHEN 'F' THEN 'N' ELSE 'S' END"
_LATE = "(l_linenumber = 7 AND o_orderstatus = 'P')"
_LOST = "(o_orderpriority = '4-NOT SPECIFIED' AND l_linenumber = 6)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "place_rows": (
        (),
        """SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS nom,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS "codeDepartement",
  CAST(n_regionkey AS VARCHAR) AS "codeRegion",
  CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS population,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal / 600 - 6 END AS longitude,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal / 900 + 40 END AS latitude
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'N' || CAST(n_nationkey AS VARCHAR), n_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0'),
  CAST(n_regionkey AS VARCHAR), CAST(n_nationkey * 1000 AS BIGINT),
  n_nationkey / CAST(2.0 AS DOUBLE) - 6, n_nationkey / CAST(2.0 AS DOUBLE) + 40
FROM nation""",
    ),
    "places": (
        ("place_rows",),
        f"""SELECT code AS code_commune, upper(nom) AS nom_commune_norm,
  "codeDepartement" AS code_departement_geo, "codeRegion" AS code_region_geo,
  population, longitude, latitude, {bbox("longitude", "latitude")} AS _coords_valides
FROM place_rows""",
    ),
    "order_places": (
        (),
        """SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "samples": (
        ("order_places",),
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS code_prelevement,
  CAST(year(o_orderdate) AS INTEGER) AS annee_prelevement,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code_departement,
  upper(n_name) AS nom_departement_norm, CAST(o_custkey AS VARCHAR) AS code_commune,
  {_NAME} AS nom_commune_norm, {_STATUS} AS conformite_globale,
  o_orderpriority AS conclusion_conformite_prelevement
FROM order_places""",
    ),
    "measures": (
        ("order_places",),
        f"""SELECT CAST(l_orderkey AS VARCHAR) AS code_prelevement,
  CAST(year(o_orderdate) AS INTEGER) AS annee_prelevement,
  CAST(month(o_orderdate) AS INTEGER) AS mois_prelevement,
  lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code_departement,
  upper(n_name) AS nom_departement_norm, 'N' || CAST(n_nationkey AS VARCHAR) AS code_commune,
  upper(n_name) AS nom_commune_norm, 'P' || CAST(l_linenumber AS VARCHAR) AS code_parametre,
  upper(trim({_LABEL})) AS libelle_parametre_norm,
  coalesce(trim({_UNIT}), 'INCONNUE') AS libelle_unite_norm,
  CASE WHEN l_tax > 0 THEN l_quantity END AS resultat_parse,
  NOT (l_tax > 0) AS _resultat_manquant, l_extendedprice > 85000 AS _est_outlier,
  l_returnflag = 'A' AS est_sous_seuil,
  CASE WHEN l_returnflag <> 'N' THEN '<=50 mg/L' END AS limite_qualite_parametre,
  CASE WHEN l_linestatus = 'O' THEN '>=1' END AS reference_qualite_parametre,
  '[{{"code":"S' || CAST(l_suppkey AS VARCHAR) || '","nom":"A"}},{{"code":"R'
    || CAST(l_linenumber AS VARCHAR) || '","nom":"B"}}]' AS reseaux,
  {_CATEGORY} AS categorie_parametre
FROM lineitem LEFT JOIN order_places ON l_orderkey = o_orderkey""",
    ),
    "results": (
        ("order_places",),
        f"""SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code_departement,
  ' ' || lower(n_name) AS nom_departement,
  CASE WHEN NOT {_LOST} THEN CAST(o_custkey AS VARCHAR) END AS code_commune,
  c_name || '  ' AS nom_commune, CAST(l_orderkey AS VARCHAR) AS code_prelevement,
  CASE WHEN {_LATE} THEN '2025-13-01T00:00:00Z'
    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS date_prelevement,
  CAST(l_partkey AS VARCHAR) AS reference_analyse,
  'P' || CAST(l_linenumber AS VARCHAR) AS code_parametre, {_LABEL} AS libelle_parametre,
  l_returnflag AS code_type_parametre, l_linestatus AS code_lieu_analyse,
  {_RESULT_TEXT} AS resultat_alphanumerique,
  CASE WHEN l_discount > 0.05 THEN l_extendedprice END AS resultat_numerique,
  {_UNIT} AS libelle_unite,
  CASE WHEN l_returnflag <> 'N' THEN '<=50 mg/L' END AS limite_qualite_parametre,
  CASE WHEN l_linestatus = 'O' THEN '>=1' END AS reference_qualite_parametre,
  o_orderpriority AS conclusion_conformite_prelevement,
  lower({_STATUS}) AS conformite_limites_bact_prelevement,
  'C ' AS conformite_limites_pc_prelevement,
  CASE WHEN o_orderstatus <> 'P' THEN 'C' END AS conformite_references_bact_prelevement,
  'C' AS conformite_references_pc_prelevement, 'UGE' AS nom_uge,
  CASE WHEN l_suppkey > 9 THEN s_name END AS nom_distributeur, 'MOA' AS nom_moa,
  CAST(l_suppkey AS VARCHAR) AS reseau_code, s_name AS reseau_nom,
  l_shipdate AS _ingestion_timestamp
FROM lineitem LEFT JOIN order_places ON l_orderkey = o_orderkey
LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "typed": (
        ("results",),
        f"""SELECT *,
  TRY_CAST(try_strptime(date_prelevement, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts,
  coalesce(resultat_numerique, {parsed("resultat_alphanumerique")}) AS resultat_parse
FROM results""",
    ),
    "deduped": (
        ("typed",),
        """SELECT * FROM typed QUALIFY row_number() OVER (
  PARTITION BY code_prelevement, code_parametre, date_prelevement
  ORDER BY _ingestion_timestamp DESC NULLS LAST, code_departement NULLS FIRST,
    nom_departement NULLS FIRST, code_commune NULLS FIRST, nom_commune NULLS FIRST,
    reference_analyse NULLS FIRST, libelle_parametre NULLS FIRST,
    code_type_parametre NULLS FIRST, code_lieu_analyse NULLS FIRST,
    resultat_alphanumerique NULLS FIRST, resultat_numerique NULLS FIRST,
    libelle_unite NULLS FIRST, limite_qualite_parametre NULLS FIRST,
    reference_qualite_parametre NULLS FIRST, conclusion_conformite_prelevement NULLS FIRST,
    conformite_limites_bact_prelevement NULLS FIRST,
    conformite_references_bact_prelevement NULLS FIRST,
    nom_distributeur NULLS FIRST, reseau_code NULLS FIRST, reseau_nom NULLS FIRST) = 1""",
    ),
    "clean": (
        ("deduped",),
        f"""SELECT code_prelevement, reference_analyse, code_commune,
  upper(trim(nom_commune)) AS nom_commune_norm, code_departement,
  upper(trim(nom_departement)) AS nom_departement_norm, ts,
  CAST(year(ts) AS INTEGER) AS annee_prelevement,
  CAST(month(ts) AS INTEGER) AS mois_prelevement, code_parametre,
  upper(trim(libelle_parametre)) AS libelle_parametre_norm, code_type_parametre,
  code_lieu_analyse, resultat_parse, resultat_alphanumerique,
  starts_with(resultat_alphanumerique, '<') AS est_sous_seuil,
  starts_with(resultat_alphanumerique, '>') AS est_sur_seuil,
  coalesce({unit_norm("libelle_unite")}, 'INCONNUE') AS libelle_unite_norm,
  limite_qualite_parametre, reference_qualite_parametre,
  coalesce(nom_distributeur, 'INCONNU') AS nom_distributeur, nom_uge, nom_moa,
  resultat_parse IS NULL AS _resultat_manquant, conclusion_conformite_prelevement,
  upper(trim(conformite_limites_bact_prelevement)) AS conformite_bact_limite_norm,
  upper(trim(conformite_limites_pc_prelevement)) AS conformite_pc_limite_norm,
  upper(trim(conformite_references_bact_prelevement)) AS conformite_bact_ref_norm,
  upper(trim(conformite_references_pc_prelevement)) AS conformite_pc_ref_norm,
  reseau_code, reseau_nom, _ingestion_timestamp,
  CASE code_parametre WHEN 'P7' THEN 'RADIOACTIVITE' WHEN 'P6' THEN 'MICROBIOLOGIE'
    ELSE 'CHIMIE' END AS categorie_parametre
FROM deduped WHERE ts IS NOT NULL AND code_commune IS NOT NULL""",
    ),
    "flagged": (
        ("clean",),
        """SELECT c.*, coalesce(resultat_parse < q1 - 3 * (q3 - q1)
    OR resultat_parse > q3 + 3 * (q3 - q1), false) AS _est_outlier
FROM clean c LEFT JOIN (
  SELECT code_parametre AS p, quantile_disc(resultat_parse, 0.25) AS q1,
    quantile_disc(resultat_parse, 0.75) AS q3
  FROM clean WHERE resultat_parse IS NOT NULL GROUP BY 1) ON code_parametre = p""",
    ),
    "conformity": (
        ("clean",),
        f"""SELECT *, {worst("conformite_bact_limite_norm", "conformite_pc_limite_norm",
    "conformite_bact_ref_norm", "conformite_pc_ref_norm")} AS conformite_globale
FROM clean QUALIFY row_number() OVER (PARTITION BY code_prelevement ORDER BY ts,
  code_commune NULLS FIRST, nom_commune_norm NULLS FIRST, nom_departement_norm NULLS FIRST,
  nom_distributeur NULLS FIRST, conformite_bact_limite_norm NULLS FIRST,
  conformite_bact_ref_norm NULLS FIRST, conclusion_conformite_prelevement NULLS FIRST,
  reseau_code NULLS FIRST, reseau_nom NULLS FIRST) = 1""",
    ),
    "statuses": (
        ("samples", "places"),
        """SELECT annee_prelevement, code_departement, nom_departement_norm, code_region_geo,
  code_commune, nom_commune_norm, max(population) AS population, max(longitude) AS longitude,
  max(latitude) AS latitude, bool_or(_coords_valides) AS _coords_valides,
  CAST(count(DISTINCT code_prelevement) AS BIGINT) AS nb_prelevements_total,
  CAST(count(*) FILTER (conformite_globale = 'C') AS BIGINT) AS nb_prelevements_conformes,
  CAST(count(*) FILTER (conformite_globale = 'N') AS BIGINT) AS nb_prelevements_non_conformes,
  CAST(count(*) FILTER (conformite_globale = 'S') AS BIGINT) AS nb_prelevements_sans_objet,
  round(100 * nb_prelevements_conformes / nb_prelevements_total, 2) AS taux_conformite_pct,
  round(100 * nb_prelevements_non_conformes / nb_prelevements_total, 2)
    AS taux_non_conformite_pct
FROM samples LEFT JOIN places USING (code_commune, nom_commune_norm)
GROUP BY ALL""",
    ),
    "stats": (
        ("measures", "places"),
        """SELECT annee_prelevement, mois_prelevement, code_departement, nom_departement_norm,
  code_region_geo, code_commune, nom_commune_norm, code_parametre, libelle_parametre_norm,
  categorie_parametre, libelle_unite_norm, CAST(count(*) AS BIGINT) AS nb_mesures,
  CAST(count(*) FILTER (_resultat_manquant) AS BIGINT) AS nb_resultats_manquants,
  CAST(count(*) FILTER (_est_outlier) AS BIGINT) AS nb_outliers,
  round(avg(resultat_parse), 4) AS valeur_moyenne,
  round(quantile_disc(resultat_parse, 0.5), 4) AS valeur_mediane,
  round(min(resultat_parse), 4) AS valeur_min, round(max(resultat_parse), 4) AS valeur_max,
  round(100 * nb_resultats_manquants / nb_mesures, 2) AS pct_resultats_manquants,
  round(100 * nb_outliers / nb_mesures, 2) AS pct_outliers
FROM measures LEFT JOIN places USING (code_commune, nom_commune_norm)
GROUP BY ALL""",
    ),
    "regions": (
        ("samples", "places"),
        """SELECT r.*, population_couverte,
  round(100 * nb_prelevements_conformes / nb_prelevements_total, 2) AS taux_conformite_pct,
  round(100 * nb_prelevements_non_conformes / nb_prelevements_total, 2)
    AS taux_non_conformite_pct
FROM (
  SELECT annee_prelevement, code_region_geo,
    CAST(count(DISTINCT code_commune) AS BIGINT) AS nb_communes,
    CAST(count(DISTINCT code_prelevement) AS BIGINT) AS nb_prelevements_total,
    CAST(count(*) FILTER (conformite_globale = 'C') AS BIGINT) AS nb_prelevements_conformes,
    CAST(count(*) FILTER (conformite_globale = 'N') AS BIGINT) AS nb_prelevements_non_conformes,
    CAST(count(*) FILTER (conformite_globale = 'S') AS BIGINT) AS nb_prelevements_sans_objet
  FROM samples LEFT JOIN places USING (code_commune, nom_commune_norm) GROUP BY 1, 2) r
LEFT JOIN (
  SELECT code_region_geo AS region, CAST(sum(coalesce(population, 0)) AS BIGINT)
    AS population_couverte
  FROM places WHERE code_region_geo IS NOT NULL GROUP BY 1) ON code_region_geo = region""",
    ),
    "scores": (
        ("statuses",),
        """SELECT code_departement, nom_departement_norm, code_region_geo, code_commune,
  nom_commune_norm, max(population) AS population, max(longitude) AS longitude,
  max(latitude) AS latitude,
  CAST(sum(nb_prelevements_total) AS BIGINT) AS nb_prelevements_total,
  CAST(sum(nb_prelevements_conformes) AS BIGINT) AS nb_prelevements_conformes,
  CAST(sum(nb_prelevements_non_conformes) AS BIGINT) AS nb_prelevements_non_conformes,
  CAST(sum(nb_prelevements_sans_objet) AS BIGINT) AS nb_prelevements_sans_objet,
  round(100 * sum(s.nb_prelevements_conformes) / sum(s.nb_prelevements_total), 2)
    AS taux_conformite_pct,
  round(100 * sum(s.nb_prelevements_non_conformes) / sum(s.nb_prelevements_total), 2)
    AS taux_non_conformite_pct
FROM statuses s GROUP BY 1, 2, 3, 4, 5""",
    ),
    "ranked": (
        ("scores",),
        """SELECT * FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY taux_conformite_pct DESC NULLS LAST,
    nb_prelevements_total DESC NULLS LAST, nom_commune_norm NULLS LAST,
    code_commune NULLS LAST, code_departement NULLS LAST) AS INTEGER) AS rang,
    'PLUS_CONFORME' AS classement_type FROM scores) WHERE rang <= 10
UNION ALL BY NAME
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY taux_conformite_pct ASC NULLS LAST,
    nb_prelevements_total DESC NULLS LAST, nom_commune_norm NULLS LAST,
    code_commune NULLS LAST, code_departement NULLS LAST) AS INTEGER) AS rang,
    'MOINS_CONFORME' AS classement_type FROM scores) WHERE rang <= 10""",
    ),
    "violations": (
        ("samples", "measures", "places"),
        """SELECT s.annee_prelevement, s.code_departement, s.nom_departement_norm,
  p.code_region_geo, s.code_commune, s.nom_commune_norm, m.code_parametre,
  m.libelle_parametre_norm, m.categorie_parametre, m.libelle_unite_norm,
  CAST(count(DISTINCT code_prelevement) AS BIGINT) AS nb_prelevements_non_conformes,
  CAST(count(*) AS BIGINT) AS nb_mesures_associees,
  CAST(count(*) FILTER (limite_qualite_parametre IS NOT NULL
    OR reference_qualite_parametre IS NOT NULL) AS BIGINT)
    AS nb_mesures_avec_seuil_reglementaire,
  round(avg(resultat_parse), 4) AS valeur_moyenne, round(max(resultat_parse), 4) AS valeur_max,
  CAST(count(*) FILTER (_est_outlier) AS BIGINT) AS nb_outliers,
  CAST(count(*) FILTER (est_sous_seuil) AS BIGINT) AS nb_mesures_sous_seuil,
  round(100 * nb_outliers / nb_mesures_associees, 2) AS pct_outliers
FROM samples s JOIN measures m USING (code_prelevement)
LEFT JOIN places p ON s.code_commune = p.code_commune
  AND s.nom_commune_norm = p.nom_commune_norm
WHERE conformite_globale = 'N' GROUP BY ALL""",
    ),
}


def using(*names: str) -> str:
    """``WITH`` clause of the named views and all they are made of."""
    order: list[str] = []

    def add(name: str) -> None:
        for part in VIEWS[name][0]:
            add(part)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order) + "\n"


def over(view: str, **other: str) -> str:
    """SQL of a view with other tables in the place of those it reads."""
    sql = VIEWS[view][1]
    for old, new in other.items():
        sql = re.sub(rf"\b(FROM|JOIN) {old}\b", rf"\1 {new}", sql)
    return sql


# What a whole run stores: gold tables over the silver tables of the run, whose
# places are those that a network serves.
VIEWS.update(
    {
        "run_places": (
            ("places", "order_places"),
            """SELECT * FROM places WHERE code_commune IN (
  SELECT CAST(o_custkey AS VARCHAR) FROM lineitem JOIN order_places ON l_orderkey = o_orderkey)""",
        ),
        # Landed results have one load time, so copies are told apart by their columns.
        "run_deduped": (
            ("typed",),
            VIEWS["deduped"][1].replace("_ingestion_timestamp DESC NULLS LAST, ", ""),
        ),
        "run_clean": (("run_deduped",), over("clean", deduped="run_deduped")),
        "run_samples": (
            ("run_conformity",),
            """SELECT code_prelevement, annee_prelevement, code_departement,
  nom_departement_norm, code_commune, nom_commune_norm, conformite_globale FROM run_conformity""",
        ),
        "run_measures": (
            ("run_flagged",),
            """SELECT code_prelevement, annee_prelevement, mois_prelevement, code_departement,
  nom_departement_norm, code_commune, nom_commune_norm, code_parametre, libelle_parametre_norm,
  categorie_parametre, libelle_unite_norm, resultat_parse, _resultat_manquant, _est_outlier,
  est_sous_seuil, limite_qualite_parametre, reference_qualite_parametre FROM run_flagged""",
        ),
    }
)
VIEWS["run_flagged"] = (("run_clean",), over("flagged", clean="run_clean"))
VIEWS["run_conformity"] = (("run_clean",), over("conformity", clean="run_clean"))
VIEWS.update(
    {
        "run_statuses": (
            ("run_samples", "run_places"),
            over("statuses", samples="run_samples", places="run_places"),
        ),
        "run_stats": (
            ("run_measures", "run_places"),
            over("stats", measures="run_measures", places="run_places"),
        ),
        "run_regions": (
            ("run_samples", "run_places"),
            over("regions", samples="run_samples", places="run_places"),
        ),
        "run_scores": (("run_statuses",), over("scores", statuses="run_statuses")),
        "run_violations": (
            ("run_samples", "run_measures", "run_places"),
            over("violations", samples="run_samples", measures="run_measures", places="run_places"),
        ),
    }
)
VIEWS["run_ranked"] = (("run_scores",), over("ranked", scores="run_scores"))
