"""Registered queries, each with the SQL that gives the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import functions as fn
from assayline import operators as op
from assayline import schemas, sources
from assayline.functions import vocab
from assayline.plans import bronze, gold, jobs, quality, reports, serving, silver
from assayline.sources.staging import staged_path
from registry import landing, views
from registry.oracle import bbox, parsed, using, worst

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LABEL = "NITRATES (EN NO3)"


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(make: Query) -> Query:
        QUERIES[make.__name__] = make
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make

    return add


def ts_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# Columns ------------------------------------------------------------------


@query(
    using("results")
    + f"""SELECT resultat_alphanumerique AS raw, {parsed("resultat_alphanumerique")} AS value,
  starts_with(resultat_alphanumerique, '<') AS below,
  starts_with(resultat_alphanumerique, '>') AS above, CAST(count(*) AS BIGINT) AS n
FROM results GROUP BY ALL"""
)
def parse_qualified_number(spark, sf_dir):
    raw = F.col("raw")
    counted = (
        views.table(spark, sf_dir, "lineitem")
        .groupBy(views.result_text().alias("raw"))
        .agg(F.count("*").alias("n"))
    )
    return counted.select(
        "raw",
        fn.parse_qualified_number(raw).alias("value"),
        fn.threshold_flag(raw, "<").alias("below"),
        fn.threshold_flag(raw, ">").alias("above"),
        "n",
    )


@query(
    """SELECT o_orderkey, CASE trim(o_orderpriority) WHEN '1-URGENT' THEN 'urgent'
  WHEN '5-LOW' THEN 'low' ELSE trim(o_orderpriority) END AS unit FROM orders"""
)
def map_codes_unit(spark, sf_dir):
    mapping = {"1-URGENT": "urgent", "5-LOW": "low"}
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.map_codes(F.col("o_orderpriority"), mapping).alias("unit")
    )


@query(
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'C' ELSE l_returnflag END
  AS status, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY ALL"""
)
def map_codes_status(spark, sf_dir):
    padded = F.concat(F.lit(" "), F.lower("l_returnflag"))
    status = fn.map_codes(padded, {**vocab.STATUSES, "a": "C"}, fallback=F.upper)
    return (
        views.table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber", status.alias("status"))
        .agg(F.count("*").alias("n"))
    )


@query(
    """SELECT p_partkey, CASE WHEN contains(upper(p_name), 'BOLT') OR contains(upper(p_name), 'GEAR')
  THEN 'METAL' WHEN contains(upper(p_name), 'RED') OR contains(upper(p_name), 'RING')
  THEN 'ROUND' ELSE 'OTHER' END AS category FROM part"""
)
def keyword_category(spark, sf_dir):
    rules = (("METAL", ("BOLT", "GEAR")), ("ROUND", ("RED", "RING")))
    return views.table(spark, sf_dir, "part").select(
        "p_partkey", fn.keyword_category(F.col("p_name"), rules, "OTHER").alias("category")
    )


@query(
    using("typed")
    + """SELECT code_prelevement, code_parametre, resultat_numerique, resultat_parse,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(year(ts) AS INTEGER) AS annee_prelevement,
  CAST(month(ts) AS INTEGER) AS mois_prelevement,
  starts_with(resultat_alphanumerique, '<') AS est_sous_seuil,
  strftime(_ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS loaded
FROM typed"""
)
def type_results(spark, sf_dir):
    return silver.type_results(views.results(spark, sf_dir)).select(
        "code_prelevement", "code_parametre", "resultat_numerique", "resultat_parse",
        ts_text("date_prelevement_ts").alias("ts"), "annee_prelevement", "mois_prelevement",
        "est_sous_seuil", ts_text("_bronze_ingestion_ts").alias("loaded"),
    )


@query(
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, {worst("a", "b", "c")} AS status FROM (
  SELECT l_orderkey, l_linenumber, l_suppkey,
    CASE o_orderstatus WHEN 'O' THEN 'C' WHEN 'F' THEN 'N' END AS a,
    CASE l_returnflag WHEN 'A' THEN 'C' WHEN 'N' THEN 'C' END AS b,
    CASE l_linestatus WHEN 'O' THEN 'C' ELSE 'S' END AS c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
)
def worst_of_status(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = views.table(spark, sf_dir, "lineitem")
    order, flag, line = F.col("o_orderstatus"), F.col("l_returnflag"), F.col("l_linestatus")
    status = fn.worst_of_status(
        [
            F.when(order == "O", "C").when(order == "F", "N"),
            F.when(flag.isin("A", "N"), "C"),
            F.when(line == "O", "C").otherwise("S"),
        ]
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", status.alias("status")
    )


@query(
    using("place_rows")
    + f"""SELECT code, longitude, latitude, {bbox("longitude", "latitude")} AS inside
FROM place_rows"""
)
def bbox_flag(spark, sf_dir):
    inside = fn.in_bbox(F.col("longitude"), F.col("latitude"))
    return views.place_rows(spark, sf_dir).select(
        "code", "longitude", "latitude", inside.alias("inside")
    )


@query(
    """SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '||'
  || CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END || '||' || c_name AS station_id
FROM customer"""
)
def surrogate_key(spark, sf_dir):
    parts = [
        F.col("c_custkey"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")),
        F.col("c_name"),
    ]
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", fn.surrogate_key(parts).alias("station_id")
    )


@query(
    """SELECT l_linenumber, round(100 * count(*) FILTER (l_returnflag = 'A') / count(*), 2) AS share,
  round(sum(l_discount * l_quantity) / sum(l_quantity), 3) AS mean_discount,
  CAST(greatest(12, least(38, trunc(sqrt(count(*)) * 1.6))) AS INTEGER) AS size
FROM lineitem GROUP BY 1"""
)
def shares_and_sizes(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("l_returnflag") == "A").alias("a"),
        F.round(fn.weighted_mean(F.col("l_discount"), F.col("l_quantity")), 3).alias(
            "mean_discount"
        ),
    )
    return lines.select(
        "l_linenumber",
        fn.pct(F.col("a"), F.col("n")).alias("share"),
        "mean_discount",
        fn.marker_size(F.col("n")).alias("size"),
    )


# Rows per key, missing values, outliers ------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus) = 1"""
)
def latest_per_key(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    latest = op.latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return latest.withColumn("shipped", ts_text("l_shipdate")).drop("l_shipdate")


@query(
    """SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey
  ORDER BY c_custkey, c_name, c_acctbal, c_mktsegment) = 1"""
)
def first_per_key(spark, sf_dir):
    return op.first_per_key(views.table(spark, sf_dir, "customer"), ["c_nationkey"])


@query(
    using("place_rows")
    + """SELECT CASE WHEN population > 5000 THEN code END AS code, nom, "codeDepartement",
  "codeRegion", population, longitude, latitude
FROM place_rows WHERE population > 5000"""
)
def dedupe_geo(spark, sf_dir):
    rows = views.place_rows(spark, sf_dir)
    coded = rows.withColumn("code", F.when(F.col("population") > 5000, F.col("code")))
    return bronze.dedupe_geo(coded)


@query(
    """SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN lang END, 'INCONNUE') AS lang,
  quality IS NULL AS missing, quality, n_chars
FROM documents d LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL OR toxic = 0"""
)
def handle_missing(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    joined = docs.join(views.table(spark, sf_dir, "labels"), "doc_id", "left")
    kept = F.when(F.coalesce("toxic", F.lit(0)) == 0, F.lit(True))
    prepared = joined.withColumns(
        {"kept": kept, "lang": F.when(F.col("quality") == 1, F.col("lang"))}
    )
    return op.handle_missing(
        prepared, ["kept"], {"lang": "INCONNUE"}, ("missing", "quality")
    ).select("doc_id", "lang", "missing", "quality", "n_chars")


_EVENT_FLAGS = """e AS (SELECT event_id, event_type, value,
    coalesce(value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1), false) AS is_outlier
  FROM events LEFT JOIN (SELECT event_type AS t, quantile_disc(value, 0.25) AS q1,
    quantile_disc(value, 0.75) AS q3 FROM events GROUP BY 1) ON event_type = t)"""


def _event_flags(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    bounds = sources.staged(op.iqr_bounds(events, "value", "event_type"), "bounds")
    return op.flag_iqr_outliers(events, "value", "event_type", bounds=bounds)


@query(f"WITH {_EVENT_FLAGS} SELECT * FROM e")
def flag_iqr_outliers(spark, sf_dir):
    return _event_flags(spark, sf_dir)


# Silver ---------------------------------------------------------------------

_MEASURE_COLUMNS = (
    "code_prelevement, reference_analyse, code_commune, nom_commune_norm, "
    "nom_departement_norm, mois_prelevement, code_parametre, libelle_parametre_norm, "
    "code_type_parametre, categorie_parametre, code_lieu_analyse, resultat_parse, "
    "resultat_alphanumerique, est_sous_seuil, est_sur_seuil, libelle_unite_norm, "
    "limite_qualite_parametre, reference_qualite_parametre, nom_distributeur, nom_uge, "
    "nom_moa, _resultat_manquant, _est_outlier, annee_prelevement, code_departement"
)


def _flagged(clean):
    """Staged clean results with outlier flags and categories. The bounds are staged as in
    the silver job: with their size known to be small, no shuffle deals the results to
    a few parameters."""
    bounds = sources.staged(silver.result_bounds(clean), "bounds")
    return silver.categorise_stored(silver.flag_outliers(clean, bounds))


def _bronze_results(spark, sf_dir):
    return op.nested_to_json(views.results(spark, sf_dir), ["reseaux"])


@query(
    using("flagged")
    + f"""SELECT {_MEASURE_COLUMNS}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS sampled,
  strftime(_ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS loaded,
  '[{{"code":"' || reseau_code || '","nom":"' || reseau_nom || '"}}]' AS reseaux
FROM flagged"""
)
def silver_measures(spark, sf_dir):
    clean = sources.staged(silver.clean_results(_bronze_results(spark, sf_dir)), "clean")
    built = silver.build_measures(_flagged(clean))
    return built.select(
        *_MEASURE_COLUMNS.split(", "),
        ts_text("date_prelevement_ts").alias("sampled"),
        ts_text("_bronze_ingestion_ts").alias("loaded"),
        "reseaux",
    )


_CONFORMITY_COLUMNS = (
    "code_prelevement, code_commune, nom_commune_norm, nom_departement_norm, "
    "nom_distributeur, nom_uge, conformite_bact_limite_norm, conformite_pc_limite_norm, "
    "conformite_bact_ref_norm, conformite_pc_ref_norm, conclusion_conformite_prelevement, "
    "conformite_globale, annee_prelevement, code_departement"
)


@query(using("conformity") + f"SELECT {_CONFORMITY_COLUMNS} FROM conformity")
def silver_conformity(spark, sf_dir):
    clean = silver.clean_results(_bronze_results(spark, sf_dir))
    return silver.build_conformity(clean).select(*_CONFORMITY_COLUMNS.split(", "))


@query(
    using("order_places", "places")
    + """SELECT s.* EXCLUDE (debut), strftime(debut, '%Y-%m-%d') AS debut_alim,
  code_departement_geo, code_region_geo, population, longitude, latitude, _coords_valides
FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS code_commune, ' ' || c_name AS nom_commune,
    CASE WHEN l_linestatus = 'O' THEN o_orderstatus END AS nom_quartier,
    CAST(l_suppkey AS VARCHAR) AS code_reseau, s_name AS nom_reseau,
    CASE WHEN l_returnflag <> 'R' THEN CAST(year(l_shipdate) AS INTEGER) END AS annee,
    upper(c_name) AS nom_commune_norm,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS debut
  FROM lineitem LEFT JOIN order_places ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  QUALIFY row_number() OVER (PARTITION BY o_custkey, l_suppkey, nom_quartier
    ORDER BY debut NULLS FIRST, annee NULLS FIRST) = 1) s
LEFT JOIN places p ON s.code_commune = p.code_commune"""
)
def build_stations(spark, sf_dir):
    geo = silver.clean_geo(views.place_rows(spark, sf_dir))
    stations = silver.build_stations(views.networks(spark, sf_dir), geo)
    return stations.withColumn("debut_alim", F.date_format("debut_alim", "yyyy-MM-dd")).drop(
        "_silver_timestamp"
    )


@query(
    using("measures")
    + """, rows AS (
  SELECT code_prelevement, code_parametre, l_code AS code_reseau, l_name AS nom_reseau FROM (
    SELECT *, json_extract_string(reseaux, '$[0].code') AS l_code,
      json_extract_string(reseaux, '$[0].nom') AS l_name FROM measures
    UNION ALL
    SELECT *, json_extract_string(reseaux, '$[1].code'),
      json_extract_string(reseaux, '$[1].nom') FROM measures))
SELECT rows.*, s_name AS exploitant FROM rows
LEFT JOIN supplier ON code_reseau = 'S' || CAST(s_suppkey AS VARCHAR)"""
)
def explode_networks(spark, sf_dir):
    known = views.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), views.text("s_suppkey")).alias("code_reseau"),
        F.col("s_name").alias("exploitant"),
    )
    listed = views.measures(spark, sf_dir).select(
        "code_prelevement", "code_parametre", "reseaux"
    )
    return silver.explode_networks(listed, known).drop("reseaux")


# Gold -----------------------------------------------------------------------


def _dim(spark, sf_dir):
    return gold.entity_dim(views.places(spark, sf_dir))


def _statuses(spark, sf_dir):
    rows = gold.status_rollup(views.samples(spark, sf_dir), _dim(spark, sf_dir))
    return rows.drop("_gold_timestamp")


def _stats(spark, sf_dir):
    rows = gold.period_stats(
        views.measures(spark, sf_dir), _dim(spark, sf_dir)
    )
    return rows.drop("_gold_timestamp")


def _regions(spark, sf_dir):
    dim = _dim(spark, sf_dir)
    rows = gold.region_rollup(views.samples(spark, sf_dir), dim, gold.region_population(dim))
    return rows.drop("_gold_timestamp")


def _ranked(spark, sf_dir):
    scores = gold.score_rollup(_statuses(spark, sf_dir))
    return gold.best_worst(scores).drop("_gold_timestamp")


def _violations(spark, sf_dir):
    failed = gold.failed_samples(views.samples(spark, sf_dir))
    rows = gold.violation_profile(failed, views.measures(spark, sf_dir), _dim(spark, sf_dir))
    return rows.drop("_gold_timestamp")


@query(using("places") + "SELECT * FROM places")
def entity_dim(spark, sf_dir):
    return _dim(spark, sf_dir)


@query(
    using("places")
    + """SELECT code_region_geo, CAST(sum(coalesce(population, 0)) AS BIGINT)
  AS population_couverte FROM places WHERE code_region_geo IS NOT NULL GROUP BY 1"""
)
def region_population(spark, sf_dir):
    return gold.region_population(_dim(spark, sf_dir))


@query(using("statuses") + "SELECT * FROM statuses")
def status_rollup(spark, sf_dir):
    return _statuses(spark, sf_dir)


@query(using("stats") + "SELECT * FROM stats")
def period_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query(using("regions") + "SELECT * FROM regions")
def region_rollup(spark, sf_dir):
    return _regions(spark, sf_dir)


@query(using("regions") + "SELECT * FROM regions")
def region_of_statuses(spark, sf_dir):
    statuses = gold.status_rollup(views.samples(spark, sf_dir), _dim(spark, sf_dir))
    population = gold.region_population(_dim(spark, sf_dir))
    return gold.region_of_statuses(statuses, population).drop("_gold_timestamp")


@query(using("scores") + "SELECT * FROM scores")
def score_rollup(spark, sf_dir):
    return gold.score_rollup(_statuses(spark, sf_dir))


@query(using("ranked") + "SELECT * FROM ranked")
def best_worst_k(spark, sf_dir):
    return _ranked(spark, sf_dir)


@query(
    using("samples")
    + "SELECT * EXCLUDE (conformite_globale) FROM samples WHERE conformite_globale = 'N'"
)
def failed_samples(spark, sf_dir):
    return gold.failed_samples(views.samples(spark, sf_dir))


@query(
    using("samples", "measures")
    + """SELECT s.* EXCLUDE (conformite_globale), m.code_parametre, m.libelle_parametre_norm,
  m.categorie_parametre, m.libelle_unite_norm, m.resultat_parse, m._est_outlier,
  m.est_sous_seuil, m.limite_qualite_parametre, m.reference_qualite_parametre
FROM samples s JOIN measures m USING (code_prelevement) WHERE conformite_globale = 'N'"""
)
def violations_with_measures(spark, sf_dir):
    failed = gold.failed_samples(views.samples(spark, sf_dir))
    return gold.violations_with_measures(failed, views.measures(spark, sf_dir))


@query(using("violations") + "SELECT * FROM violations")
def violation_profile(spark, sf_dir):
    return _violations(spark, sf_dir)


# Served queries ---------------------------------------------------------------


@query(
    using("statuses")
    + """SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM statuses WHERE annee_prelevement = 1998
  AND code_departement = '07' AND taux_conformite_pct >= 10) AS row_count
FROM statuses WHERE annee_prelevement = 1998 AND code_departement = '07'
  AND taux_conformite_pct >= 10
ORDER BY annee_prelevement DESC NULLS LAST, taux_conformite_pct DESC NULLS LAST,
  nom_commune_norm NULLS LAST, code_commune LIMIT 20 OFFSET 5"""
)
def page_conformite_commune(spark, sf_dir):
    return serving.page(
        _statuses(spark, sf_dir), "conformite_commune", limit=20, offset=5,
        annee_prelevement=1998, code_departement=7, min_taux_conformite_pct=10.0,
    ).with_total()


@query(
    using("stats")
    + """SELECT * FROM stats WHERE mois_prelevement = 3 AND code_parametre = 'P4'
ORDER BY annee_prelevement DESC NULLS LAST, mois_prelevement DESC NULLS LAST,
  libelle_parametre_norm NULLS LAST, code_commune NULLS LAST, nom_commune_norm,
  code_parametre, categorie_parametre, libelle_unite_norm LIMIT 50"""
)
def page_evolution_parametres(spark, sf_dir):
    return serving.page(
        _stats(spark, sf_dir), "evolution_parametres", limit=50,
        mois_prelevement=3, code_parametre="P4",
    ).rows


@query(
    using("regions")
    + """SELECT * FROM regions WHERE taux_conformite_pct >= 30
ORDER BY annee_prelevement DESC NULLS LAST, taux_conformite_pct DESC NULLS LAST,
  code_region_geo NULLS LAST LIMIT 10 OFFSET 3"""
)
def page_qualite_region(spark, sf_dir):
    return serving.page(
        _regions(spark, sf_dir), "qualite_region", limit=10, offset=3,
        min_taux_conformite_pct=30.0,
    ).rows


@query(
    using("ranked")
    + """SELECT * FROM ranked WHERE classement_type = 'MOINS_CONFORME'
ORDER BY classement_type, rang LIMIT 7"""
)
def page_top10_communes(spark, sf_dir):
    return serving.page(
        _ranked(spark, sf_dir), "top10_communes", limit=7, classement_type="MOINS_CONFORME"
    ).rows


@query(
    using("violations")
    + """SELECT * FROM violations WHERE categorie_parametre = 'CHIMIE'
ORDER BY annee_prelevement DESC NULLS LAST, nb_prelevements_non_conformes DESC NULLS LAST,
  nom_commune_norm NULLS LAST, code_commune NULLS LAST, code_parametre NULLS LAST,
  libelle_parametre_norm NULLS LAST, categorie_parametre, libelle_unite_norm,
  code_departement NULLS LAST LIMIT 100"""
)
def page_non_conformites(spark, sf_dir):
    return serving.page(
        _violations(spark, sf_dir), "non_conformites", categorie_parametre="CHIMIE"
    ).rows


def _menus(spark, sf_dir):
    return serving.menu_values(
        _statuses(spark, sf_dir), _stats(spark, sf_dir), year=1997, dept=3
    )


@query(using("statuses") + "SELECT DISTINCT annee_prelevement FROM statuses")
def menu_years(spark, sf_dir):
    return _menus(spark, sf_dir)["years"]


@query(
    using("stats")
    + """SELECT DISTINCT libelle_parametre_norm FROM stats WHERE annee_prelevement = 1997
  AND code_departement = '03' AND libelle_parametre_norm IS NOT NULL"""
)
def menu_parameters(spark, sf_dir):
    return _menus(spark, sf_dir)["parameters"]


@query(
    using("statuses")
    + """SELECT DISTINCT code_commune, nom_commune_norm FROM statuses
WHERE annee_prelevement = 1997 AND code_departement = '03' AND code_commune IS NOT NULL
  AND nom_commune_norm IS NOT NULL"""
)
def menu_communes(spark, sf_dir):
    return _menus(spark, sf_dir)["communes"]


_TOP = f"""top AS (SELECT code_commune, nom_commune_norm, code_departement, code_region_geo,
  libelle_unite_norm, CAST(sum(coalesce(s.nb_mesures, 0)) AS BIGINT) AS nb_mesures,
  round(sum(coalesce(valeur_moyenne, 0) * coalesce(s.nb_mesures, 0))
    / nullif(sum(coalesce(s.nb_mesures, 0)), 0), 3) AS valeur_moyenne_ponderee,
  max(s.valeur_max) AS valeur_max, min(s.valeur_min) AS valeur_min
FROM stats s WHERE libelle_parametre_norm = '{LABEL}' AND annee_prelevement = 1996
GROUP BY 1, 2, 3, 4, 5 HAVING sum(coalesce(s.nb_mesures, 0)) > 0
ORDER BY valeur_moyenne_ponderee DESC NULLS LAST, nb_mesures DESC, nom_commune_norm
LIMIT 20)"""


@query(using("stats") + f", {_TOP} SELECT * FROM top")
def weighted_top(spark, sf_dir):
    return serving.weighted_top(_stats(spark, sf_dir), LABEL, year=1996)


@query(
    using("stats")
    + f""", {_TOP} SELECT * FROM top
ORDER BY valeur_moyenne_ponderee DESC, nb_mesures DESC, nom_commune_norm LIMIT 8"""
)
def top_bars(spark, sf_dir):
    ranked = serving.weighted_top(_stats(spark, sf_dir), LABEL, year=1996)
    return serving.top_bars(ranked, k=8)


_MOST = f"""most AS (SELECT code_commune, CAST(sum(s.nb_mesures) AS BIGINT) AS nb_mesures,
  max(s.nom_commune_norm) AS nom_commune_norm FROM stats s
WHERE libelle_parametre_norm = '{LABEL}' GROUP BY 1
ORDER BY nb_mesures DESC, nom_commune_norm, code_commune LIMIT 5)"""


@query(using("stats") + f", {_MOST} SELECT * FROM most")
def most_measured(spark, sf_dir):
    stats = _stats(spark, sf_dir)
    return serving.most_measured(stats.filter(F.col("libelle_parametre_norm") == LABEL))


_SERIES = f"""SELECT nom_commune_norm, code_commune,
  CAST(annee_prelevement AS VARCHAR) || '-' || lpad(CAST(mois_prelevement AS VARCHAR), 2, '0')
    AS periode, valeur_moyenne, nb_mesures, valeur_min, valeur_max, libelle_unite_norm
FROM stats WHERE libelle_parametre_norm = '{LABEL}'"""


@query(
    using("stats")
    + f", {_MOST} {_SERIES} AND code_commune IN (SELECT code_commune FROM most)"
)
def series_default(spark, sf_dir):
    return serving.series(_stats(spark, sf_dir), LABEL)


@query(using("stats") + f"{_SERIES} AND annee_prelevement = 1997 AND code_commune = 'N3'")
def series_chosen(spark, sf_dir):
    stats = _stats(spark, sf_dir)
    offered = stats.filter(F.col("annee_prelevement") == 1997)
    return serving.series(stats, LABEL, 1997, ["N3", "absent"], available=offered)


@query(using("stats") + f"SELECT DISTINCT libelle_unite_norm FROM stats WHERE libelle_parametre_norm = '{LABEL}'")
def series_unit(spark, sf_dir):
    return serving.series_unit(_stats(spark, sf_dir), LABEL)


@query(
    using("statuses", "stats")
    + f"""SELECT CAST(count(*) AS BIGINT) AS nb_communes,
  CAST(sum(s.nb_prelevements_total) AS BIGINT) AS nb_prelevements_total,
  round(sum(s.taux_conformite_pct * s.nb_prelevements_total) / sum(s.nb_prelevements_total), 2)
    AS taux_conformite_pct,
  (SELECT CAST(sum(nb_mesures) AS BIGINT) FROM stats
   WHERE annee_prelevement = 1999 AND libelle_parametre_norm = '{LABEL}') AS nb_mesures
FROM statuses s WHERE annee_prelevement = 1999"""
)
def kpi_summary(spark, sf_dir):
    return serving.kpi_summary(
        _statuses(spark, sf_dir), _stats(spark, sf_dir), LABEL, year=1999, communes=["absent"]
    )


@query(
    using("statuses")
    + """SELECT CAST(count(*) AS BIGINT) AS nb_communes,
  CAST(sum(s.nb_prelevements_total) AS BIGINT) AS nb_prelevements_total,
  round(sum(s.taux_conformite_pct * s.nb_prelevements_total) / sum(s.nb_prelevements_total), 2)
    AS taux_conformite_pct, CAST(0 AS BIGINT) AS nb_mesures
FROM statuses s WHERE code_commune IN ('1', '22', '101')"""
)
def kpi_summary_chosen(spark, sf_dir):
    return serving.kpi_summary(
        _statuses(spark, sf_dir), _stats(spark, sf_dir), LABEL, communes=["1", "22", "101", "none"]
    )


@query(
    using("statuses")
    + """, points AS (SELECT * FROM statuses
  WHERE annee_prelevement = 1998 AND longitude IS NOT NULL AND latitude IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY code_commune ORDER BY taux_conformite_pct
    DESC NULLS LAST, nom_commune_norm) = 1)
SELECT p.code_commune, p.nom_commune_norm, p.code_region_geo, p.code_departement, p.longitude,
  p.latitude, coalesce(p.population, 0) AS population,
  round(coalesce(s.taux_conformite_pct, 0), 3) AS metric_value,
  CAST(s.nb_prelevements_total AS DOUBLE) AS size_value,
  CAST(greatest(12, least(38, trunc(sqrt(s.nb_prelevements_total) * 1.6))) AS INTEGER)
    AS marker_size
FROM statuses s JOIN points p ON s.code_commune = p.code_commune
WHERE s.annee_prelevement = 1998"""
)
def map_points(spark, sf_dir):
    return serving.map_points(_statuses(spark, sf_dir), year=1998)


@query(
    using("statuses", "stats")
    + f"""SELECT max(annee_prelevement) AS annee_prelevement, (SELECT coalesce(
  max(libelle_parametre_norm) FILTER (libelle_parametre_norm = '{LABEL}'),
  min(libelle_parametre_norm)) FROM stats) AS libelle_parametre_norm FROM statuses"""
)
def default_values(spark, sf_dir):
    return serving.defaults(_statuses(spark, sf_dir), _stats(spark, sf_dir))


@query(
    using("samples")
    + """SELECT code_prelevement, code_commune FROM samples
WHERE code_commune IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 9000)"""
)
def filter_members(spark, sf_dir):
    rich = views.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 9000)
    chosen = rich.select(views.text("c_custkey").alias("code"))
    rows = views.samples(spark, sf_dir).select("code_prelevement", "code_commune")
    return op.filter_members(rows, "code_commune", chosen)


# Quality -----------------------------------------------------------------------


def _verdict(suite, rule, column, checked, unexpected, ok, source):
    return f"""SELECT '{suite}' AS suite, '{rule}' AS rule, '{column}' AS "column",
  CAST({checked} AS BIGINT) AS n_checked, CAST({unexpected} AS BIGINT) AS n_unexpected,
  {ok} AS success FROM {source}"""


def _without_observed(results: DataFrame) -> DataFrame:
    return results.drop("observed")


@query(
    " UNION ALL ".join(
        [
            _verdict("docs", "not_null", "quality", "count(*)", "count(*) - count(quality)",
                     "count(quality) >= 0.95 * count(*)", "documents LEFT JOIN labels USING (doc_id)"),
            _verdict("docs", "not_null", "lang", "count(*)", "count(*) - count(lang)",
                     "count(lang) = count(*)", "documents"),
            _verdict("docs", "in_set", "quality", "count(quality)",
                     "count(*) FILTER (quality <> 1)",
                     "count(*) FILTER (quality = 1) >= 0.95 * count(quality)", "labels"),
            _verdict("docs", "between", "n_chars", "count(n_chars)",
                     "count(*) FILTER (n_chars NOT BETWEEN 1 AND 5000)",
                     "count(*) FILTER (n_chars NOT BETWEEN 1 AND 5000) = 0", "documents"),
            _verdict("ids", "unique", "doc_id", "count(doc_id)",
                     "count(doc_id) - count(DISTINCT doc_id)", "count(doc_id) = count(DISTINCT doc_id)",
                     "documents"),
            """SELECT 'texts', 'unique', 'lang,source', CAST(sum(n) AS BIGINT),
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT), coalesce(max(n), 0) <= 1
FROM (SELECT count(*) AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL
  GROUP BY lang, source)""",
        ]
    )
)
def quality_rules(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = views.table(spark, sf_dir, "labels").select("doc_id", "quality")
    known = docs.join(labels, "doc_id", "left").withColumn("quality", views.text("quality"))
    suites = {
        "docs": [
            quality.not_null("quality", 0.95),
            quality.not_null("lang"),
            quality.in_set("quality", ["1"], 0.95),
            quality.between("n_chars", 1, 5000),
        ],
        "ids": [quality.unique(["doc_id"])],
        "texts": [quality.unique(["lang", "source"])],
    }
    return _without_observed(quality.check(known, suites))


_VIEW_SQL = {
    "pH": ("libelle_parametre_norm = 'PH'", 4, 10),
    "nitrates_mg_l": ("contains(libelle_parametre_norm, 'NITRATES (EN NO3)')", 0, 200),
    "nitrites_mg_l": ("contains(libelle_parametre_norm, 'NITRITES (EN NO2)')", 0, 10),
    "conductivite": ("contains(libelle_parametre_norm, 'CONDUCTIVIT')", 0, 5000),
    "turbidite_ntu": ("contains(libelle_parametre_norm, 'TURBIDIT')", 0, 100),
}


@query(
    using("measures")
    + " UNION ALL ".join(
        _verdict(
            f"silver_mesures_range_{name}_suite", "between", "resultat_parse",
            f"count(resultat_parse) FILTER ({where})",
            f"count(*) FILTER ({where} AND resultat_parse NOT BETWEEN {low} AND {high})",
            f"count(*) FILTER ({where} AND resultat_parse NOT BETWEEN {low} AND {high}) = 0",
            "measures",
        )
        for name, (where, low, high) in _VIEW_SQL.items()
    )
)
def quality_ranges(spark, sf_dir):
    results = quality.check(views.measures(spark, sf_dir), quality.range_rules())
    return _without_observed(results.filter(F.col("rule") == "between"))


@query(
    using("measures")
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "view", code_prelevement, code_parametre, resultat_parse
FROM measures WHERE {where} AND resultat_parse IS NOT NULL"""
        for name, (where, _, _) in _VIEW_SQL.items()
    )
)
def quality_views(spark, sf_dir):
    rows = views.measures(spark, sf_dir)
    # One scan: each row is listed under every view it belongs to.
    hits = F.array(*[F.when(hit, F.lit(name)) for name, hit in quality.views().items()])
    found = F.explode(F.filter(hits, lambda name: name.isNotNull()))
    return rows.filter(F.col("resultat_parse").isNotNull()).select(
        found.alias("view"), "code_prelevement", "code_parametre", "resultat_parse"
    )


@query(
    using("flagged", "conformity")
    + """, m AS (SELECT
    bool_and(code_prelevement IS NOT NULL) AND count(*) >= 1
      AND count(nom_commune_norm) >= 0.95 * count(*)
      AND count(code_departement) >= 0.95 * count(*) AS contract FROM flagged),
r AS (
"""
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS name, count(*) FILTER ({where} AND
    resultat_parse NOT BETWEEN {low} AND {high}) = 0 AS success FROM flagged"""
        for name, (where, low, high) in _VIEW_SQL.items()
    )
    + """)
SELECT 'silver_mesures_schema_suite' AS suite, CAST(73 AS BIGINT) AS n_rules, contract AS success
FROM m
UNION ALL SELECT 'silver_mesures_range_' || name || '_suite', 2, success FROM r
UNION ALL SELECT 'silver_conformite_schema_suite', 49,
  count(conformite_bact_ref_norm) FILTER (conformite_bact_ref_norm NOT IN ('C', 'N', 'S')) = 0
FROM conformity
UNION ALL SELECT 'silver_stations_schema_suite', 42,
  count(*) FILTER (l_returnflag <> 'R') >= 0.95 * count(*) FROM lineitem
UNION ALL SELECT 'silver_stations_uniqueness_suite', 3, true"""
)
def quality_suites(spark, sf_dir):
    """The nine suites over silver tables built from the raw views."""
    clean = sources.staged(silver.clean_results(_bronze_results(spark, sf_dir)), "clean")
    results = _flagged(clean)
    geo = silver.clean_geo(views.place_rows(spark, sf_dir))
    stations = silver.build_stations(views.networks(spark, sf_dir), geo)
    tables = {
        # Staged, as two suites read it and one of them twice.
        "stations": sources.staged(stations, "stations"),
        "mesures": _padded(silver.build_measures(results), "mesures"),
        "conformite": silver.build_conformity(clean),
    }
    checked = [quality.CHECKS[name](df) for name, df in tables.items()]
    return quality.suite_summary(checked[0].unionByName(checked[1]).unionByName(checked[2]))


def _padded(df: DataFrame, table: str) -> DataFrame:
    """Contract columns that the raw views leave out are empty."""
    absent = [f for f in schemas.SILVER[table] if f.name not in df.columns]
    filled = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return filled.select(*schemas.SILVER[table].names)


# Sources and sinks ---------------------------------------------------------------

_ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)
_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _order_rows(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(*_ORDER_SCHEMA.names)


@query(_ORDER_SQL)
def read_envelope(spark, sf_dir):
    foreign = views.table(spark, sf_dir, "region")
    path = landing.envelopes(_order_rows(spark, sf_dir), foreign=foreign)
    return sources.read_envelope(spark, path, _ORDER_SCHEMA, one_per_file=False)


@query(
    """SELECT CAST(count(*) AS BIGINT) AS n_records, CAST(count(*) AS BIGINT) AS declared_count,
  (SELECT CAST(count(*) AS BIGINT) FROM region) AS n_unreadable, false AS is_complete FROM orders"""
)
def page_completeness(spark, sf_dir):
    foreign = views.table(spark, sf_dir, "region")
    path = landing.envelopes(_order_rows(spark, sf_dir), foreign=foreign)
    found = sources.page_completeness(spark, path, _ORDER_SCHEMA, one_per_file=False)
    return found.select("n_records", "declared_count", "n_unreadable", "is_complete")


@query(_ORDER_SQL)
def read_json_array(spark, sf_dir):
    path = landing.arrays(_order_rows(spark, sf_dir))
    return sources.read_json_array(spark, path, _ORDER_SCHEMA, one_per_file=False)


@query(_ORDER_SQL)
def read_json_records(spark, sf_dir):
    path = landing.records(_order_rows(spark, sf_dir))
    return sources.read_json_records(spark, path, _ORDER_SCHEMA)


@query(
    using("place_rows")
    + """SELECT * EXCLUDE (longitude, latitude), CASE WHEN longitude IS NOT NULL THEN longitude END
  AS longitude, CASE WHEN longitude IS NOT NULL THEN latitude END AS latitude FROM place_rows"""
)
def read_geojson(spark, sf_dir):
    rows = views.place_rows(spark, sf_dir)
    properties = T.StructType(
        [f for f in rows.schema if f.name not in ("longitude", "latitude")]
    )
    return sources.read_geojson(spark, landing.collections(rows), properties, one_per_file=False)


@query(
    using("results")
    + """SELECT code_prelevement, code_parametre,
  '[{"code":"' || reseau_code || '","nom":"' || reseau_nom || '"}]' AS reseaux FROM results"""
)
def nested_to_json(spark, sf_dir):
    rows = op.nested_to_json(views.results(spark, sf_dir), ["reseaux", "nom_moa", "absent"])
    return rows.select("code_prelevement", "code_parametre", "reseaux")


@query(
    using("results")
    + """SELECT code_prelevement, code_parametre, 'landed' AS _source_api,
  CAST(year(ts) AS INTEGER) AS _partition_annee FROM (SELECT *,
    TRY_CAST(try_strptime(date_prelevement, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts FROM results)"""
)
def land_results(spark, sf_dir):
    rows = bronze.land_results(views.results(spark, sf_dir), "landed", "2025-01-01 00:00:00")
    return rows.select("code_prelevement", "code_parametre", "_source_api", "_partition_annee")


@query(
    """SELECT o_orderkey, trim(c) AS code FROM (SELECT o_orderkey,
  unnest(string_split(CASE o_orderstatus WHEN 'O' THEN lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
    WHEN 'F' THEN ' 64, ,' || CAST(n_nationkey AS VARCHAR) END, ',')) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
WHERE trim(c) <> ''"""
)
def expand_codes(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").join(
        views.customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    )
    status = F.col("o_orderstatus")
    listed = F.concat(F.lit(" 64, ,"), views.text("n_nationkey"))
    scope = F.when(status == "O", views.two_digits("n_nationkey")).when(status == "F", listed)
    scoped = orders.select("o_orderkey", scope.alias("scope"))
    return op.expand_codes(scoped, "scope").drop("scope")


@query("SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code FROM customer")
def department_codes(spark, sf_dir):
    return sources.department_codes(views.table(spark, sf_dir, "customer"), "c_nationkey")


@query(
    using("samples") + "SELECT * FROM samples"
)
def partitioned_roundtrip(spark, sf_dir):
    rows = views.samples(spark, sf_dir)
    layout = sources.Layout(root=staged_path(spark, "roundtrip"))
    parts = ("annee_prelevement", "code_departement")
    sources.write_table(rows, layout, "silver", "samples", partition_by=parts)
    return sources.read_table(spark, layout, "silver", "samples", rows.schema)


@query(
    using("samples")
    + """SELECT annee_prelevement, code_departement, CAST(count(*) AS BIGINT) AS n
FROM samples WHERE annee_prelevement = 1998 GROUP BY 1, 2"""
)
def sql_views(spark, sf_dir):
    """A stored table served as a view and asked in SQL with a bound value."""
    rows = views.samples(spark, sf_dir)
    layout = sources.Layout(root=staged_path(spark, "views"))
    parts = ("annee_prelevement", "code_departement")
    sources.write_table(rows, layout, "gold", "samples", partition_by=parts)
    sources.register_views(spark, layout, "gold", {"samples": rows.schema}, "served_")
    return spark.sql(
        "SELECT annee_prelevement, code_departement, count(*) AS n FROM served_samples "
        "WHERE annee_prelevement = :year GROUP BY ALL",
        args={"year": 1998},
    )


# Reports ----------------------------------------------------------------------------


@query(
    """SELECT 'quality' AS "column", CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) - count(quality) AS BIGINT) AS n_null,
  round(100 * (count(*) - count(quality)) / count(*), 1) AS pct_null,
  100 * (count(*) - count(quality)) / count(*) > 5 AS warn
FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL
SELECT 'lang', count(*), count(*) - count(lang), round(100 * (count(*) - count(lang)) / count(*), 1),
  100 * (count(*) - count(lang)) / count(*) > 5 FROM documents"""
)
def null_profile(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = docs.join(views.table(spark, sf_dir, "labels"), "doc_id", "left")
    return op.null_profile(joined, ["quality", "lang", "absent"])


@query(
    """SELECT lang, source, CAST(count(*) AS BIGINT) AS "count" FROM documents GROUP BY 1, 2"""
)
def group_counts(spark, sf_dir):
    return op.group_counts(views.table(spark, sf_dir, "documents"), ["lang", "source"])


_COUNTED = ("orders", "lineitem", "events", "documents", "pages", "conversations")


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
        for t in _COUNTED
    )
)
def table_counts(spark, sf_dir):
    return reports.table_counts({t: views.table(spark, sf_dir, t) for t in _COUNTED})


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
        f"CAST(NULL AS VARCHAR) AS error FROM {t}"
        for t in _COUNTED
    )
    + " UNION ALL SELECT 'missing', NULL, 'PATH_NOT_FOUND' UNION ALL SELECT 'TOTAL', "
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in _COUNTED)
    + ", NULL"
)
def layer_report(spark, sf_dir):
    opened = {t: lambda t=t: views.table(spark, sf_dir, t) for t in (*_COUNTED, "missing")}
    return reports.layer_report(spark, opened)


@query(
    f"""WITH {_EVENT_FLAGS} SELECT event_type, CAST(count(*) AS BIGINT) AS "count"
FROM e WHERE is_outlier GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
)
def top_outlier_labels(spark, sf_dir):
    return op.top_labels(_event_flags(spark, sf_dir), "event_type", "is_outlier")


@query(
    f"""WITH {_EVENT_FLAGS} SELECT CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (is_outlier) AS BIGINT) AS n_outliers,
  round(100 * count(*) FILTER (is_outlier) / count(*), 2) AS pct_outliers FROM e"""
)
def outlier_metrics(spark, sf_dir):
    return reports.outlier_metrics(_event_flags(spark, sf_dir), "is_outlier")


@query(
    using("typed")
    + """SELECT CAST(sum(n) AS BIGINT) AS n_typed, CAST(sum(d) AS BIGINT) AS n_null_date,
  CAST(sum(r) AS BIGINT) AS n_null_result, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n, count(*) FILTER (ts IS NULL) AS d,
    count(*) FILTER (resultat_parse IS NULL) AS r
  FROM typed GROUP BY code_prelevement, code_parametre, date_prelevement)"""
)
def step_metrics(spark, sf_dir):
    return reports.typed_metrics(silver.type_results(views.results(spark, sf_dir)))


@query(
    using("deduped")
    + """SELECT CAST(count(*) AS BIGINT) AS n_before,
  CAST(count(*) FILTER (ts IS NOT NULL AND code_commune IS NOT NULL) AS BIGINT) AS n_after,
  CAST(count(*) FILTER (ts IS NULL OR code_commune IS NULL) AS BIGINT) AS n_dropped
FROM deduped"""
)
def missing_metrics(spark, sf_dir):
    typed = silver.type_results(_bronze_results(spark, sf_dir))
    return reports.missing_metrics(silver.dedupe_results(typed))


@query(using("measures") + "SELECT DISTINCT libelle_unite_norm FROM measures")
def distinct_units(spark, sf_dir):
    return op.distinct_values(views.measures(spark, sf_dir), ["libelle_unite_norm"])


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
ORDER BY o_orderkey LIMIT 10"""
)
def preview(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").orderBy("o_orderkey")
    return reports.preview(rows, _ORDER_SCHEMA.names)


# Whole run ----------------------------------------------------------------------------


@query(
    using("conformity", "places")
    + """SELECT annee_prelevement, code_departement, nom_departement_norm, code_region_geo,
  code_commune, nom_commune_norm, population,
  CAST(count(DISTINCT code_prelevement) AS BIGINT) AS nb_prelevements_total,
  CAST(count(*) FILTER (conformite_globale = 'C') AS BIGINT) AS nb_prelevements_conformes,
  CAST(count(*) FILTER (conformite_globale = 'N') AS BIGINT) AS nb_prelevements_non_conformes,
  CAST(count(*) FILTER (conformite_globale = 'S') AS BIGINT) AS nb_prelevements_sans_objet,
  round(100 * nb_prelevements_conformes / nb_prelevements_total, 2) AS taux_conformite_pct
FROM conformity LEFT JOIN (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS code_commune,
    upper(c_name) AS nom_commune_norm
  FROM lineitem JOIN order_places ON l_orderkey = o_orderkey) k
  USING (code_commune, nom_commune_norm)
LEFT JOIN places USING (code_commune, nom_commune_norm)
GROUP BY ALL"""
)
def medallion_run(spark, sf_dir):
    """Documents landed, then bronze, silver, quality and gold as jobs."""
    layout = landing.run_layers(
        spark,
        "medallion",
        views.place_rows(spark, sf_dir),
        views.networks(spark, sf_dir),
        views.results(spark, sf_dir).drop("_ingestion_timestamp"),
        "2025-01-01 00:00:00",
    )
    table = sources.read_table(
        spark, layout, "gold", "conformite_commune", schemas.GOLD["conformite_commune"]
    )
    return table.drop(
        "_gold_timestamp", "longitude", "latitude", "_coords_valides", "taux_non_conformite_pct"
    )
