"""Contract-shaped views of the star-schema tables.

``results`` and ``networks`` have the shape of raw records, ``places`` that of
the place dimension, ``samples`` and ``measures`` that of silver tables. Edge
cases (bad dates, missing results, renamed places) follow from column values.
Every view has the same columns and rows as the SQL of the same name in
``registry.oracle``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.functions import in_bbox, label_norm
from assayline.plans import silver

# Label and unit of line numbers 1 to 7.
LABELS = (
    "Nitrates (en NO3)", " pH", "Turbidité néphélométrique NFU", "Nitrites (en NO2) ",
    "Conductivité à 25°C", "Escherichia coli", "Tritium (activité)",
)
UNITS = ("mg/l", None, "NFU", " MG/L", "us/cm", "n/(100mL)", "Bq/L")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def by_line(values: tuple[str | None, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("l_linenumber") - 1)


def two_digits(column: str) -> Column:
    return F.format_string("%02d", F.col(column))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )


def place_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and nations as places, before they are cleaned."""
    segment = F.col("c_mktsegment")
    cities = customers(spark, sf_dir).select(
        text("c_custkey").alias("code"),
        F.col("c_name").alias("nom"),
        two_digits("c_nationkey").alias("codeDepartement"),
        text("n_regionkey").alias("codeRegion"),
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal")).alias("population"),
        F.when(segment != "MACHINERY", F.col("c_acctbal") / 600 - 6).alias("longitude"),
        F.when(segment != "MACHINERY", F.col("c_acctbal") / 900 + 40).alias("latitude"),
    )
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), text("n_nationkey")).alias("code"),
        F.col("n_name").alias("nom"),
        two_digits("n_nationkey").alias("codeDepartement"),
        text("n_regionkey").alias("codeRegion"),
        (F.col("n_nationkey") * 1000).cast("long").alias("population"),
        (F.col("n_nationkey") / 2.0 - 6).alias("longitude"),
        (F.col("n_nationkey") / 2.0 + 40).alias("latitude"),
    )
    return cities.unionByName(nations)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_rows(spark, sf_dir).select(
        F.col("code").alias("code_commune"),
        F.upper("nom").alias("nom_commune_norm"),
        F.col("codeDepartement").alias("code_departement_geo"),
        F.col("codeRegion").alias("code_region_geo"),
        "population",
        "longitude",
        "latitude",
        in_bbox(F.col("longitude"), F.col("latitude")).alias("_coords_valides"),
    )


def _status(column: str) -> Column:
    value = F.col(column)
    return F.when(value == "O", "C").when(value == "F", "N").otherwise("S")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").join(
        customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left"
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order. Low-priority orders name their place differently."""
    name = F.upper("c_name")
    low = F.col("o_orderpriority") == "5-LOW"
    return _orders(spark, sf_dir).select(
        text("o_orderkey").alias("code_prelevement"),
        F.year("o_orderdate").alias("annee_prelevement"),
        two_digits("c_nationkey").alias("code_departement"),
        F.upper("n_name").alias("nom_departement_norm"),
        text("o_custkey").alias("code_commune"),
        F.when(low, F.concat(name, F.lit(" ECARTS"))).otherwise(name).alias("nom_commune_norm"),
        _status("o_orderstatus").alias("conformite_globale"),
        F.col("o_orderpriority").alias("conclusion_conformite_prelevement"),
    )


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, placed at the customer's nation."""
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", "o_orderdate", "n_nationkey", "n_name"
    )
    lines = table(spark, sf_dir, "lineitem")
    value = F.when(F.col("l_tax") > 0, F.col("l_quantity"))
    named = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        text("l_orderkey").alias("code_prelevement"),
        F.year("o_orderdate").alias("annee_prelevement"),
        F.month("o_orderdate").alias("mois_prelevement"),
        two_digits("n_nationkey").alias("code_departement"),
        F.upper("n_name").alias("nom_departement_norm"),
        F.concat(F.lit("N"), text("n_nationkey")).alias("code_commune"),
        F.upper("n_name").alias("nom_commune_norm"),
        F.concat(F.lit("P"), text("l_linenumber")).alias("code_parametre"),
        label_norm(by_line(LABELS)).alias("libelle_parametre_norm"),
        F.coalesce(F.trim(by_line(UNITS)), F.lit("INCONNUE")).alias("libelle_unite_norm"),
        value.alias("resultat_parse"),
        value.isNull().alias("_resultat_manquant"),
        (F.col("l_extendedprice") > 85000).alias("_est_outlier"),
        (F.col("l_returnflag") == "A").alias("est_sous_seuil"),
        F.when(F.col("l_returnflag") != "N", F.lit("<=50 mg/L")).alias("limite_qualite_parametre"),
        F.when(F.col("l_linestatus") == "O", F.lit(">=1")).alias("reference_qualite_parametre"),
        F.concat(
            F.lit('[{"code":"S'), text("l_suppkey"), F.lit('","nom":"A"},{"code":"R'),
            text("l_linenumber"), F.lit('","nom":"B"}]'),
        ).alias("reseaux"),
    )
    return silver.categorise(named)


def result_text() -> Column:
    """Texts of every kind the parser knows, by tax, flag and line status."""
    tax, flag = F.col("l_tax"), F.col("l_returnflag")
    comma = F.when(F.col("l_linestatus") == "O", F.lit(",")).otherwise(F.lit("."))
    sign = F.when(flag == "A", F.lit("<")).when(flag == "R", F.lit(" >")).otherwise(F.lit(""))
    number = F.concat(sign, text("l_linenumber"), comma, F.col("l_quantity").cast("int").cast("string"))
    return (
        F.when(tax == 0, F.lit(" nd "))
        .when(tax == 0.01, F.lit("1e-3"))
        .when(tax == 0.02, F.lit("< 0,5"))
        .when(tax == 0.03, F.lit("≤3"))
        .when(tax == 0.04, F.lit("-1,25"))
        .when(tax > 0.05, number)
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw results: key, padded labels, texts, statuses. Copies of
    a line come with the same key; part of the dates and places is unusable."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, sf_dir, "lineitem")
    status = F.col("o_orderstatus")
    good_date = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    late = (F.col("l_linenumber") == 7) & (status == "P")
    lost = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("l_linenumber") == 6)
    return (
        lines.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            two_digits("c_nationkey").alias("code_departement"),
            F.concat(F.lit(" "), F.lower("n_name")).alias("nom_departement"),
            F.when(~lost, text("o_custkey")).alias("code_commune"),
            F.concat(F.col("c_name"), F.lit("  ")).alias("nom_commune"),
            text("l_orderkey").alias("code_prelevement"),
            F.when(late, F.lit("2025-13-01T00:00:00Z")).otherwise(good_date).alias("date_prelevement"),
            text("l_partkey").alias("reference_analyse"),
            F.concat(F.lit("P"), text("l_linenumber")).alias("code_parametre"),
            by_line(LABELS).alias("libelle_parametre"),
            F.col("l_returnflag").alias("code_type_parametre"),
            F.col("l_linestatus").alias("code_lieu_analyse"),
            result_text().alias("resultat_alphanumerique"),
            F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).alias("resultat_numerique"),
            by_line(UNITS).alias("libelle_unite"),
            F.when(F.col("l_returnflag") != "N", F.lit("<=50 mg/L")).alias("limite_qualite_parametre"),
            F.when(F.col("l_linestatus") == "O", F.lit(">=1")).alias("reference_qualite_parametre"),
            F.col("o_orderpriority").alias("conclusion_conformite_prelevement"),
            F.lower(_status("o_orderstatus")).alias("conformite_limites_bact_prelevement"),
            F.lit("C ").alias("conformite_limites_pc_prelevement"),
            F.when(status != "P", F.lit("C")).alias("conformite_references_bact_prelevement"),
            F.lit("C").alias("conformite_references_pc_prelevement"),
            F.lit("UGE").alias("nom_uge"),
            F.when(F.col("l_suppkey") > 9, F.col("s_name")).alias("nom_distributeur"),
            F.lit("MOA").alias("nom_moa"),
            F.array(
                F.struct(text("l_suppkey").alias("code"), F.col("s_name").alias("nom"))
            ).alias("reseaux"),
            F.col("l_shipdate").cast("timestamp").alias("_ingestion_timestamp"),
        )
    )


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network record per line item: place, supplier, district."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    late = F.col("l_returnflag") == "R"
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return (
        table(spark, sf_dir, "lineitem")
        .join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            text("o_custkey").alias("code_commune"),
            F.concat(F.lit(" "), F.col("c_name")).alias("nom_commune"),
            F.when(F.col("l_linestatus") == "O", F.col("o_orderstatus")).alias("nom_quartier"),
            text("l_suppkey").alias("code_reseau"),
            F.col("s_name").alias("nom_reseau"),
            F.when(late, F.lit("16/10/2010")).otherwise(day).alias("debut_alim"),
            F.when(late, F.lit("n/a")).otherwise(text_year()).alias("annee"),
        )
    )


def text_year() -> Column:
    return F.year("l_shipdate").cast("string")
