"""Registered queries for landings with faults, external tables and exact results."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import operators as op
from assayline import sources
from assayline.plans import bronze, quality, serving
from assayline.sources.staging import staged_path
from registry import landing, views
from registry.catalog import (
    _ORDER_SCHEMA,
    _dim,
    _order_rows,
    _statuses,
    _stats,
    query,
    ts_text,
)
from registry.oracle import using

# Arrival order -------------------------------------------------------------------

_ARRIVALS = """WITH seen AS (SELECT CAST(l_suppkey AS VARCHAR) AS code, l_orderkey AS page,
  l_linenumber AS position, CAST(l_partkey AS VARCHAR) AS nom, l_quantity AS longitude
FROM lineitem)
"""


@query(
    _ARRIVALS
    + """SELECT code, nom, longitude FROM seen
QUALIFY row_number() OVER (PARTITION BY code ORDER BY page DESC, position DESC, nom,
  longitude) = 1"""
)
def dedupe_geo_arrivals(spark, sf_dir):
    """Many arrivals of each code, in files numbered 1, 2, ... 10, ..."""
    rows = views.table(spark, sf_dir, "lineitem").select(
        views.text("l_suppkey").alias("code"),
        views.text("l_partkey").alias("nom"),
        F.col("l_quantity").alias("longitude"),
        F.concat(F.lit("s3a://landing/2024/page_"), views.text("l_orderkey"), F.lit(".json")).alias(
            "_source_file"
        ),
        F.lit(None).cast("long").alias("_page"),
        F.col("l_linenumber").cast("int").alias("_position"),
        F.lit(False).alias("_in_lines"),
    )
    return bronze.dedupe_geo(rows)


@query(
    """WITH seen AS (SELECT CAST(l_suppkey AS VARCHAR) AS code, l_orderkey AS page, CAST(l_partkey AS
    VARCHAR) AS nom, l_linenumber AS position FROM lineitem)
SELECT code, nom FROM seen
QUALIFY row_number() OVER (PARTITION BY code ORDER BY page DESC, position DESC, nom) = 1"""
)
def dedupe_geo_lines(spark, sf_dir):
    """The same from documents landed one per line, with page ordinals, in files
    that follow each other as the pages do. Of features at one line number the
    one that counts stands last."""
    rows = views.table(spark, sf_dir, "lineitem")

    def by_arrival(a, b):
        return (
            F.when(a["l_linenumber"] < b["l_linenumber"], -1)
            .when(a["l_linenumber"] > b["l_linenumber"], 1)
            .when(a["nom"] > b["nom"], -1)
            .when(a["nom"] < b["nom"], 1)
            .otherwise(0)
        )

    features = F.transform(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "l_linenumber",
                    views.text("l_suppkey").alias("code"),
                    views.text("l_partkey").alias("nom"),
                )
            ),
            by_arrival,
        ),
        lambda x: F.struct(F.struct(x["code"].alias("code"), x["nom"].alias("nom")).alias("properties")),
    )
    docs = rows.groupBy(F.col("l_orderkey").alias("page")).agg(features.alias("features"))
    docs = docs.repartitionByRange("page").sortWithinPartitions("page")
    path = landing.saved_documents(docs, "places", doc_records=4)
    properties = T.StructType(
        [T.StructField("code", T.StringType()), T.StructField("nom", T.StringType())]
    )
    found = sources.read_geojson(spark, path, properties, one_per_file=False, with_position=True)
    return bronze.dedupe_geo(found).select("code", "nom")


# Lost pages ------------------------------------------------------------------------

_PAGES = f"""WITH o AS (SELECT o_orderkey FROM orders),
n AS (SELECT count(*) AS n, least(count(*), {landing.PAGE_SIZE}) AS lost FROM o)
"""


@query(
    _PAGES
    + """SELECT n - lost AS n_records, n AS declared_count, CAST(1 AS BIGINT) AS n_unreadable,
  false AS is_complete FROM n"""
)
def page_completeness_faulty(spark, sf_dir):
    """One page torn and one landed twice: the copy makes up for nothing."""
    path = landing.faulty_envelopes(_order_rows(spark, sf_dir))
    found = sources.page_completeness(spark, path, _ORDER_SCHEMA, one_per_file=False)
    return found.select("n_records", "declared_count", "n_unreadable", "is_complete")


@query(
    """SELECT CAST(count(*) AS BIGINT) AS n_records, CAST(count(*) AS BIGINT) AS declared_count,
  CAST(0 AS BIGINT) AS n_unreadable, true AS is_complete FROM orders"""
)
def page_completeness_whole(spark, sf_dir):
    # A size that leaves a last page with fewer records.
    path = landing.envelopes(_order_rows(spark, sf_dir), page_size=199)
    found = sources.page_completeness(spark, path, _ORDER_SCHEMA, one_per_file=False)
    return found.select("n_records", "declared_count", "n_unreadable", "is_complete")


@query(
    """SELECT 'no data' AS reason, CAST(count(*) AS BIGINT) AS n FROM region
UNION ALL SELECT 'unreadable', CAST(count(*) AS BIGINT) FROM nation"""
)
def page_rejects(spark, sf_dir):
    """Documents of another shape, and documents that were cut off."""
    foreign = views.table(spark, sf_dir, "region")
    whole = landing.envelopes(_order_rows(spark, sf_dir), foreign=foreign)
    torn = views.table(spark, sf_dir, "nation").select(
        F.concat(F.lit('{"count": 1, "data": [{"o_orderkey": '), views.text("n_nationkey")).alias("value")
    )
    torn.write.mode("append").text(whole)
    found = sources.page_rejects(spark, whole, _ORDER_SCHEMA, one_per_file=False)
    return found.groupBy("reason").agg(F.count("*").alias("n"))


_TORN = """CAST(count(*) AS BIGINT) FROM nation"""


def _with_torn(spark, sf_dir, path, start):
    """Append a document that breaks off for each nation."""
    torn = views.table(spark, sf_dir, "nation").select(
        F.concat(F.lit(start), views.text("n_nationkey")).alias("value")
    )
    torn.write.mode("append").text(path)
    return path


@query(
    f"""SELECT 'records' AS shape, 'unreadable' AS reason, {_TORN.replace("FROM", "AS n FROM")}
UNION ALL SELECT 'array', 'unreadable', {_TORN}
UNION ALL SELECT 'envelope', 'unreadable', {_TORN}
UNION ALL SELECT 'geojson', 'unreadable', {_TORN}
UNION ALL SELECT 'geojson', 'no features', CAST(count(*) AS BIGINT) FROM region"""
)
def rejects_by_shape(spark, sf_dir):
    """Documents of every shape, some of them cut off, some of another shape."""
    rows, places = _order_rows(spark, sf_dir), views.place_rows(spark, sf_dir)
    fields = [f for f in places.schema if f.name not in ("longitude", "latitude")]
    collections = landing.collections(places)
    foreign = views.table(spark, sf_dir, "region")
    foreign.select(F.to_json(F.struct(*foreign.columns)).alias("value")).write.mode(
        "append"
    ).text(collections)
    landed = {
        "records": (landing.records(rows), _ORDER_SCHEMA, '{"o_orderkey": '),
        "array": (landing.arrays(rows), _ORDER_SCHEMA, '[{"o_orderkey": 1}, {"o_orderkey": '),
        "envelope": (landing.envelopes(rows), _ORDER_SCHEMA, '{"data": [{"o_orderkey": '),
        "geojson": (collections, T.StructType(fields), '{"features": [{"properties": '),
    }
    found = [
        sources.rejects(spark, _with_torn(spark, sf_dir, path, start), schema, shape, False).select(
            F.lit(shape).alias("shape"), "reason"
        )
        for shape, (path, schema, start) in landed.items()
    ]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every.groupBy("shape", "reason").agg(F.count("*").alias("n"))


@query(_ORDERS := "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def read_json_records_torn(spark, sf_dir):
    """Lines that break off give no row."""
    path = _with_torn(spark, sf_dir, landing.records(_order_rows(spark, sf_dir)), '{"o_orderkey": ')
    return sources.read_json_records(spark, path, _ORDER_SCHEMA)


@query(_ORDERS)
def read_json_array_torn(spark, sf_dir):
    path = _with_torn(spark, sf_dir, landing.arrays(_order_rows(spark, sf_dir)), '[{"o_orderkey": ')
    return sources.read_json_array(spark, path, _ORDER_SCHEMA, one_per_file=False)


# Fields that were not agreed on -----------------------------------------------------------

@query(
    """WITH n AS (SELECT CAST(count(*) AS BIGINT) AS n,
  CAST(count(*) FILTER (WHERE o_orderkey % 5 = 0) AS BIGINT) AS odd,
  CAST(count(*) FILTER (WHERE o_orderkey % 7 = 0) AS BIGINT) AS nulls FROM orders)
SELECT 'o_orderkey' AS field, 'bigint' AS declared, 'whole' AS found, n AS n_values,
  CAST(0 AS BIGINT) AS n_nulls, CAST(0 AS BIGINT) AS n_odd, 'as declared' AS status FROM n
UNION ALL SELECT 'o_custkey', 'bigint', 'text,whole', n, 0, odd, 'retyped' FROM n
UNION ALL SELECT 'o_orderstatus', 'string', '', 0, 0, 0, 'missing' FROM n
UNION ALL SELECT 'o_totalprice', 'double', 'null,number', n, nulls, 0, 'as declared' FROM n
UNION ALL SELECT 'o_orderpriority', NULL, 'text', n, 0, 0, 'unknown' FROM n"""
)
def schema_drift(spark, sf_dir):
    """Orders landed with one field more, one less, and one of two types."""
    key = F.col("o_custkey")
    rows = views.table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    )

    def line(custkey):
        fields = F.struct("o_orderkey", custkey.alias("o_custkey"), "o_totalprice", "o_orderpriority")
        return F.to_json(fields, {"ignoreNullFields": "false"})

    odd = F.col("o_orderkey") % 5 == 0
    path = staged_path(spark, "drift")
    rows.select(
        F.when(odd, line(key.cast("string"))).otherwise(line(key)).alias("value")
    ).write.text(path)
    found = sources.schema_drift(spark, path, _ORDER_SCHEMA, one_per_file=False)
    return found.select("field", "declared", "found", "n_values", "n_nulls", "n_odd", "status")


# Chains of pages ----------------------------------------------------------------------------

LAST = 9
_CHAIN = f"""WITH pages AS (
  SELECT DISTINCT c_nationkey AS q, 1 + c_custkey % {LAST} AS page FROM customer
  WHERE (c_nationkey + c_custkey % {LAST}) % 5 <> 0
), chained AS (
  SELECT q, page, CASE WHEN page < {LAST} OR q % 2 = 1 THEN page + 1 END AS next FROM pages
), numbered AS (SELECT q, page FROM chained WHERE next IS NOT NULL),
before AS (
  SELECT q, page, lag(page, 1, 0) OVER (PARTITION BY q ORDER BY page) AS before FROM numbered
), gaps AS (
  SELECT q, before + 1 AS first_lost, page - 1 AS last_lost FROM before WHERE page > before + 1
)
"""


def _landed_chain(spark, sf_dir):
    """One folder a nation with pages of customers; some pages are lost."""
    rows = views.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("q"),
        (F.col("c_custkey") % LAST + 1).alias("page"),
        F.struct("c_custkey", "c_name").alias("r"),
    )
    more = (F.col("page") < LAST) | (F.col("q") % 2 == 1)
    url = F.concat(F.lit("https://example.org/v1?size=20&page="), (F.col("page") + 1).cast("string"))
    pages = rows.filter((F.col("q") + F.col("page") - 1) % 5 != 0).groupBy("q", "page").agg(
        F.collect_list("r").alias("data")
    )
    path = staged_path(spark, "chains")
    pages.select(
        "q", F.to_json(F.struct(F.when(more, url).alias("next"), "data")).alias("value")
    ).write.partitionBy("q").text(path)
    return f"{path}/*"


def _nation(folder="folder"):
    return F.regexp_extract(folder, r"q=(\d+)$", 1).cast("long").alias("q")


@query(
    _CHAIN
    + """SELECT CAST(q AS BIGINT) AS q, CAST(first_lost AS BIGINT) AS first_lost,
  CAST(last_lost AS BIGINT) AS last_lost FROM gaps"""
)
def page_gaps(spark, sf_dir):
    """Lost pages by their numbers."""
    found = sources.page_gaps(spark, _landed_chain(spark, sf_dir), one_per_file=False)
    return found.select(_nation(), "first_lost", "last_lost")


@query(
    _CHAIN
    + f"""SELECT CAST(c.q AS BIGINT) AS q,
  CAST(coalesce(greatest(max(page) FILTER (WHERE next IS NOT NULL),
    CASE WHEN count(*) FILTER (WHERE next IS NULL) > 0 THEN max(next) END), 1) AS BIGINT) AS last_page,
  CAST(coalesce(max(n_lost), 0) AS BIGINT) AS n_lost,
  CASE WHEN max(n_lost) > 0 THEN 'gaps' WHEN count(*) FILTER (WHERE next IS NULL) > 0 THEN 'complete'
    WHEN max(page) >= {LAST} THEN 'ceiling' ELSE 'unfinished' END AS status
FROM chained c LEFT JOIN (
  SELECT q, sum(last_lost - first_lost + 1) AS n_lost FROM gaps GROUP BY q) g ON c.q = g.q
GROUP BY c.q"""
)
def page_chains(spark, sf_dir):
    """Whether each chain of pages ended, broke, or stopped at the ceiling."""
    found = sources.page_chains(spark, _landed_chain(spark, sf_dir), LAST, one_per_file=False)
    return found.select(_nation(), "last_page", "n_lost", "status")


# External tables and sinks ------------------------------------------------------------


@query(
    using("samples")
    + """SELECT annee_prelevement, code_departement, CAST(count(*) AS BIGINT) AS n
FROM samples WHERE annee_prelevement BETWEEN 1996 AND 1998 GROUP BY ALL"""
)
def external_table(spark, sf_dir):
    """Two years written and named, a third written later and named again."""
    rows = views.samples(spark, sf_dir)
    layout = sources.Layout(root=staged_path(spark, "external"))
    parts = ("annee_prelevement", "code_departement")
    name = f"external_{abs(hash(layout.root)) % 10**9}"
    for years in ((1996, 1997), (1998,)):
        part = rows.filter(F.col("annee_prelevement").isin(*years))
        sources.write_table(part, layout, "gold", "t", parts, mode="append", few_files=True)
        sources.register_external(spark, name, layout.path("gold", "t"), rows.schema, parts)
    return spark.table(name).groupBy(*parts).agg(F.count("*").alias("n"))


@query(
    using("samples")
    + """SELECT code_departement, CAST(count(*) AS BIGINT) AS n FROM samples GROUP BY ALL"""
)
def catalog_table(spark, sf_dir):
    """Written to and read from a schema of its own, in few files."""
    rows = views.samples(spark, sf_dir)
    schema = f"layer_{abs(hash(staged_path(spark, 'catalog'))) % 10**9}"
    layout = sources.Layout(namespaces={"silver": schema})
    current = spark.catalog.currentDatabase()
    sources.ensure_namespace(spark, layout, "silver")
    spark.catalog.setCurrentDatabase(current)
    sources.write_table(rows, layout, "silver", "samples", few_files=True)
    stored = sources.read_table(spark, layout, "silver", "samples", rows.schema)
    return stored.groupBy("code_departement").agg(F.count("*").alias("n"))


# Small contracts ----------------------------------------------------------------------


@query(
    """SELECT o_orderkey, code FROM (SELECT o_orderkey, unnest([lpad(CAST(c_nationkey AS VARCHAR),
  2, '0'), '64']) AS code FROM orders JOIN customer ON o_custkey = c_custkey)"""
)
def expand_nested_codes(spark, sf_dir):
    """Lists in lists, some of them null, of numbers."""
    orders = views.table(spark, sf_dir, "orders")
    nation = views.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(nation, F.col("o_custkey") == F.col("c_custkey"))
    scope = F.array(F.array("c_nationkey"), F.lit(None).cast("array<int>"), F.array(F.lit(64)))
    return op.expand_codes(joined.select("o_orderkey", scope.alias("scope")), "scope").drop("scope")


@query(
    using("statuses")
    + """SELECT CAST(NULL AS VARCHAR) AS code_commune, CAST(count(*) AS BIGINT) AS row_count
FROM statuses WHERE annee_prelevement = 1998"""
)
def page_behind_the_end(spark, sf_dir):
    page = serving.page(
        _statuses(spark, sf_dir), "conformite_commune", limit=5, offset=10_000_000,
        annee_prelevement=1998,
    )
    return page.total_with_rows().select("code_commune", "row_count")


@query(
    using("statuses", "stats")
    + """, chosen AS (SELECT DISTINCT code_commune FROM statuses
  WHERE nom_commune_norm IS NOT NULL AND TRY_CAST(code_commune AS INTEGER) < 25)
SELECT CAST(count(*) AS BIGINT) AS nb_communes,
  CAST(sum(s.nb_prelevements_total) AS BIGINT) AS nb_prelevements_total,
  round(sum(s.taux_conformite_pct * s.nb_prelevements_total) / sum(s.nb_prelevements_total), 2)
    AS taux_conformite_pct, (SELECT CAST(coalesce(sum(nb_mesures), 0) AS BIGINT) FROM stats
    WHERE substr(code_commune, 2) IN (SELECT code_commune FROM chosen)) AS nb_mesures
FROM statuses s WHERE code_commune IN (SELECT code_commune FROM chosen)"""
)
def kpi_summary_measured(spark, sf_dir):
    """Chosen places that have measures."""
    chosen = [str(n) for n in range(25)]
    code = F.substring("code_commune", 2, 10)
    stats = _stats(spark, sf_dir).withColumn("code_commune", code)
    return serving.kpi_summary(_statuses(spark, sf_dir), stats, communes=chosen)


@query(
    using("stats")
    + """SELECT 1998 AS annee_prelevement, min(libelle_parametre_norm) AS libelle_parametre_norm
FROM stats WHERE annee_prelevement = 1998"""
)
def default_values_of_year(spark, sf_dir):
    """The label is one that was measured in the chosen year."""
    return serving.defaults(
        _statuses(spark, sf_dir), _stats(spark, sf_dir), preferred="absent", year=1998, asked="none"
    )


@query(
    """WITH n AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value)
    AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, min(value) FILTER (k >= ceil(0.05 * n)) AS low,
  min(value) FILTER (k >= ceil(0.5 * n)) AS middle, min(value) FILTER (k >= ceil(0.99 * n)) AS high
FROM n GROUP BY event_type"""
)
def exact_quantiles(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    found = op.exact_quantiles(events, ["event_type"], "value", [0.05, 0.5, 0.99])
    return found.select(
        "event_type", *[F.col("q")[i].alias(n) for i, n in enumerate(("low", "middle", "high"))]
    )


@query(
    """SELECT c_custkey, '2025-01-01 00:00:00' AS stamp FROM customer"""
)
def load_time(spark, sf_dir):
    stamped = op.with_load_ts(
        views.table(spark, sf_dir, "customer").select("c_custkey"), "_silver_timestamp",
        "2025-01-01 00:00:00",
    )
    return stamped.select("c_custkey", ts_text("_silver_timestamp").alias("stamp"))


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS code_commune, upper(arg_min(c_name, c_custkey))
  AS nom_commune_norm FROM customer WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey"""
)
def first_of_copies(spark, sf_dir):
    """Copies of a key with differing content: the smallest stays."""
    rows = views.table(spark, sf_dir, "customer").select(
        views.text("c_nationkey").alias("code_commune"), "c_custkey",
        F.upper("c_name").alias("nom_commune_norm"),
    )
    return op.first_per_key(rows, ["code_commune"], ["c_custkey"]).drop("c_custkey")


# The contract of a table --------------------------------------------------------------

_FAULTY = """WITH t AS (SELECT CAST(l_suppkey AS VARCHAR) AS code_commune,
  CASE WHEN l_linenumber < 7 THEN 'R' END AS code_reseau, CAST(l_orderkey AS VARCHAR) AS latitude
FROM lineitem), n AS (SELECT count(*) AS n, count(code_commune) AS c, count(code_reseau) AS r FROM t)
"""


def _line(rule, column, checked, unexpected, observed, ok):
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT 'contract' AS suite, '{rule}' AS rule, {name} AS "column",
  CAST({checked} AS BIGINT) AS n_checked, CAST({unexpected} AS BIGINT) AS n_unexpected,
  {observed} AS observed, {ok} AS success FROM n"""


@query(
    _FAULTY
    + " UNION ALL ".join(
        [
            _line("columns_match_ordered_list", None, "NULL", "NULL",
                  "'code_commune,code_reseau,latitude'", "false"),
            _line("column_count_equals", None, "NULL", "NULL", "'3'", "true"),
            _line("column_exists", "code_commune", "NULL", "NULL", "'true'", "true"),
            _line("column_exists", "missing", "NULL", "NULL", "'false'", "false"),
            _line("column_type_in_list", "latitude", "NULL", "NULL", "'StringType'", "false"),
            _line("column_type_in_list", "missing", "NULL", "NULL", "CAST(NULL AS VARCHAR)", "false"),
            _line("row_count_at_least", None, "n", "0", "CAST(n AS VARCHAR)", "n >= 1"),
            _line("not_null", "code_commune", "n", "n - c", "printf('%.4f', round(c / n, 4))", "c = n"),
            _line("not_null", "code_reseau", "n", "n - r", "printf('%.4f', round(r / n, 4))",
                  "r >= 0.9 * n"),
        ]
    )
)
def quality_contract(spark, sf_dir):
    """A table with a missing, a surplus, a misplaced and a mistyped column."""
    rows = views.table(spark, sf_dir, "lineitem").select(
        views.text("l_suppkey").alias("code_commune"),
        F.when(F.col("l_linenumber") < 7, F.lit("R")).alias("code_reseau"),
        views.text("l_orderkey").alias("latitude"),
    )
    rules = [
        quality.columns_match(rows, ("code_reseau", "code_commune", "missing")),
        quality.column_count(rows, 3),
        quality.column_exists(rows, "code_commune"),
        quality.column_exists(rows, "missing"),
        quality.column_type(rows, "latitude", ("DoubleType",)),
        quality.column_type(rows, "missing", ("DoubleType",)),
        quality.row_count(1),
        quality.not_null("code_commune"),
        quality.not_null("code_reseau", 0.9),
    ]
    return quality.check(rows, {"contract": rules})
