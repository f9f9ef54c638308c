"""Scans of landed JSON documents, always with a declared schema.

``one_per_file`` says how documents were landed: one per file (as an HTTP page
is saved) or one per line, which keeps large landings splittable.

Four shapes are known: ``records`` (an object each), ``array`` (a bare list of
objects), ``envelope`` (a page with ``data``) and ``geojson`` (a feature
collection). No reader makes rows of a document that can't be read; ``rejects``
lists such documents for every shape.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.operators.shape import expand_codes

CORRUPT = "_corrupt_record"
SHAPES = ("records", "array", "envelope", "geojson")


def _scan(spark, path, schema: T.StructType, one_per_file: bool) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("multiLine", one_per_file)
        .json(path)
    )


def _unreadable() -> Column:
    """Whether the document is torn, or neither an object nor a list. One that
    only holds a value of another type than declared is read, that value as
    null."""
    text = F.col(CORRUPT)
    container = text.rlike(r"^\s*[\{\[]")
    return text.isNotNull() & ~(container & F.try_parse_json(text).isNotNull())


def _with_corrupt(record_schema: T.StructType) -> T.StructType:
    return T.StructType([*record_schema, T.StructField(CORRUPT, T.StringType())])


def _torn_record(record_schema: T.StructType) -> Column:
    """``_unreadable`` of a record. It names a field of the record, as Spark
    scans no corrupt column alone; the condition on it is never true."""
    if not len(record_schema):
        return _unreadable()
    field = F.col(record_schema.names[0]).cast("string")
    return _unreadable() | F.coalesce(F.length(field) < 0, F.lit(False))


def _whole_records(docs: DataFrame, record_schema: T.StructType) -> DataFrame:
    return docs.filter(~_torn_record(record_schema)).select(*record_schema.names)


def read_json_records(
    spark: SparkSession, path: str, record_schema: T.StructType
) -> DataFrame:
    """One record per line. No line gives no row, with the declared columns;
    neither does a torn line (see ``rejects``)."""
    docs = _scan(spark, path, _with_corrupt(record_schema), one_per_file=False)
    return _whole_records(docs, record_schema)


def read_json_array(
    spark: SparkSession, path: str, record_schema: T.StructType, one_per_file: bool = True
) -> DataFrame:
    """Documents that are bare lists of records: one row per element. A torn
    list gives no row (see ``rejects``)."""
    docs = _scan(spark, path, _with_corrupt(record_schema), one_per_file)
    return _whole_records(docs, record_schema)


def _pages(spark, path, record_schema, one_per_file) -> DataFrame:
    page = T.StructType(
        [
            T.StructField("count", T.LongType()),
            T.StructField("next", T.StringType()),
            T.StructField("data", T.ArrayType(record_schema)),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
    return _scan(spark, path, page, one_per_file).withColumn(
        "_source_file", F.col("_metadata.file_path")
    )


def read_envelope(
    spark: SparkSession,
    path: str,
    record_schema: T.StructType,
    one_per_file: bool = True,
    seen: Observation | None = None,
) -> DataFrame:
    """Records of all ``{"count", "data": [...], "next"}`` pages under ``path``.
    Documents of another shape have no ``data`` and give no row; neither do
    documents that can't be read, which ``page_rejects`` lists. ``seen`` has the
    number of both as ``n_lost`` once the rows were written."""
    pages = _pages(spark, path, record_schema, one_per_file).select("data")
    if seen is not None:
        pages = pages.observe(seen, F.count_if(F.col("data").isNull()).alias("n_lost"))
    return pages.select(F.inline("data"))


def page_rejects(
    spark: SparkSession, path: str, record_schema: T.StructType, one_per_file: bool = True
) -> DataFrame:
    """``rejects`` of envelopes."""
    return rejects(spark, path, record_schema, "envelope", one_per_file)


def _documents(spark, path, record_schema, shape, one_per_file) -> DataFrame:
    """(_source_file, __reason, __records, __partial, document) of each document,
    or of each record of the shapes that are read record by record."""
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape}; known: {list(SHAPES)}")
    if shape in ("envelope", "geojson"):
        field, reason = ("data", "no data") if shape == "envelope" else ("features", "no features")
        read = _pages if shape == "envelope" else _collections
        docs = read(spark, path, record_schema, one_per_file)
        none = F.col(field).isNull()
        broken = F.when(none & F.col(CORRUPT).isNotNull(), F.lit("unreadable"))
        why = F.coalesce(broken, F.when(none, F.lit(reason)))
        size = F.coalesce(F.size(field), F.lit(0))
    else:
        docs = _scan(
            spark, path, _with_corrupt(record_schema), one_per_file and shape == "array"
        ).withColumn("_source_file", F.col("_metadata.file_path"))
        why = F.when(_torn_record(record_schema), F.lit("unreadable"))
        size = F.when(why.isNull(), 1).otherwise(0)
    return docs.select(
        "_source_file",
        why.alias("__reason"),
        size.cast("long").alias("__records"),
        (why.isNull() & F.col(CORRUPT).isNotNull()).alias("__partial"),
        F.col(CORRUPT).alias("document"),
    )


def rejects(
    spark: SparkSession,
    path: str,
    record_schema: T.StructType,
    shape: str = "envelope",
    one_per_file: bool = True,
) -> DataFrame:
    """``(_source_file, reason, document)`` of every document that gives no
    records: ``unreadable`` with its text, or ``no data`` / ``no features``
    where an envelope or a collection was expected. ``record_schema`` is that of
    a record, or of the properties of a feature."""
    found = _documents(spark, path, record_schema, shape, one_per_file)
    return found.filter(F.col("__reason").isNotNull()).select(
        "_source_file", F.col("__reason").alias("reason"), "document"
    )


def landing_ledger(
    spark: SparkSession,
    path: str,
    record_schema: T.StructType,
    shape: str = "envelope",
    one_per_file: bool = True,
) -> DataFrame:
    """One row per file: records read, unreadable documents, documents of
    another shape, and documents (or records) with a value that doesn't fit its
    declared type and was read as null."""
    found = _documents(spark, path, record_schema, shape, one_per_file)
    return found.groupBy("_source_file").agg(
        F.sum("__records").alias("n_records"),
        F.count_if(F.col("__reason") == "unreadable").alias("n_unreadable"),
        F.count_if(F.col("__reason").startswith("no ")).alias("n_foreign"),
        F.count_if("__partial").alias("n_partial"),
    )


def collection_completeness(
    spark: SparkSession, path: str, property_schema: T.StructType, one_per_file: bool = True
) -> DataFrame:
    """``page_completeness`` of feature collections, which announce no count and
    no last page: whole where each document was read and is a collection."""
    files = landing_ledger(spark, path, property_schema, "geojson", one_per_file)
    zero = F.lit(0).cast("long")
    lost = F.col("n_unreadable") + F.col("n_foreign")
    return files.agg(
        F.count("*").alias("n_pages"),
        F.coalesce(F.sum("n_records"), zero).alias("n_records"),
        F.lit(None).cast("long").alias("declared_count"),
        F.coalesce(F.sum(lost), zero).alias("n_unreadable"),
        F.lit(None).cast("long").alias("n_last_pages"),
        F.coalesce(F.bool_and(lost == 0), F.lit(False)).alias("is_complete"),
    )


def _page_numbers(spark, path, one_per_file) -> DataFrame:
    """(folder, page, next) of each landed envelope. A page's number is one less
    than that of the page it points to; the last page's number is in its file
    name, or follows the highest."""
    anything = T.StructType([])
    pages = _pages(spark, path, anything, one_per_file).filter(F.col("data").isNotNull())
    onward = F.regexp_extract("next", r"[?&]page=(\d+)", 1).try_cast("long")
    named = F.regexp_extract("_source_file", r"(\d+)[^/\d]*$", 1).try_cast("long")
    return pages.select(
        F.regexp_extract("_source_file", r"^(.*)/[^/]*$", 1).alias("folder"),
        F.coalesce(onward - 1, named if one_per_file else F.lit(None).cast("long")).alias("page"),
        onward.alias("next"),
    )


def page_gaps(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """(folder, first_lost, last_lost): runs of pages that are missing between
    landed ones, or before the first. Pages are chained by the ``page=`` number
    of their ``next``; a folder holds the pages of one query."""
    pages = _page_numbers(spark, path, one_per_file).filter(F.col("page").isNotNull())
    seen = pages.select("folder", "page").distinct()
    before = F.lag("page", 1, 0).over(Window.partitionBy("folder").orderBy("page"))
    return (
        seen.withColumn("__before", before)
        .filter(F.col("page") > F.col("__before") + 1)
        .select(
            "folder",
            (F.col("__before") + 1).alias("first_lost"),
            (F.col("page") - 1).alias("last_lost"),
        )
    )


def page_chains(
    spark: SparkSession, path: str, max_pages: int, one_per_file: bool = True
) -> DataFrame:
    """One row per folder: the highest landed page, the number of lost ones,
    and ``status``: ``gaps`` where a page in between is lost; ``complete`` where a
    page without ``next`` ends the chain; ``ceiling`` where it stops with more to
    come at ``max_pages``; else ``unfinished``."""
    pages = _page_numbers(spark, path, one_per_file)
    gaps = page_gaps(spark, path, one_per_file).groupBy("folder").agg(
        F.sum(F.col("last_lost") - F.col("first_lost") + 1).alias("n_lost")
    )
    chains = pages.groupBy("folder").agg(
        F.count_if(F.col("page").isNull()).alias("__unnumbered"),
        F.max("page").alias("__page"),
        F.max("next").alias("__next"),
        F.max(F.col("next").isNull()).alias("__ended"),
    )
    lost = F.coalesce("n_lost", F.lit(0))
    # A last page without a number of its own stands where the highest points to.
    top = F.coalesce(F.greatest("__page", F.when(F.col("__unnumbered") > 0, F.col("__next"))), F.lit(1))
    status = (
        F.when(lost > 0, "gaps")
        .when(F.col("__ended"), "complete")
        .when(top >= max_pages, "ceiling")
        .otherwise("unfinished")
    )
    return chains.join(gaps, "folder", "left").select(
        "folder", top.alias("last_page"), lost.alias("n_lost"), status.alias("status")
    )


def page_completeness(
    spark: SparkSession, path: str, record_schema: T.StructType, one_per_file: bool = True
) -> DataFrame:
    """One row telling whether the landed pages hold what they announce: enough
    records, a last page, and no unreadable page.

    A page that was landed twice counts once, so it can't stand in for a lost
    one. Each folder under ``path`` holds the pages of one query and is held
    against its own ``count``; the counts of all folders are added up.
    """
    folder = F.regexp_extract("_source_file", r"^(.*)/[^/]*$", 1)
    content = F.to_json(F.struct("next", "data"))
    pages = _pages(spark, path, record_schema, one_per_file).select(
        folder.alias("__folder"),
        "count",
        F.col("data").isNull().alias("__lost"),
        (F.col("data").isNotNull() & F.col("next").isNull()).alias("__last"),
        F.coalesce(F.size("data"), F.lit(0)).cast("long").alias("__records"),
        F.when(F.col("data").isNotNull(), F.sha2(content, 256)).alias("__page"),
    )
    distinct = pages.groupBy("__folder", "__page").agg(
        F.count("*").alias("n"),
        F.max("__records").alias("__records"),
        F.max("count").alias("count"),
        F.count_if("__lost").alias("__lost"),
        F.count_if("__last").alias("__last"),
    )
    folders = distinct.groupBy("__folder").agg(
        F.sum("n").alias("n_pages"),
        F.sum("__records").alias("n_records"),
        F.max("count").alias("declared_count"),
        F.sum("__lost").alias("n_unreadable"),
        F.sum("__last").alias("n_last_pages"),
    )
    enough = F.col("n_records") >= F.coalesce(F.col("declared_count"), F.lit(0))
    whole = enough & (F.col("n_unreadable") == 0) & (F.col("n_last_pages") > 0)
    names = ("n_pages", "n_records", "declared_count", "n_unreadable", "n_last_pages")
    zero = F.lit(0).cast("long")
    return folders.withColumn("__whole", whole).agg(
        *[
            F.sum(n).alias(n) if n == "declared_count" else F.coalesce(F.sum(n), zero).alias(n)
            for n in names
        ],
        F.coalesce(F.bool_and("__whole"), F.lit(False)).alias("is_complete"),
    )


def _collections(spark, path, property_schema, one_per_file) -> DataFrame:
    point = T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
    feature = T.StructType(
        [T.StructField("properties", property_schema), T.StructField("geometry", point)]
    )
    schema = T.StructType(
        [
            T.StructField("features", T.ArrayType(feature)),
            T.StructField("page", T.LongType()),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
    return _scan(spark, path, schema, one_per_file).withColumn(
        "_source_file", F.col("_metadata.file_path")
    )


def read_geojson(
    spark: SparkSession,
    path: str,
    property_schema: T.StructType,
    one_per_file: bool = True,
    with_position: bool = False,
) -> DataFrame:
    """One row per feature: its properties and ``longitude``, ``latitude``, both
    null without geometry. ``with_position`` adds what tells the arrival order:
    the file, the ordinal that the document carries as ``page`` (null without
    one), the place in the document, and whether the file may hold several
    documents."""
    docs = _collections(spark, path, property_schema, one_per_file)
    extra = []
    if with_position:
        extra = ["_source_file", F.col("page").alias("_page")]
    features = docs.select(*extra, F.posexplode("features").alias("_position", "f"))
    point = F.col("f.geometry.coordinates")
    return features.select(
        "f.properties.*",
        F.get(point, F.lit(0)).alias("longitude"),
        F.get(point, F.lit(1)).alias("latitude"),
        *(["_source_file", "_page", "_position"] if with_position else []),
        *([F.lit(not one_per_file).alias("_in_lines")] if with_position else []),
    )


def department_codes(records: DataFrame, column: str = "code") -> DataFrame:
    """Distinct sorted codes of landed region or department records."""
    return expand_codes(records.select(column), column, "__code").select(
        F.col("__code").alias("code")
    ).distinct().orderBy("code")
