"""What landed records hold, next to the schema they are read with.

Readers take the declared fields only. Here every field of every record is
looked at: records are parsed as variants, opened level by level, and each
(field, kind of value) is counted, combined in the map tasks. What reaches the
shuffle is one row per field and kind a task, however many records there are.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.sources.landed import SHAPES

# Kinds of JSON values a declared type takes without loss.
KINDS = {
    T.StringType: ("text",),
    T.DateType: ("text",),
    T.TimestampType: ("text",),
    T.BooleanType: ("boolean",),
    T.IntegerType: ("whole",),
    T.LongType: ("whole",),
    T.DoubleType: ("number", "whole"),
    T.ArrayType: ("list",),
    T.StructType: ("object",),
}


def _type_name(value: Column) -> Column:
    """Type of a variant without what it is made of: ``OBJECT``, ``DECIMAL``, ..."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def _kind(name: Column) -> Column:
    """Kind of a type name: text, whole, number, boolean, list, object or null."""
    return (
        F.when(name == "VOID", "null")
        .when(name == "OBJECT", "object")
        .when(name == "ARRAY", "list")
        .when(name == "STRING", "text")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "BIGINT", "whole")
        .otherwise("number")
    )


def _opened(rows: DataFrame, k: int) -> DataFrame:
    """One row per entry of ``__value`` with its place, key and value as
    ``__pos<k>``, ``__key<k>``, ``__value<k>``; nulls where it has none."""
    spark = rows.sparkSession
    return rows.lateralJoin(
        spark.tvf.variant_explode_outer(F.col(f"__value{k - 1}").outer()).toDF(
            f"__pos{k}", f"__key{k}", f"__value{k}"
        )
    )


def _records(spark: SparkSession, path: str, shape: str, one_per_file: bool) -> DataFrame:
    """``__value0``: each record (or properties of a feature) as a variant."""
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape}; known: {list(SHAPES)}")
    whole = one_per_file and shape != "records"
    docs = spark.read.text(path, wholetext=whole).select(
        F.try_parse_json("value").alias("__doc")
    )
    if shape in ("envelope", "geojson"):
        place = "$.data" if shape == "envelope" else "$.features"
        docs = docs.select(F.try_variant_get("__doc", place, "variant").alias("__doc"))
    items = "array<variant>"
    listed = F.try_variant_get("__doc", "$", items)
    if shape == "records":
        listed = F.coalesce(listed, F.array("__doc"))
    records = docs.select(F.explode(listed).alias("__value0"))
    if shape == "geojson":
        inner = F.try_variant_get("__value0", "$.properties", "variant")
        records = records.select(inner.alias("__value0"))
    return records.filter(F.col("__value0").isNotNull())


def field_profile(
    spark: SparkSession,
    path: str,
    shape: str = "records",
    one_per_file: bool = True,
    depth: int = 2,
) -> DataFrame:
    """(field, kind, n): how many values of each kind each field has. Fields of
    an object are ``a.b``, entries of a list ``a[]``. Records are opened
    ``depth`` levels deep. Documents that can't be parsed are left out (see
    ``rejects``), as is one beyond the size of a variant (128 MiB)."""
    rows = _records(spark, path, shape, one_per_file)
    # Lists and objects of the first level are fields; a record itself is none.
    for k in range(1, depth + 1):
        rows = _opened(rows, k)
        above = F.col(f"__path{k - 1}") if k > 1 else F.lit("")
        step = F.when(F.col(f"__key{k}").isNull(), F.concat(above, F.lit("[]"))).otherwise(
            F.concat(above, F.lit("." if k > 1 else ""), F.col(f"__key{k}"))
        )
        rows = rows.withColumn(f"__path{k}", F.when(F.col(f"__pos{k}").isNotNull(), step))
    found = []
    for k in range(1, depth + 1):
        # An entry stands on as many rows as it has entries; it counts once.
        once = F.lit(True)
        for deeper in range(k + 1, depth + 1):
            once &= F.coalesce(F.col(f"__pos{deeper}"), F.lit(0)) == 0
        entry = F.struct(
            F.col(f"__path{k}").alias("field"), _type_name(F.col(f"__value{k}")).alias("type")
        )
        found.append(F.when(F.col(f"__path{k}").isNotNull() & once, entry))
    entries = rows.select(F.explode(F.array_compact(F.array(*found))).alias("e"))
    # Counted by type name first: a type is then looked up once a value, and its kind
    # once a field and type.
    types = entries.groupBy("e.field", "e.type").agg(F.count("*").alias("n"))
    return types.groupBy("field", _kind(F.col("type")).alias("kind")).agg(F.sum("n").alias("n"))


def declared_fields(schema: T.StructType, depth: int = 2) -> list[tuple[str, str, list[str]]]:
    """(field, type, kinds it takes) of a schema, named as ``field_profile``
    does, ``depth`` levels deep."""
    made: list[tuple[str, str, list[str]]] = []

    def add(name: str, kind: T.DataType, level: int) -> None:
        made.append((name, kind.simpleString(), list(KINDS.get(type(kind), ("number", "whole")))))
        if level == depth:
            return
        if isinstance(kind, T.ArrayType):
            add(f"{name}[]", kind.elementType, level + 1)
        elif isinstance(kind, T.StructType):
            for f in kind:
                add(f"{name}.{f.name}", f.dataType, level + 1)

    for f in schema:
        add(f.name, f.dataType, 1)
    return made


def schema_drift(
    spark: SparkSession,
    path: str,
    record_schema: T.StructType,
    shape: str = "records",
    one_per_file: bool = True,
    depth: int = 2,
) -> DataFrame:
    """One row per field that is declared or was landed: (field, declared, found,
    n_values, n_nulls, n_odd, status).

    ``found`` lists the kinds of its values, ``n_odd`` counts those that the
    declared type doesn't take. ``status``: ``unknown`` (landed, not declared),
    ``missing`` (declared, in no record), ``retyped`` (some values are odd),
    ``empty`` (only nulls), else ``as declared``.
    """
    declared = spark.createDataFrame(
        declared_fields(record_schema, depth), "field string, declared string, __takes array<string>"
    )
    profile = field_profile(spark, path, shape, one_per_file, depth)
    joined = profile.join(declared, "field", "full")
    null = F.col("kind") == "null"
    odd = ~null & F.col("declared").isNotNull() & ~F.array_contains("__takes", F.col("kind"))
    count = F.coalesce("n", F.lit(0))
    fields = joined.groupBy("field").agg(
        F.max("declared").alias("declared"),
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("found"),
        F.sum(count).alias("n_values"),
        F.sum(F.when(null, count).otherwise(0)).alias("n_nulls"),
        F.sum(F.when(odd, count).otherwise(0)).alias("n_odd"),
    )
    status = (
        F.when(F.col("declared").isNull(), "unknown")
        .when(F.col("n_values") == 0, "missing")
        .when(F.col("n_odd") > 0, "retyped")
        .when(F.col("n_values") == F.col("n_nulls"), "empty")
        .otherwise("as declared")
    )
    return fields.withColumn("status", status)
