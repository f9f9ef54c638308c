"""Layer tables: by path, or by name in a catalog."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.sources.staging import delete_folder, files_open, shuffles_end, write_slices

# Partitions that a task writes side by side where rows aren't rebalanced.
OPEN_FILES = 16


@dataclass(frozen=True)
class Layout:
    """Where layers live. With ``namespaces`` (layer to schema) tables are
    catalog tables; otherwise they are ``root/layer/name`` folders.
    ``compression`` is that of the files, the format's own if unset."""

    root: str | None = None
    file_format: str = "parquet"
    catalog: str | None = None
    namespaces: Mapping[str, str] = field(default_factory=dict)
    compression: str | None = None

    @property
    def in_catalog(self) -> bool:
        return bool(self.namespaces)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fq_table(layout: Layout, layer: str, name: str) -> str:
    parts = [layout.catalog, layout.namespaces[layer], name]
    return ".".join(quoted(p) for p in parts if p)


def ensure_namespace(spark: SparkSession, layout: Layout, layer: str) -> None:
    """Create and select the namespace of a layer (nothing to do for paths)."""
    if not layout.in_catalog:
        return
    parts = [layout.catalog, layout.namespaces[layer]]
    name = ".".join(quoted(p) for p in parts if p)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def read_table(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    name: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A layer table. A declared schema keeps partition codes such as ``01`` as
    text; they would become numbers if inferred from folder names."""
    if layout.in_catalog:
        df = spark.table(fq_table(layout, layer, name))
        return df.select(*schema.names) if schema else df
    reader = spark.read.format(layout.file_format)
    if schema is not None and layout.file_format == "parquet":
        reader = reader.schema(schema)
    return reader.load(layout.path(layer, name))


def delete_partition(
    spark: SparkSession, layout: Layout, layer: str, name: str, part: Mapping[str, object]
) -> bool:
    """Delete the folder of a partition (column to value, whole numbers or null)
    of a layer table that is read by path; nothing may read it any more."""
    if layout.in_catalog:
        raise ValueError("partitions of catalog tables are not deleted by folder")
    null = "__HIVE_DEFAULT_PARTITION__"
    steps = [f"{c}={null if v is None else int(v)}" for c, v in part.items()]
    return delete_folder(spark, "/".join([layout.path(layer, name), *steps]))


def write_table(
    df: DataFrame,
    layout: Layout,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    few_files: bool = False,
    skip_if_empty: bool = False,
    slices: int = 1,
    slice_by: Sequence[str] = (),
    rebalance: bool = True,
) -> int:
    """Write a layer table and return how many rows it then holds.

    Partition columns that ``df`` lacks are ignored. Rows are rebalanced on the
    partition columns first: small partitions share a task, and AQE splits one
    that holds much of the data. ``few_files`` rebalances tables without
    partitions too: a small one becomes a single file, a large one stays split.
    Without ``rebalance`` rows are stored by the tasks that have them, a file per
    task and partition: for large tables of few partitions.
    The row count comes from the stored table (file footers), so a task that
    ran twice is not counted twice. With ``slices`` the table is written in so
    many parts, cut by ``slice_by`` (see ``write_slices``); shuffle files of each
    go when it is written.
    """
    spark = df.sparkSession
    if skip_if_empty and df.isEmpty():
        return 0
    parts = [c for c in partition_by if c in df.columns]

    def write(rows: DataFrame, mode: str) -> None:
        if rebalance and (parts or few_files):
            rows = rows.hint("rebalance", *[F.col(c) for c in parts])
        writer = rows.write.format(layout.file_format).mode(mode)
        if layout.file_format == "delta" and mode == "overwrite":
            writer = writer.option("overwriteSchema", "true")
        if layout.compression:
            writer = writer.option("compression", layout.compression)
        if parts:
            writer = writer.partitionBy(*parts)
        if layout.in_catalog:
            writer.saveAsTable(fq_table(layout, layer, name))
        else:
            writer.save(layout.path(layer, name))

    with shuffles_end(spark), files_open(spark, 0 if rebalance else OPEN_FILES):
        write_slices(df, write, slices, slice_by, mode)
        if layout.in_catalog:
            return spark.table(fq_table(layout, layer, name)).count()
        stored = spark.read.format(layout.file_format)
        if layout.file_format == "parquet":
            stored = stored.schema(df.schema)
        return stored.load(layout.path(layer, name)).count()


def register_external(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    file_format: str = "parquet",
) -> None:
    """Name the files under ``path`` as a table; ``table`` is already quoted.

    With ``schema``, columns and partition columns are declared, so codes such
    as ``01`` stay text; without it they are inferred. Partitions are listed at
    every call: those that were written or removed since the last one are then
    known.
    """
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    columns = by = ""
    if schema is not None:
        parts = [c for c in partition_by if c in schema.names]
        fields = [f for f in schema if f.name not in parts] + [schema[c] for c in parts]
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        columns = f" ({columns})"
        by = f" PARTITIONED BY ({', '.join(quoted(c) for c in parts)})" if parts else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table}{columns} USING {file_format}{by} "
        f"LOCATION '{location}'"
    )
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    else:
        spark.catalog.refreshTable(table)


def register_views(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    schemas: Mapping[str, T.StructType],
    prefix: str = "",
) -> list[str]:
    """A temporary view per table of ``schemas``."""
    names = []
    for name, schema in schemas.items():
        view = f"{prefix}{name}"
        read_table(spark, layout, layer, name, schema).createOrReplaceTempView(view)
        names.append(view)
    return names
