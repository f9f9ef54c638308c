"""Landed JSON documents made from tables, for the source queries.

Pages are runs of rows of one scan task, so a page never holds more than
``page_size`` records however the keys are spread. Documents are landed as
gzip, in files of a bounded number of records each, as such a file is read by
one task.
"""

from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayline import sources
from assayline.plans import jobs
from assayline.plans.jobs import Landing
from assayline.sources.staging import delete_folder, release, shuffles_end, staged, staged_path

PAGE_SIZE = 200
# Most records in a landed file.
FILE_RECORDS = 100_000


def _paged(rows: DataFrame, page_size: int) -> DataFrame:
    """(run, n, data): pages as JSON lists, put together in the task that has
    their rows, so that whole records aren't shuffled."""

    # Defined in here, so tasks get it by value: they need no package.
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(runs: pa.Array, texts: pa.Array, ends: list[int]) -> pa.RecordBatch:
            starts = [0, *ends[:-1]]
            sizes = [end - start for start, end in zip(starts, ends, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), texts)
            data = pc.binary_join_element_wise("[", pc.binary_join(lists, ","), "]", "")
            columns = [runs.take(pa.array(starts)), pa.array(sizes, pa.int64()), data]
            return pa.RecordBatch.from_arrays(columns, ["run", "n", "data"])

        # Rows of the last page, which the next batch may go on with.
        runs, texts = pa.array([], pa.int64()), pa.array([], pa.string())
        for batch in batches:
            runs = pa.concat_arrays([runs, batch["run"]])
            texts = pa.concat_arrays([texts, batch["record"]])
            ends = pc.run_end_encode(runs).run_ends.to_pylist()
            if len(ends) > 1:
                last = ends[-2]
                yield made(runs, texts.slice(0, last), ends[:-1])
                runs, texts = runs.slice(last), texts.slice(last)
        if len(runs):
            yield made(runs, texts, [len(runs)])

    run = F.floor(F.monotonically_increasing_id() / page_size)
    records = rows.select(run.alias("run"), F.to_json(F.struct(*rows.columns)).alias("record"))
    return records.mapInArrow(joined, "run long, n long, data string")


def _object(**members: Column) -> Column:
    """A JSON object of members that are JSON already; a null one is left out."""
    named = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))


def _saved(docs: DataFrame, label: str, doc_records: int = PAGE_SIZE) -> str:
    path = staged_path(docs.sparkSession, label)
    lines = max(1, FILE_RECORDS // doc_records)
    # Written and read once, so the least effort is the quickest.
    writer = docs.write.option("maxRecordsPerFile", lines).option("zlib.compress.level", "BEST_SPEED")
    with shuffles_end(docs.sparkSession):
        writer.text(path, compression="gzip")
    return path


def envelopes(
    rows: DataFrame,
    page_size: int = PAGE_SIZE,
    foreign: DataFrame | None = None,
    total: int | None = None,
) -> str:
    """Folder of ``{"count", "next", "data"}`` lines; ``foreign`` rows are added
    as documents of another shape. ``total`` is the number of rows where it is
    known; else they are counted by a query of its own, whose shuffle files go
    before pages are made."""
    if total is None:
        with shuffles_end(rows.sparkSession):
            total = rows.count()
    more = F.when(F.col("n") == page_size, F.lit('"more"'))
    docs = _paged(rows, page_size).select(
        _object(count=F.lit(total).cast("string"), next=more, data=F.col("data")).alias("value")
    )
    if foreign is not None:
        docs = docs.unionByName(
            foreign.select(F.to_json(F.struct(*foreign.columns)).alias("value"))
        )
    return _saved(docs, "envelopes", page_size)


def arrays(rows: DataFrame, page_size: int = PAGE_SIZE) -> str:
    """Folder of lines that are bare lists."""
    docs = _paged(rows, page_size).select(F.col("data").alias("value"))
    return _saved(docs, "arrays", page_size)


def records(rows: DataFrame) -> str:
    """Folder of one record per line."""
    return _saved(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")), "records", 1)


def collections(rows: DataFrame, page_size: int = PAGE_SIZE) -> str:
    """Folder of feature collections; a row without longitude has no geometry."""
    properties = [c for c in rows.columns if c not in ("longitude", "latitude")]
    point = F.struct(F.array("longitude", "latitude").alias("coordinates"))
    features = rows.select(
        F.struct(*properties).alias("properties"),
        F.when(F.col("longitude").isNotNull(), point).alias("geometry"),
    )
    docs = _paged(features, page_size).select(
        _object(
            type=F.lit('"FeatureCollection"'),
            page=F.col("run").cast("string"),
            features=F.col("data"),
        ).alias("value")
    )
    return _saved(docs, "collections", page_size)


def run_layers(
    spark: SparkSession,
    label: str,
    places: DataFrame,
    networks: DataFrame,
    results: DataFrame,
    moment: str,
) -> sources.Layout:
    """Layers of a whole run over the three sources as landed documents. Large
    sources are landed in batches, by a hash of a column of the line items; the
    documents of a batch go as soon as bronze holds them, and a table that only
    jobs read as soon as the last of them is done with it: gold and the quality
    results stay. Networks come once results have left bronze, and a batch of
    them is made into stations before the next is landed."""
    layout = sources.Layout(root=staged_path(spark, label), compression="zstd")

    def land(name: str, path: str, k: int = 0) -> None:
        landed = Landing({name: path}, {name: f"landed:{name}"}, one_per_file=False)
        jobs.run(spark, layout, landed, last="bronze", moment=moment, only=name, append=k > 0)
        release(path)

    def spent(layer: str, name: str) -> None:
        delete_folder(spark, layout.path(layer, name))

    def spent_networks(layer: str, name: str) -> None:
        if name == "communes_udi":
            spent(layer, name)

    def spent_part(layer: str, name: str, part: Mapping[str, object]) -> None:
        sources.delete_partition(spark, layout, layer, name, part)

    silver = {"first": "silver", "last": "silver", "moment": moment}
    land("geo_communes", collections(places))
    for k, (rows, n) in enumerate(jobs.batches_of(results, ["code_prelevement"])):
        land("resultats_dis", envelopes(rows, PAGE_SIZE, None, n), k)
    jobs.run(
        spark, layout, tables=("mesures", "conformite"), spent=spent, spent_part=spent_part, **silver
    )
    # Stations are by network too, so a batch holds all rows of its stations.
    batches = jobs.batches_of(networks, ["code_reseau"])
    for k, (rows, n) in enumerate(batches):
        land("communes_udi", envelopes(rows, PAGE_SIZE, None, n), k)
        done = spent if k == len(batches) - 1 else spent_networks
        jobs.run(
            spark, layout, tables=("stations",), append=k > 0, slices=1, spent=done, **silver
        )
    jobs.quality(spark, layout)
    delete_folder(spark, f"{layout.root}/bronze")
    jobs.run(spark, layout, first="gold", moment=moment, spent=spent)
    delete_folder(spark, f"{layout.root}/silver")
    return layout


def _numbered(rows: DataFrame) -> DataFrame:
    """Each row as ``r`` with its number ``no``, counted from 0 over all tasks. Rows are
    staged with their task first, since a second scan may deal them otherwise;
    only the tasks' counts are added up in one place."""
    placed = staged(
        rows.select(
            F.struct(*rows.columns).alias("r"),
            F.spark_partition_id().alias("task"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "numbered",
    )
    tasks = placed.groupBy("task").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.orderBy("task")) - F.col("n")
    starts = tasks.select("task", (before - F.col("first")).alias("start"))
    return placed.join(starts, "task").select("r", (F.col("place") + F.col("start")).alias("no"))


def faulty_envelopes(rows: DataFrame, page_size: int = PAGE_SIZE) -> str:
    """As ``envelopes``, with the first page lost but for a torn half, and the
    second landed twice. Only the last page may hold fewer records than the
    others, however the rows are dealt to tasks."""
    total = rows.agg(F.count("*")).scalar()
    number = F.floor(F.col("no") / page_size) + 1
    docs = _numbered(rows).groupBy(number.alias("no")).agg(F.collect_list("r").alias("data"))
    text = F.to_json(F.struct(total.alias("count"), F.lit(None).cast("string").alias("next"), "data"))
    torn = F.substring(text, 1, 60)
    lines = docs.select("no", F.when(F.col("no") == 1, torn).otherwise(text).alias("value"))
    again = F.explode(F.array_repeat("value", F.when(F.col("no") == 2, 2).otherwise(1)))
    return _saved(lines.select(again.alias("value")), "faulty", page_size)


def saved_documents(docs: DataFrame, label: str, doc_records: int = 1) -> str:
    """Folder of one document per line, as the rows are."""
    lines = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))
    return _saved(lines, label, doc_records)
