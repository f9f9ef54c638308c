"""What queries leave in the shared folder, and how they land documents."""

import json
import time
from pathlib import Path

from pyspark.sql import functions as F

from assayline import schemas, sources
from assayline.plans import gold, jobs
from assayline.sources.staging import Staging, counted_cut, staging_root
from registry import QUERIES, catalog, landing, runs, views

SMALL = "/root/testdata/sf0.001"


def _staged(spark) -> set[str]:
    folder = Path(staging_root(spark).removeprefix("file:")) / "staged"
    return {p.name for p in folder.iterdir()} if folder.is_dir() else set()


def test_a_run_leaves_no_landed_documents(spark):
    before = _staged(spark)
    runs._layouts.clear()
    stored = runs.run_conformite_commune(spark, SMALL)
    left = {name.split("-")[0] for name in _staged(spark) - before}
    assert left == {"run"}
    assert stored.count() > 0


def test_landed_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(landing, "FILE_RECORDS", 40)
    rows = spark.range(100, numPartitions=1).select(F.col("id").alias("a"))
    folder = Path(landing.envelopes(rows, page_size=10).removeprefix("file:"))
    files = sorted(folder.glob("part-*"))
    assert {f.suffix for f in files} == {".gz"}
    assert max(spark.read.text(str(f)).count() for f in files) <= 4
    assert sum(spark.read.text(str(f)).count() for f in files) == 10


def _arrivals(spark, tmp_path):
    lines = [(o, 1 + o % 3, 100 + (o * 7) % 11, o % 4) for o in range(1, 400)]
    # The same line of the same supplier again, with another part.
    lines += [(o, n, p + 1, s) for o, n, p, s in lines if o % 2]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long"
    spark.createDataFrame(lines, names).repartition(7).write.parquet(f"{tmp_path}/lineitem.parquet")
    last = {}
    for o, n, p, s in sorted(lines, key=lambda x: (x[0], x[1], [-ord(c) for c in str(x[2])])):
        last[str(s)] = str(p)
    return set(last.items())


def test_pages_in_many_files_arrive_in_their_order(spark, tmp_path):
    wanted = _arrivals(spark, tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {tuple(r) for r in QUERIES["dedupe_geo_lines"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == wanted


def test_the_torn_page_is_a_full_one_wherever_the_rows_are(spark, tmp_path):
    # Seven small files: no task holds a whole page.
    row = "id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice"
    spark.range(500, numPartitions=7).selectExpr(*row.split(", ")).write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))
    try:
        found = QUERIES["page_completeness_faulty"](spark, str(tmp_path)).first()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tuple(found) == (300, 500, 1, False)


def _shuffles(spark) -> set[str]:
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if "shuffle_" in n and n.endswith(".data")}


def _gone(spark, before: set[str]) -> bool:
    for _ in range(50):
        if not _shuffles(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("y"))
    layout = sources.Layout(root=str(tmp_path))
    before = _shuffles(spark)
    stored = sources.write_table(rows, layout, "silver", "t", ["y"], slices=3, slice_by=["id"])
    assert stored == 5000
    assert _gone(spark, before)
    kept = sources.read_table(spark, layout, "silver", "t", rows.schema)
    assert kept.select("id").distinct().count() == 5000


def test_pages_are_made_without_a_shuffle(spark):
    rows = spark.range(1000).select(F.col("id").alias("a"))
    assert "Exchange" not in landing._paged(rows, 30)._jdf.queryExecution().toString()


def test_a_run_in_slices_stores_the_same_rows(spark, monkeypatch):
    names = (runs.run_conformite_commune, runs.run_evolution_parametres, runs.run_quality_results)
    runs._layouts.clear()
    whole = [sorted(map(repr, made(spark, SMALL).collect())) for made in names]
    monkeypatch.setattr(jobs, "SLICE_ROWS", 1500)
    monkeypatch.setattr(jobs, "SLICE_BYTES", 20_000)
    runs._layouts.clear()
    assert [sorted(map(repr, made(spark, SMALL).collect())) for made in names] == whole
    runs._layouts.clear()


def _small_run(spark) -> None:
    runs._layouts.clear()
    runs.run_of(spark, SMALL)
    runs._layouts.clear()


def test_a_batch_of_documents_goes_before_the_next_is_landed(spark, monkeypatch):
    before, at_once, kept = _staged(spark), [], landing.release

    def counted(path):
        at_once.append(len([p for p in _staged(spark) - before if not p.startswith("run-")]))
        kept(path)

    monkeypatch.setattr(landing, "release", counted)
    monkeypatch.setattr(jobs, "SLICE_ROWS", 3000)
    _small_run(spark)
    assert set(at_once) == {1}
    assert len(at_once) > 3


def test_a_table_goes_once_no_job_reads_it(spark, monkeypatch):
    gone, kept = [], landing.delete_folder

    def noted(session, path):
        layer, _, name = path.partition("/run-")[2].partition("/")[2].partition("/")
        made = {p.name for p in (Path(path.removeprefix("file:")).parents[1] / "silver").glob("*")}
        gone.append((layer, name, len(made)))
        return kept(session, path)

    monkeypatch.setattr(landing, "delete_folder", noted)
    _small_run(spark)
    tables = [(layer, name) for layer, name, _ in gone if name]
    assert tables == [
        ("bronze", "resultats_dis"), ("bronze", "communes_udi"), ("bronze", "geo_communes"),
        ("silver", "stations"), ("silver", "conformite"), ("silver", "mesures"),
    ]
    # Landed results go before any silver table is written.
    assert gone[0][2] == 0


def test_violations_in_slices_of_samples_are_the_same(spark):
    failed = gold.failed_samples(views.samples(spark, SMALL))
    measures, dim = views.measures(spark, SMALL), catalog._dim(spark, SMALL)
    whole = gold.violation_profile(failed, measures, dim, runs.MOMENT)
    with Staging(spark) as stage:
        details = gold.violations_with_measures(failed, measures)
        details = stage(details, "violations", 3, ["code_prelevement"])
        cut = gold.profile_of(details, dim, runs.MOMENT)
        assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))


def test_results_leave_bronze_and_cleaning_year_by_year(spark, monkeypatch):
    steps, drop, write, land = [], Staging.drop, jobs._write, landing.envelopes
    monkeypatch.setattr(Staging, "drop", lambda s, label: (steps.append("drop"), drop(s, label)))

    def deleted(session, layout, layer, name, part):
        steps.append(("part", *part.values()))
        assert sources.layers.delete_partition(session, layout, layer, name, part)

    def written(df, layout, layer, name, **options):
        steps.append(name)
        return write(df, layout, layer, name, **options)

    def landed(rows, *options):
        steps.append("landed")
        return land(rows, *options)

    monkeypatch.setattr(sources, "delete_partition", deleted)
    monkeypatch.setattr(jobs, "_write", written)
    monkeypatch.setattr(landing, "envelopes", landed)
    monkeypatch.setattr(jobs, "SLICE_ROWS", 1500)
    _small_run(spark)
    parts = [s[1] for s in steps if isinstance(s, tuple)]
    assert None in parts and len(parts) == len(set(parts)) > 3
    # A year goes from bronze once cleaned, and from cleaning once it is measures.
    assert steps.index("conformite") > max(k for k, s in enumerate(steps) if isinstance(s, tuple))
    mesures = [k for k, s in enumerate(steps) if s == "mesures"]
    assert len(mesures) >= len(parts) and all(steps[k + 1] == "drop" for k in mesures)
    # A batch of networks is landed when the stations of the one before are made.
    after = [s for s in steps[mesures[-1] :] if s in ("landed", "stations")]
    assert after == ["landed", "stations"] * (len(after) // 2) and len(after) > 2


def test_pages_hold_the_rows_of_a_task_in_order(spark):
    # Pages of 7 rows in batches of 10: pages begin in one batch and end in another.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        pages = landing._paged(spark.range(0, 95, 1, 2).select(F.col("id").alias("a")), 7).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    read = [[r["a"] for r in json.loads(p.data)] for p in pages]
    assert [p.n for p in pages] == [len(r) for r in read] and max(p.n for p in pages) == 7
    assert [a for r in read for a in r] == list(range(95))
    assert len({p.run for p in pages}) == len(pages)


def test_batches_know_their_rows_from_one_query(spark):
    rows = spark.range(1000).select((F.col("id") % 40).alias("k"), "id")
    parts = counted_cut(rows, lambda n: n // 200, ["k"], 8)
    assert len(parts) == 5 and sum(n for _, n in parts) == 1000
    assert [part.count() for part, _ in parts] == [n for _, n in parts]
    assert [n for _, n in counted_cut(rows, lambda n: 1, ["k"], 8)] == [1000]


def test_landed_documents_are_parsed_once(spark, monkeypatch):
    scans, counted = [], []
    lost, land = jobs.rejects, landing.envelopes
    monkeypatch.setattr(jobs, "rejects", lambda *a: (scans.append(lost(*a)), scans[-1])[1])
    monkeypatch.setattr(landing, "envelopes", lambda rows, *a: (counted.append(a), land(rows, *a))[1])
    kept = jobs._write

    def written(df, layout, layer, name, **options):
        if name in ("rejects_communes_udi", "rejects_resultats_dis"):
            assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
        return kept(df, layout, layer, name, **options)

    monkeypatch.setattr(jobs, "_write", written)
    monkeypatch.setattr(jobs, "SLICE_ROWS", 3000)
    _small_run(spark)
    assert len(scans) > 3
    # Batches are landed with their number of rows, which no query of their own counts.
    assert counted and all(a[-1] > 0 for a in counted)


def test_a_large_landing_is_stored_without_a_shuffle(spark, tmp_path, monkeypatch):
    rows = views.results(spark, SMALL).drop("_ingestion_timestamp")
    path = landing.envelopes(rows)
    found = {}
    for size in (1 << 30, 1):
        monkeypatch.setattr(jobs, "SLICE_BYTES", size)
        layout = sources.Layout(root=str(tmp_path / str(size)))
        landed = jobs.Landing({"resultats_dis": path}, {"resultats_dis": "x"}, one_per_file=False)
        n = jobs.bronze(spark, layout, landed, only="resultats_dis", moment=runs.MOMENT)
        table = sources.read_table(
            spark, layout, "bronze", "resultats_dis", schemas.BRONZE["resultats_dis"]
        )
        assert n == {"resultats_dis": rows.count()}
        found[size] = sorted(map(repr, table.collect()))
    assert found[1] == found[1 << 30]
    dealt, write = [], jobs._write
    monkeypatch.setattr(
        jobs, "_write", lambda df, *a, **k: (dealt.append(k.get("rebalance")), write(df, *a, **k))[1]
    )
    jobs.bronze(spark, layout, landed, only="resultats_dis", moment=runs.MOMENT)
    assert dealt[0] is False
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_torn_pages_are_kept_where_records_are_many(spark, tmp_path):
    (tmp_path / "in").mkdir()
    whole = '{"count": 2, "data": [{"code_reseau": "1"}, {"code_reseau": "2"}]}'
    lines = [whole, '{"count": 2, "data": [{"code_', '{"error": "unavailable"}', whole]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    layout = sources.Layout(root=str(tmp_path / "out"))
    landed = jobs.Landing({"communes_udi": str(tmp_path / "in")}, {"communes_udi": "x"}, False)
    assert jobs.bronze(spark, layout, landed, only="communes_udi") == {"communes_udi": 4}
    again = jobs.bronze(spark, layout, landed, only="communes_udi", append=True)
    assert again == {"communes_udi": 8}
    kept = spark.read.parquet(layout.path("bronze", "rejects_communes_udi"))
    assert sorted(r.reason for r in kept.collect()) == ["no data"] * 2 + ["unreadable"] * 2


def test_sources_without_partitions_are_read_by_few_slices(spark, monkeypatch):
    slices, kept, call = {}, jobs._write, Staging.__call__

    def written(df, layout, layer, name, **options):
        slices[name] = options.get("slices")
        return kept(df, layout, layer, name, **options)

    def staged(self, df, label, n=1, by=()):
        slices[label] = n
        return call(self, df, label, n, by)

    monkeypatch.setattr(jobs, "_write", written)
    monkeypatch.setattr(Staging, "__call__", staged)
    monkeypatch.setattr(jobs, "SLICE_ROWS", 1500)
    _small_run(spark)
    assert slices["evolution_parametres"] > 2
    assert slices["conformite"] == 2
    assert slices["violations"] == slices["non_conformites"] == 1
