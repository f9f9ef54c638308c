import json

import pytest
from conftest import final_plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import schemas, sources
from assayline.sources import Layout
from registry import landing

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def save(folder, **documents):
    folder.mkdir(parents=True, exist_ok=True)
    for name, document in documents.items():
        text = document if isinstance(document, str) else json.dumps(document)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


def test_envelopes(spark, tmp_path):
    path = save(
        tmp_path / "pages",
        a={"count": 3, "next": "p2", "data": [{"id": 1, "name": "é"}, {"id": 2}]},
        b={"count": 3, "next": None, "data": [{"id": 3, "name": "c", "other": 1}]},
    )
    assert rows(sources.read_envelope(spark, path, RECORD)) == [(1, "é"), (2, None), (3, "c")]
    found = sources.page_completeness(spark, path, RECORD).first()
    assert tuple(found) == (2, 3, 3, 0, 1, True)


def test_unknown_shapes_give_no_rows(spark, tmp_path):
    path = save(
        tmp_path / "pages",
        a={"count": 2, "next": "p2", "data": [{"id": 1}]},
        b={"message": "unavailable"},
        c="{not json",
        d={"count": 2, "data": []},
    )
    assert rows(sources.read_envelope(spark, path, RECORD)) == [(1, None)]
    found = sources.page_completeness(spark, path, RECORD).first()
    assert found.n_unreadable == 2 and found.n_records == 1 and not found.is_complete


def test_arrays_and_records(spark, tmp_path):
    path = save(tmp_path / "lists", a=[{"id": 1, "name": "x"}, {"id": 2}], b=[])
    assert rows(sources.read_json_array(spark, path, RECORD)) == [(1, "x"), (2, None)]
    lines = save(tmp_path / "lines", a='{"id": 1, "name": "x"}\n{"id": 2}\n')
    assert rows(sources.read_json_records(spark, lines, RECORD)) == [(1, "x"), (2, None)]
    empty = sources.read_json_records(spark, save(tmp_path / "none", a=""), RECORD)
    assert empty.columns == ["id", "name"] and empty.count() == 0


def feature(code, name, point="none"):
    geometry = None if point == "none" else {"type": "Point", "coordinates": point}
    return {"type": "Feature", "properties": {"nom": name, "code": code, "codesPostaux": ["64900"]},
            "geometry": geometry}


def test_geojson(spark, tmp_path):
    path = save(
        tmp_path / "geo",
        a={"features": [feature("64945", "Tourne", [-0.3708, 43.2951]), feature("1", "x"),
                        feature("2", "y", []), feature("3", "z", [1.5])]},
    )
    got = sources.read_geojson(spark, path, schemas.RAW_PLACES)
    assert rows(got.select("code", "nom", "longitude", "latitude")) == [
        ("1", "x", None, None), ("2", "y", None, None), ("3", "z", 1.5, None),
        ("64945", "Tourne", -0.3708, 43.2951),
    ]


def test_department_codes(spark):
    df = spark.createDataFrame([("64",), ("01",), ("64",), ("2A",), (None,)], "code string")
    assert [r.code for r in sources.department_codes(df).collect()] == ["01", "2A", "64"]


def test_landed_pages_are_bounded(spark):
    df = spark.range(0, 1000, 1, 3).select(F.lit("hot").alias("name"), "id")
    path = landing.envelopes(df, page_size=100)
    docs = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert max(len(d["data"]) for d in docs) <= 100
    schema = T.StructType([RECORD["name"], RECORD["id"]])
    assert sources.read_envelope(spark, path, schema, one_per_file=False).count() == 1000


def table(spark):
    data = [("a", 2024, "01"), ("b", 2024, "2A"), ("c", 2025, "64"), ("d", 2025, None)]
    return spark.createDataFrame(data, "k string, y int, dep string")


def test_path_tables_keep_codes_as_text(spark, tmp_path):
    df, layout = table(spark), Layout(root=str(tmp_path))
    assert sources.write_table(df, layout, "silver", "t", ["y", "dep", "absent"]) == 4
    back = sources.read_table(spark, layout, "silver", "t", df.schema)
    assert rows(back) == rows(df)
    pruned = back.filter("y = 2024 and dep = '01'")
    assert rows(pruned) == [("a", 2024, "01")]
    assert "PartitionFilters: [isnotnull(y" in final_plan(pruned)
    again = sources.write_table(df.limit(0), layout, "silver", "t", skip_if_empty=True)
    assert again == 0 and sources.read_table(spark, layout, "silver", "t", df.schema).count() == 4


def test_partitions_are_rebalanced_before_the_write(spark, tmp_path):
    hot = spark.range(0, 4000, 1, 8).select("id", F.lit("01").alias("dep"))
    layout = Layout(root=str(tmp_path))
    sources.write_table(hot, layout, "silver", "hot", ["dep"])
    # Eight tasks would leave eight files; rebalanced rows share one.
    assert len(list((tmp_path / "silver" / "hot").rglob("*.parquet"))) < 8


def test_few_files(spark, tmp_path):
    layout = Layout(root=str(tmp_path))
    sources.write_table(spark.range(0, 100, 1, 8), layout, "bronze", "small", few_files=True)
    assert len(list((tmp_path / "bronze" / "small").glob("*.parquet"))) == 1


def test_catalog_tables(spark):
    layout = Layout(namespaces={"silver": "s`odd"})
    assert sources.fq_table(layout, "silver", "t") == "`s``odd`.`t`"
    named = Layout(namespaces={"silver": "silver_ns"})
    sources.ensure_namespace(spark, named, "silver")
    df = table(spark)
    assert sources.write_table(df, named, "silver", "t", ["y"]) == 4
    assert rows(sources.read_table(spark, named, "silver", "t", df.schema)) == rows(df)
    spark.sql("USE default")
    spark.sql("DROP SCHEMA silver_ns CASCADE")
    sources.ensure_namespace(spark, Layout(root="/nowhere"), "silver")


def test_external_tables_and_views(spark, tmp_path):
    df, layout = table(spark), Layout(root=str(tmp_path))
    sources.write_table(df, layout, "gold", "t", ["y"])
    sources.register_external(spark, "`ext_t`", layout.path("gold", "t"))
    assert spark.table("ext_t").count() == 4
    assert sources.register_views(spark, layout, "gold", {"t": df.schema}, "gold_") == ["gold_t"]
    got = spark.sql("SELECT k FROM gold_t WHERE dep = :dep", args={"dep": "01"})
    assert rows(got) == [("a",)]
    spark.sql("DROP TABLE ext_t")


def test_staging_follows_the_named_folder(spark, tmp_path):
    root = sources.staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    kept = sources.staged(spark.range(5), "r")
    assert kept.count() == 5 and all(f.startswith("file:" + root) or root in f for f in kept.inputFiles())
    with sources.Staging(spark) as stage:
        part = stage(spark.range(7), "part")
        assert part.count() == 7
        files = part.inputFiles()
    import os

    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_table(spark, Layout(root=str(tmp_path)), "gold", "none")


# Documents that can't be read, drift, chains of pages ------------------------------------


TORN = {
    "records": ('{"id": 1, "name": "x"}\n{"id": 2, "na', '{"id": 3}'),
    "array": ('[{"id": 1}, {"id": 2, "na', [{"id": 3}]),
    "envelope": ('{"count": 1, "data": [{"id": 1}', {"count": 1, "next": None, "data": [{"id": 3}]}),
    "geojson": ('{"features": [{"properties": {"id": 1}}, {"pro', {"features": [{"properties": {"id": 3}}]}),
}


def read_shape(spark, path, shape):
    reader = {
        "records": sources.read_json_records, "array": sources.read_json_array,
        "envelope": sources.read_envelope, "geojson": sources.read_geojson,
    }[shape]
    return reader(spark, path, RECORD)


@pytest.mark.parametrize("shape", TORN)
def test_torn_documents_of_every_shape_are_listed(spark, tmp_path, shape):
    torn, good = TORN[shape]
    path = save(tmp_path / shape, torn=torn, good=good, number="7", word='"text"', empty="")
    want = [1, 3] if shape == "records" else [3]
    assert sorted(r.id for r in read_shape(spark, path, shape).select("id").collect()) == want
    assert read_shape(spark, path, shape).count() == len(want)
    lost = sources.rejects(spark, path, RECORD, shape).collect()
    names = sorted((r._source_file.rsplit("/", 1)[1], r.reason) for r in lost)
    assert names == [(f"{n}.json", "unreadable") for n in ("number", "torn", "word")]
    assert all(r.document for r in lost)
    ledger = {
        r._source_file.rsplit("/", 1)[1]: (r.n_records, r.n_unreadable)
        for r in sources.landing_ledger(spark, path, RECORD, shape).collect()
    }
    assert ledger["torn.json"] == ((1, 1) if shape == "records" else (0, 1))
    assert ledger["good.json"] == (1, 0)


@pytest.mark.parametrize("shape", TORN)
def test_a_value_of_another_type_loses_no_record(spark, tmp_path, shape):
    odd = {"id": "no number", "name": "kept"}
    document = {
        "records": json.dumps(odd), "array": [odd], "envelope": {"data": [odd]},
        "geojson": {"features": [{"properties": odd}]},
    }[shape]
    path = save(tmp_path / shape, odd=document)
    got = [(r.id, r.name) for r in read_shape(spark, path, shape).collect()]
    assert got == [(None, "kept")]
    assert sources.rejects(spark, path, RECORD, shape).count() == 0
    assert sources.landing_ledger(spark, path, RECORD, shape).first().n_partial == 1


def test_unknown_shapes_are_refused(spark, tmp_path):
    path = save(tmp_path / "x", a="{}")
    for call in (sources.rejects, sources.landing_ledger, sources.schema_drift):
        with pytest.raises(ValueError, match="shape"):
            call(spark, path, RECORD, "csv")


NESTED = T.StructType(
    [*RECORD, T.StructField("parts", T.ArrayType(T.StructType([T.StructField("code", T.StringType())])))]
)


@pytest.mark.parametrize("shape", TORN)
def test_drift_of_every_shape(spark, tmp_path, shape):
    records = [
        {"id": 1, "name": None, "parts": [{"code": "a"}, {"code": 2, "more": True}]},
        {"id": "x", "extra": 1.5, "parts": []},
        {"id": None, "extra": {"deep": 1}},
    ]
    document = {
        "records": "\n".join(map(json.dumps, records)) + '\n{"torn', "array": records,
        "envelope": {"data": records},
        "geojson": {"features": [{"properties": r} for r in records]},
    }[shape]
    path = save(tmp_path / shape, a=document)
    found = sources.schema_drift(spark, path, NESTED, shape, depth=3).collect()
    got = {r.field: (r.found, r.n_values, r.n_nulls, r.n_odd, r.status) for r in found}
    assert got == {
        "id": ("null,text,whole", 3, 1, 1, "retyped"),
        "name": ("null", 1, 1, 0, "empty"),
        "parts": ("list", 2, 0, 0, "as declared"),
        "parts[]": ("object", 2, 0, 0, "as declared"),
        "parts[].code": ("text,whole", 2, 0, 1, "retyped"),
        "parts[].more": ("boolean", 1, 0, 0, "unknown"),
        "extra": ("number,object", 2, 0, 0, "unknown"),
        "extra.deep": ("whole", 1, 0, 0, "unknown"),
    }
    nothing = sources.schema_drift(spark, save(tmp_path / "none", a=""), RECORD, shape).collect()
    assert {(r.field, r.status) for r in nothing} == {("id", "missing"), ("name", "missing")}


def test_drift_is_counted_in_the_map_tasks(spark, tmp_path):
    path = save(tmp_path / "x", a='{"id": 1}')
    plan = final_plan(sources.field_profile(spark, path))
    assert plan.count("HashAggregate") >= 2 and "Python" not in plan


def onward(n):
    return None if n is None else f"https://example.org/api?size=2&page={n}"


def chain(folder, **following):
    return save(folder, **{k: {"count": 9, "next": onward(n), "data": []} for k, n in following.items()})


def test_lost_pages_are_named(spark, tmp_path):
    chain(tmp_path / "a", p1=2, p2=3, p5=6, p6=7, p7=None)
    chain(tmp_path / "b", p3=4, again=4)
    chain(tmp_path / "c", p1=2, p2=3, p3=4)
    chain(tmp_path / "d", p1=2, p2=None)
    chain(tmp_path / "e", only=None)
    save(tmp_path / "e", torn='{"count": 1')
    path = str(tmp_path / "*")
    gaps = [(r.folder[-1], r.first_lost, r.last_lost) for r in sources.page_gaps(spark, path).collect()]
    assert sorted(gaps) == [("a", 3, 4), ("b", 1, 2)]
    found = {r.folder[-1]: tuple(r)[1:] for r in sources.page_chains(spark, path, 3).collect()}
    assert found == {
        "a": (7, 2, "gaps"), "b": (3, 2, "gaps"), "c": (3, 0, "ceiling"),
        "d": (2, 0, "complete"), "e": (1, 0, "complete"),
    }
    later = {r.folder[-1]: r.status for r in sources.page_chains(spark, path, 4).collect()}
    assert later["c"] == "unfinished"
