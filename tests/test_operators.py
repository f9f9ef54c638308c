import random

from conftest import final_plan, plan_of
from pyspark.sql import functions as F

from assayline import operators as op


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_latest_per_key(spark):
    data = [("a", 1, 5, "x"), ("a", 2, 6, "y"), ("a", 2, 6, "b"), (None, 1, 1, "n"),
            (None, None, 2, "m"), ("c", None, 1, "q")]
    df = spark.createDataFrame(data, "k string, t int, v int, w string")
    got = rows(op.latest_per_key(df, ["k"], ["t"]))
    assert got == sorted([("a", 2, 6, "b"), (None, 1, 1, "n"), ("c", None, 1, "q")], key=repr)
    again = op.latest_per_key(op.latest_per_key(df, ["k"], ["t"]), ["k"], ["t"])
    assert rows(again) == got
    for n in (1, 7, 17):
        assert rows(op.latest_per_key(df.repartition(n), ["k"], ["t"])) == got


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = op.latest_per_key(df.repartition(4), ["k"], ["v"])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", None), ("b", 3)], "k string, v int")
    assert rows(op.first_per_key(df, ["k"])) == [("a", None), ("b", 3)]
    only_key = df.select("k")
    assert rows(op.first_per_key(only_key, ["k"])) == [("a",), ("b",)]


def test_hot_key_matches_a_plain_scan(spark):
    random.seed(3)
    data = [("hot" if random.random() < 0.4 else f"k{i % 50}", random.randint(0, 9), i)
            for i in range(3000)]
    best = {}
    for k, t, v in data:
        if k not in best or (-t, v) < best[k]:
            best[k] = (-t, v)
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(11)
    got = {r.k: (-r.t, r.v) for r in op.latest_per_key(df, ["k"], ["t"]).collect()}
    assert got == best


def test_handle_missing(spark):
    df = spark.createDataFrame(
        [("t1", "64901", "P1", 1.2, None, None), ("t2", "64902", "P2", None, "mg/L", "EAU64"),
         ("t3", None, "P3", 3.4, "mg/L", "EAU64")],
        "ts string, place string, parameter string, value double, unit string, owner string",
    )
    got = op.handle_missing(
        df, ["ts", "place", "parameter"], {"unit": "INCONNUE", "owner": "INCONNU"},
        ("missing", "value"),
    )
    assert rows(got.select("parameter", "unit", "owner", "missing")) == [
        ("P1", "INCONNUE", "INCONNU", False), ("P2", "mg/L", "EAU64", True),
    ]


def test_iqr_outliers(spark):
    groups = {
        "flat": [5.0] * 9 + [5.1],
        "alone": [3.0],
        "none": [None, None],
        "edge": [1.0, 2.0, 3.0, 4.0, 10.0, -5.0, 10.1],
        None: [1.0, 1000.0],
    }
    data = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "k string, v double")
    got = op.flag_iqr_outliers(df, "v", "k")
    assert got.columns == ["k", "v", "is_outlier"] and got.count() == len(data)
    flagged = rows(got.filter("is_outlier").select("k", "v"))
    # flat: no spread, so any other value is outside.
    assert ("flat", 5.1) in flagged and ("flat", 5.0) not in flagged
    assert got.filter("is_outlier is null").count() == 0
    assert not [k for k, _ in flagged if k in (None, "alone", "none")]


def test_iqr_bound_itself_is_inside(spark):
    # quartiles 2 and 4, so the bounds are -4 and 10.
    values = [2.0, 2.0, 3.0, 4.0, 4.0, 4.0, 2.0, 10.0, 10.000001, -4.0]
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    q = df.agg(F.percentile_approx("v", [0.25, 0.75])).first()[0]
    assert q == [2.0, 4.0]
    flagged = op.flag_iqr_outliers(df, "v", "k").filter("is_outlier")
    assert [r.v for r in flagged.collect()] == [10.000001]


def test_small_bounds_are_broadcast_by_their_size(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).cast("string").alias("k"), F.col("id").cast("double").alias("v")
    )
    assert "BroadcastHashJoin" in final_plan(op.flag_iqr_outliers(df, "v", "k"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set(adaptive, "-1")
        assert "SortMergeJoin" in final_plan(op.flag_iqr_outliers(df, "v", "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.unset(adaptive)


def test_expand_codes(spark):
    texts = spark.createDataFrame(
        [(1, "64"), (2, "64, 69,"), (3, None), (4, "  "), (5, "2A")], "i int, c string"
    )
    assert rows(op.expand_codes(texts, "c").select("i", "code")) == [
        (1, "64"), (2, "64"), (2, "69"), (5, "2A"),
    ]
    numbers = spark.createDataFrame([(1,), (64,), (971,), (None,)], "c int")
    assert rows(op.expand_codes(numbers, "c").select("code")) == [("01",), ("64",), ("971",)]
    lists = spark.createDataFrame([(["64", "69,33"],), (None,), ([],)], "c array<string>")
    assert rows(op.expand_codes(lists, "c").select("code")) == [("33",), ("64",), ("69",)]
    ids = spark.createDataFrame([([1, None, 64],)], "c array<int>")
    assert rows(op.expand_codes(ids, "c").select("code")) == [("01",), ("64",)]


def test_nested_to_json(spark):
    df = spark.createDataFrame(
        [([("a", "é")], "x", 5), (None, None, None)],
        "n array<struct<code:string,nom:string>>, s string, i int",
    )
    got = rows(op.nested_to_json(df, ["n", "s", "i", "absent"]))
    assert got == [('[{"code":"a","nom":"é"}]', "x", "5"), (None, None, None)]


def test_ranking(spark):
    data = [("TOURNE", 100.0, 10), ("ARVELLE", 60.0, 10), ("MONTSAC", 20.0, 10), ("NUL", None, 99)]
    df = spark.createDataFrame(data, "name string, rate double, total int")

    def ranked(frame, k):
        got = op.best_worst_k(frame, "rate", "total", "name", k, ("B", "W"))
        return rows(got.select("classement_type", "rang", "name"))

    assert ranked(df, 2) == [
        ("B", 1, "TOURNE"), ("B", 2, "ARVELLE"), ("W", 1, "MONTSAC"), ("W", 2, "ARVELLE"),
    ]
    assert ("B", 4, "NUL") in ranked(df, 10) and ("W", 4, "NUL") in ranked(df, 10)
    assert ranked(df.repartition(1), 3) == ranked(df.repartition(17), 3)
    ties = spark.createDataFrame(
        [("b", 5.0, 1), ("a", 5.0, 1), ("c", 5.0, 2)], "name string, rate double, total int"
    )
    assert [n for _, r, n in ranked(ties, 3)[:3]] == ["c", "a", "b"]
    assert "TakeOrderedAndProject" in plan_of(
        op.best_worst_k(df, "rate", "total", "name", 2, ("B", "W"))
    )


def test_filters(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 2, None), ("c", 2, 9.0)],
                               "k string, y int, r double")
    assert op.apply_filters(df, [("y", "=", None)]).count() == 3
    assert rows(op.apply_filters(df, [("y", "=", 2), ("r", ">=", 9.0)]).select("k")) == [("c",)]

    offered = df.filter("y = 2").select("k")
    names = lambda *a, **k: [r[0] for r in rows(op.filter_members(df, "k", *a, **k).select("k"))]
    assert names(None) == names([]) == ["a", "b", "c"]
    assert names(["a", "zz"]) == ["a"]
    assert names(["a", "b"], offered) == ["b"]
    assert names(["a"], offered) == ["a", "b", "c"]
    long = spark.createDataFrame([("a",), ("c",), (None,)], "m string")
    assert names(long) == ["a", "c"]
    assert names(long, offered) == ["c"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None), (2, "x")], "a int, b string")
    assert rows(op.null_profile(df, ["a", "b", "absent"])) == [
        ("a", 4, 1, 25.0, True), ("b", 4, 2, 50.0, True),
    ]
    assert op.null_profile(df.limit(0), ["a"]).first()[1:] == (0, 0, 0.0, False)
    assert [tuple(r) for r in op.group_counts(df, ["a"]).collect()] == [(None, 1), (1, 1), (2, 2)]
    assert [tuple(r) for r in op.distinct_values(df, ["a"]).collect()] == [(1,), (2,)]
    flags = df.select("b", (F.col("a") == 2).alias("f"))
    assert [tuple(r) for r in op.top_labels(flags, "b", "f").collect()] == [("x", 2)]
