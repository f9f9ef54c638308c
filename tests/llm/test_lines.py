"""Repeated lines against a plain count of lines."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assayline.llm.common import folder
from assayline.llm.line_dedup import STRIPPED, LineRuns, line_dedup

DOCS = "doc_id long, text string"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, min_chars=20, min_rows=3):
    """(id, n_lines, n_dropped, text) of each row by a plain count."""
    key = lambda line: line.strip(STRIPPED).translate(UPPER)
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(doc_id)
    top = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items() if len(ids) >= min_rows
    }
    made = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == doc_id]
        made.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return made


def shown(rows):
    return sorted(rows, key=repr)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    return shown(tuple(r) for r in line_dedup(df, **options).collect())


def corpus(seed, n=300):
    pick = random.Random(seed)
    common = [f"Shared line number {k} of the corpus, É" for k in range(25)]
    rows = []
    for i in range(n):
        lines = ["The one Line that a third of all documents have"] if i % 3 == 0 else []
        for _ in range(pick.randrange(6)):
            line = pick.choice(common) if pick.random() < 0.6 else f"line of its own {pick.random()}"
            line = line.upper() if pick.random() < 0.2 else line
            lines.append(pick.choice(["", " ", "\t\r", "\x0b"]) + line + pick.choice(["", "\r", "  "]))
            lines += [pick.choice(["", "short", "x" * 19])] * pick.randrange(2)
        pick.shuffle(lines)
        rows.append((i * 7, "\n".join(lines)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_lines_equal_a_plain_count(spark, batches):
    rows = corpus(batches)
    want = plain(rows)
    assert sum(r[2] for r in want) > 100
    assert got(spark, rows, batches=batches) == shown(want)


def test_parameters(spark):
    rows = corpus(11, 120)
    assert got(spark, rows, min_chars=5, min_rows=2, batches=2) == shown(plain(rows, 5, 2))


def test_edge_rows_of_lines(spark):
    line = "a line of more than twenty characters"
    rows = [
        (1, None), (2, ""), (3, "\n"), (4, f"{line}\n{line}\n"), (5, f"\n {line.upper()}\r\n{line}"),
        (6, f"x\n{line}"), (6, f"x\n{line}"), (None, f"{line}\ny"), (None, None),
        (-9, "\n".join([line] * 20_000)), (8, "ÉCOLE " * 5), (9, "école " * 5), (10, "ÉcOLE " * 5),
        (11, " " + line), (12, "\U0001f600" * 20), (13, "\U0001f600" * 20),
        (14, "\U0001f600" * 20), (15, "\U0001f600" * 19), (16, "\U0001f600" * 19),
        (17, "\U0001f600" * 19),
    ]
    assert got(spark, rows) == shown(plain(rows))
    nulls = [(None, line)] * 3 + [(None, f"{line}\nz")]
    assert got(spark, nulls) == shown(plain(nulls))
    assert got(spark, []) == []


def test_long_documents_that_are_copies(spark):
    long = "\n".join(f"line {k} of a long document that has copies" for k in range(30_000))
    rows = [(i, long) for i in range(4)]
    assert [r[:3] for r in got(spark, rows)] == [
        (0, 30_000, 30_000), (1, 30_000, 30_000), (2, 30_000, 30_000), (3, 30_000, 0)
    ]


def test_extra_columns(spark):
    rows = [(i, "a line of more than twenty characters\nend") for i in range(4)]
    names = ("__id", "__h1", "top", "n", "__batch", "kept", "n_lines", "__gone", "__lines")
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in names})
    made = line_dedup(df, keep_columns=("top", "__id"))
    assert made.columns == ["doc_id", "top", "__id", "n_lines", "n_dropped", "text"]
    assert shown(r["text"] for r in made.collect()) == shown(["end"] * 3 + [rows[0][1]])
    with pytest.raises(ValueError):
        line_dedup(df, keep_columns=("n_lines",))


def test_runs_are_levelled_and_settled_lines_are_not_added(spark):
    def batch(rows):
        return spark.createDataFrame(rows, "__h1 long, __h2 long, __id long")

    path = folder(spark, "test-runs")
    runs = LineRuns(spark, path, "test_runs")
    runs.add(batch([(1, 1, i) for i in (90, 91, 92)] + [(2, 2, 93)]))
    runs.add(batch([(1, 1, 80), (2, 2, 81), (2, 3, 82)]))
    assert [level for level, _, _ in runs.names()] == [1]
    again = LineRuns(spark, path, "test_runs")
    again.add(batch([(2, 2, 70), (1, 1, 71), (4, 4, 72)]))
    assert [level for level, _, _ in again.names()] == [1, 0]
    stored = {tuple(r) for _, _, t in again.names() for r in spark.table(t).collect()}
    assert stored == {(1, 1, 3, 92), (2, 2, 2, 93), (2, 3, 1, 82), (2, 2, 1, 70), (4, 4, 1, 72)}
    assert {tuple(r) for r in again.repeated().collect()} == {(1, 1, 92), (2, 2, 93)}
    plan = again._merged([t for _, _, t in again.names()])._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    again.drop()
    assert again.names() == []
