"""Repeated lines, found by levelled sorted runs of line hashes."""

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.common import folder, lower_ascii, refuse_clash, stage, text_or_empty

# What is stripped from both ends of a line, and the shortest key.
STRIPPED = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
KEY = ["__h1", "__h2"]
_RUN = re.compile(r"_l(\d+)_(\d+)$")


class LineRuns:
    """Levelled sorted runs of line hashes in the session's catalog.

    A run holds one row per line hash with the number of rows that have the
    line and the largest id among them. It is a table bucketed and sorted by
    the hash, so runs are joined and merged bucket by bucket without a
    shuffle. Tables are named ``<prefix>_l<level>_<number>`` and lie in
    ``path``; where the catalog lasts, a later session goes on with the runs
    of an earlier one (the same prefix, path and buckets).

    ``add`` takes a batch: its hashes are counted, merge-anti-joined with the
    settled rows of each run (those that ``min_rows`` rows have already, which
    need no more counting), and written as a run of level 0. Two runs of a
    level are compacted to one of the next by a merge join, so there is at most
    one run a level and a line that many rows share stays one row.

    Batches must come in falling order of ids for the largest id of a line to
    be the one that is kept; in another order the line stays in the largest id
    among the batches up to the one that settled it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        prefix: str,
        min_rows: int = 3,
        buckets: int | None = None,
    ):
        self._spark, self._path, self._prefix = spark, path, prefix
        self._min_rows = min_rows
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._number = max((n for _, n, _ in self.names()), default=-1) + 1

    def names(self) -> list[tuple[int, int, str]]:
        """(level, number, table) of each run, from the oldest on."""
        found = []
        for table in self._spark.catalog.listTables(pattern=f"{self._prefix}_l*"):
            parts = _RUN.search(table.name)
            if parts:
                found.append((int(parts.group(1)), int(parts.group(2)), table.name))
        return sorted(found, key=lambda x: x[1])

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (__h1, __h2, __id): one row per row and line."""
        fresh = lines.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("__id").alias("top"))
        for _, _, name in self.names():
            settled = self._spark.table(name).filter(F.col("n") >= self._min_rows)
            fresh = fresh.join(settled.select(*KEY), KEY, "left_anti")
        self._write(fresh, 0)
        level = 0
        while len(pair := [name for k, _, name in self.names() if k == level]) > 1:
            self._write(self._merged(pair), level + 1)
            self._drop(pair)
            level += 1

    def repeated(self) -> DataFrame:
        """(__h1, __h2, top) of the lines that ``min_rows`` rows have."""
        names = [name for _, _, name in self.names()]
        return self._merged(names).filter(F.col("n") >= self._min_rows).drop("n")

    def drop(self) -> None:
        """Forget all runs; their files stay until their folder is deleted."""
        self._drop([name for _, _, name in self.names()])

    def _merged(self, names: list[str]) -> DataFrame:
        # Joined, not united: a union of columnar bucketed scans claims their
        # partitioning in Spark 4.1, but concatenates their partitions.
        merged = self._spark.table(names[-1])
        for name in reversed(names[:-1]):
            run = self._spark.table(name).withColumnsRenamed({"n": "__n", "top": "__top"})
            merged = merged.join(run, KEY, "full").select(
                *KEY,
                (F.coalesce("n", F.lit(0)) + F.coalesce("__n", F.lit(0))).alias("n"),
                F.greatest("top", "__top").alias("top"),
            )
        return merged

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"{self._prefix}_l{level}_{self._number}"
        self._number += 1
        (
            rows.write.bucketBy(self._buckets, *KEY)
            .sortBy(*KEY)
            .option("compression", "zstd")
            .option("path", f"{self._path}/{name}")
            .saveAsTable(name)
        )

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_keys(text: Column, min_chars: int) -> Column:
    """Hashes and positions of the lines that count, sorted by hash."""
    keyed = F.transform(
        F.split(text, "\n", -1),
        lambda line, at: F.struct(at.alias("at"), _lowered(F.trim(line, F.lit(STRIPPED))).alias("key")),
    )
    long = F.filter(keyed, lambda x: F.length(x["key"]) >= min_chars)
    return F.sort_array(
        F.transform(
            long,
            lambda x: F.struct(
                F.xxhash64(x["key"]).alias("__h1"),
                F.xxhash64(F.lit(1), x["key"]).alias("__h2"),
                x["at"].alias("__at"),
            ),
        )
    )


def _lowered(text: Column) -> Column:
    """A-Z lower-cased. Where all characters are ASCII the faster function
    gives the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(lower_ascii(text))


def _batch(docs: DataFrame, batches: int) -> Column:
    """Number of the batch of ``__id``: falling ranges of ids of about the
    same number of rows, null ids last."""
    shares = [k / batches for k in range(batches - 1, 0, -1)]
    cuts = docs.agg(F.percentile_approx("__id", shares, 1000)).first()[0] if shares else []
    number = F.lit(batches - 1)
    for k, cut in reversed(list(enumerate(cuts or []))):
        number = F.when(F.col("__id") > cut, k).otherwise(number)
    return number.cast("int")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_rows: int = 3,
    batches: int = 4,
    keep_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Documents without the lines that other documents repeat.

    A text is split at \\n. A line's key is the line without white space at
    both ends, A-Z lower-cased. A key of at least ``min_chars`` code points
    that at least ``min_rows`` rows hold loses all its lines but those in the
    row with the largest id; other lines stay, joined by \\n.

    1. One scan hashes the lines (two 64-bit hashes, so two keys of a corpus
       of 10^12 lines meet with probability 10^-15) and stages one row per line
       that is long enough, in ``batches`` falling ranges of ids. Texts aren't
       staged.
    2. ``LineRuns`` adds the batches in turn: a merge-anti-join with the runs,
       a run of its own, and a compaction of every ``fan_in`` runs. The first
       batch that holds a line holds its largest id. Counts are combined in the
       map tasks, so a line that a third of all rows share is one row a task.
    3. The repeated keys are joined with the staged lines; a row's positions to
       drop are grouped by its id and the hash of its text.
    4. The documents are joined with those positions (by broadcast where the
       optimizer finds them small, else by a shuffle) and lines are dropped by
       position, in time that grows with the text.

    Null and empty texts are one empty line. Ids are whole numbers; a null id
    is less than any other, and rows whose largest id is null all keep the
    line. Rows are counted, not ids: repeated rows count each, and those that
    share the largest id keep the line each. An empty table gives no rows.
    ``keep_columns`` are carried to the result; the names of its own columns
    are refused there.

    Columns: id, n_lines long (before dropping), n_dropped long, text string.
    """
    refuse_clash(keep_columns, (id_col, "n_lines", "n_dropped", "text"))
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    source = docs.select(
        F.col(id_col).cast("long").alias("__id"),
        text.alias("__text"),
        F.xxhash64(text).alias("__of"),
        *[F.col(c).alias(f"__keep_{c}") for c in keep_columns],
    )
    keys = source.select(
        _batch(source, batches).alias("__batch"), "__id", "__of",
        line_keys(F.col("__text"), min_chars).alias("__keys"),
    ).filter(F.size("__keys") > 0)
    # Sorted by hash, a key's first line is the one whose neighbour differs.
    flagged = F.transform(
        "__keys",
        lambda x, i: F.struct(
            *[x[c].alias(c) for c in (*KEY, "__at")],
            (
                F.get("__keys", i - 1)["__h1"].eqNullSafe(x["__h1"])
                & F.get("__keys", i - 1)["__h2"].eqNullSafe(x["__h2"])
            ).alias("__again"),
        ),
    )
    lines = stage(
        keys.select("__batch", "__id", "__of", F.explode(flagged).alias("__line")).select(
            "__id", "__of", "__line.*", "__batch"
        ),
        "lines",
        by=("__batch",),
    )
    runs = LineRuns(
        spark, folder(spark, "line-runs"), f"lines_{uuid.uuid4().hex}", min_rows
    )
    for k in range(batches):
        runs.add(lines.filter((F.col("__batch") == k) & ~F.col("__again")).select(*KEY, "__id"))
    repeated = stage(runs.repeated(), "repeated-lines")
    runs.drop()
    gone = (
        lines.join(repeated, KEY)
        .filter(~F.col("__id").eqNullSafe(F.col("top")))
        .groupBy(F.col("__id").alias("__gid"), F.col("__of").alias("__gof"))
        .agg(F.collect_set("__at").alias("__gone"))
    )
    same = F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__of") == F.col("__gof"))
    joined = source.join(gone, same, "left").withColumn("__lines", F.split("__text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    rest = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    return joined.select(
        F.col("__id").alias(id_col),
        *[F.col(f"__keep_{c}").alias(c) for c in keep_columns],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(rest).alias("text"),
    )
