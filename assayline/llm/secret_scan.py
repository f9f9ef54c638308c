"""Secret scans with an incremental ledger of text blobs."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import stage

LEDGER = "blob binary, rule string, version int, spans array<struct<start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``hints``: text without any of these (letters in
    either case) has no match. ``least`` is the length of ``group`` below
    which a match is dropped."""

    kind: str
    version: int
    pattern: str
    hints: tuple[str, ...] = ()
    group: int = 0
    least: int = 0


# The base rules, in their order.
BASE = (
    Rule(
        "assign",
        1,
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        ("password", "passwd", "secret", "token", "key"),
        group=2,
        least=12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", ("akia",), least=18),
    Rule("hex", 1, r"[0-9a-f]+", least=16),
)
# Formats that name their own kind.
MORE = (
    Rule("private", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("private key",)),
    Rule("github", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", ("gh",)),
    Rule("slack", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
    Rule("google", 1, r"\bAIza[A-Za-z0-9_-]{35}", ("aiza",)),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyj",)),
)
RULES = BASE + MORE


def compiled(rule: Rule) -> re.Pattern[str]:
    # ASCII: letters in either case are those of A-Z alone.
    pattern = rule.pattern
    if rule.kind == "hex":
        # The same matches: maximal runs that are long enough.
        pattern = r"[0-9a-f]{%d,}" % rule.least
    return re.compile(pattern, re.ASCII)


def spans_of(text: str, folded: str, rule: Rule, pattern: re.Pattern[str]) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; short ones use up their text but
    are dropped."""
    if rule.hints and not any(h in folded for h in rule.hints):
        return []
    return [
        m.span()
        for m in pattern.finditer(text)
        if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


_FINDINGS = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("rule", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
                )
            ),
        ),
    ]
)
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = {r.kind: (r, compiled(r)) for r in rules}
        for batch in batches:
            blobs, kinds, versions, found = [], [], [], []
            texts, todo = batch.column("__text"), batch.column("__todo")
            for blob, text, wanted in zip(batch.column("blob"), texts, todo, strict=True):
                text = text.as_py()
                folded = text.lower()
                for kind in wanted.as_py():
                    rule, pattern = patterns[kind]
                    blobs.append(blob.as_py())
                    kinds.append(kind)
                    versions.append(rule.version)
                    found.append(
                        [
                            {"start": a, "end": b}
                            for a, b in spans_of(text, folded, rule, pattern)
                        ]
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(blobs, pa.binary()),
                    pa.array(kinds, pa.string()),
                    pa.array(versions, pa.int32()),
                    pa.array(found, _ARROW_SPANS),
                ],
                ["blob", "rule", "version", "spans"],
            )

    return run


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The ledger at ``path``, or None where nothing was written yet."""
    if path is None:
        return None
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not folder.getFileSystem(conf).exists(folder):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    ledger_path: str | None = None,
) -> DataFrame:
    """Secrets of every document, each text scanned once per rule version.

    A text is addressed by its SHA-256 (its blob). The ledger has one row per
    blob and rule version that was scanned, with or without findings. Only
    pairs that it doesn't have are scanned, on one copy of each blob; their
    rows are appended to the ledger at ``ledger_path`` (kept between runs;
    without a path the run has a ledger of its own). Findings are joined back
    to all documents with the blob, so a version of a document that comes back
    later costs no scan.

    Copies are reduced to one row per blob and map task before anything
    moves; of the texts, one of each unseen blob is shuffled. The join back
    carries digests and spans only; AQE splits it where a blob is hot. Scans
    are appended, so a run that is repeated after a failure rescans what was
    not written and repeated rows of the ledger count once.

    Null text counts as empty and has no spans. A null id is allowed;
    repeated rows are reported one by one; an empty table gives no rows.

    Columns: id, blob (hexadecimal), spans array<struct<start, kind_no, kind,
    end>> sorted by start, then the order of ``rules``; code points, end
    exclusive.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    paths = docs.select(
        F.col(id_col).alias("__id"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("__text")
    )
    addressed = stage(paths.drop("__text"), "blob-paths")
    blobs = addressed.groupBy("blob").agg(F.min("__id").alias("__first"))
    versions = F.array(
        *[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules]
    )
    known = read_ledger(spark, ledger_path)
    wanted = blobs.withColumn("__todo", F.array(*[F.lit(r.kind) for r in rules]))
    if known is not None:
        seen = known.groupBy("blob").agg(
            F.collect_set(F.struct("rule", "version")).alias("__seen")
        )
        left = F.array_except(versions, F.coalesce("__seen", F.array().cast(seen.schema["__seen"].dataType)))
        wanted = (
            blobs.join(seen, "blob", "left")
            .withColumn("__todo", F.transform(left, lambda x: x["rule"]))
            .filter(F.size("__todo") > 0)
            .drop("__seen")
        )
    unseen = stage(wanted, "blob-unseen")
    # One copy of each blob: the row of its smallest id.
    copy = paths.withColumnRenamed("blob", "__blob").join(
        unseen, (F.col("__blob") == F.col("blob")) & F.col("__id").eqNullSafe(F.col("__first"))
    )
    scanned = copy.select("blob", "__text", "__todo").mapInArrow(_scan(rules), _FINDINGS)
    if ledger_path is None:
        ledger = stage(scanned, "blob-ledger")
    else:
        scanned.write.mode("append").parquet(ledger_path)
        ledger = spark.read.schema(LEDGER).parquet(ledger_path)
    current = F.map_from_entries(versions)[F.col("rule")] == F.col("version")
    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule"))
    hits = (
        ledger.filter(current & (F.size("spans") > 0))
        .select("blob", "rule", order.cast("int").alias("__no"), F.explode("spans").alias("__span"))
        .select("blob", "rule", "__no", "__span.start", "__span.end")
        .distinct()
        .groupBy("blob")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "start", F.col("__no").alias("kind_no"), F.col("rule").alias("kind"), "end"
                    )
                )
            ).alias("spans")
        )
    )
    none = F.array().cast(hits.schema["spans"].dataType)
    return addressed.join(hits, "blob", "left").select(
        F.col("__id").alias(id_col),
        F.lower(F.hex("blob")).alias("blob"),
        F.coalesce("spans", none).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
