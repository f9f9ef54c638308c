"""Exact duplicates by a tree merge of sorted digest runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import WHITE, refuse_clash, stage, text_or_empty


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fan_in: int = 8,
    keep_columns: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document with the row of its group that stays.

    Texts are equal when they are identical after deleting white space. A
    group is a SHA-256 of the normalised text, verified by an independent
    64-bit hash and the length: rows that differ in either never merge.

    Level 0: each map task sorts its rows by digest and reduces them to a run
    of one row per digest (its best row and count). Rounds: ``fan_in``
    neighbouring nodes send their runs to one node of the next level, which
    merges them and keeps the verified best row per digest, until one node is
    left. A node's run is spread over tasks by digest, so no task ever holds a
    whole run, and a text that a third of the rows share moves as one row per
    node. The last join brings the answer to every row; AQE splits it where a
    digest is hot.

    The row with the most code points stays, then the smallest id (null
    last), then the first read. Null text counts as empty; all empty texts
    are one group. An empty table gives no rows. Rows repeated with their id
    are members like any other, so exactly one row of a group is kept.
    ``keep_columns`` are carried to the result; the names of its own columns
    are refused there.

    Columns: id, keep_id, group_size long, kept boolean, text_sha256 string.
    """
    refuse_clash(keep_columns, (id_col, "keep_id", "group_size", "kept", "text_sha256"))
    text = text_or_empty(text_col)
    bare = F.regexp_replace(text, WHITE + "+", "")
    rows = stage(
        docs.select(
            F.col(id_col).alias("__id"),
            *[F.col(c).alias(f"__keep_{c}") for c in keep_columns],
            (-F.length(text)).alias("__short"),
            F.unhex(F.sha2(bare, 256)).alias("__sha"),
            F.xxhash64(bare).alias("__check"),
            F.octet_length(bare).alias("__bytes"),
            F.spark_partition_id().alias("__node"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "digests",
    )
    best = F.struct(
        "__short", F.col("__id").isNull().alias("__none"), F.col("__id"), F.col("__row")
    )
    key = ["__sha", "__check", "__bytes"]
    runs = rows.select("__node", *key, best.alias("__best"), F.lit(1).cast("long").alias("__n"))
    nodes = (rows.agg(F.max("__node")).first()[0] or 0) + 1
    while True:
        nodes = -(-nodes // fan_in)
        runs = (
            runs.withColumn("__node", F.floor(F.col("__node") / fan_in).cast("int"))
            .groupBy("__node", *key)
            .agg(F.min("__best").alias("__best"), F.sum("__n").alias("__n"))
        )
        if nodes == 1:
            break
    merged = runs.drop("__node")
    return rows.drop("__node").join(merged, key).select(
        F.col("__id").alias(id_col),
        *[F.col(f"__keep_{c}").alias(c) for c in keep_columns],
        F.col("__best.__id").alias("keep_id"),
        F.col("__n").alias("group_size"),
        (F.col("__row") == F.col("__best.__row")).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )
