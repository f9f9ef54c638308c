"""Connected components of a graph whose edges stay distributed."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on edges (u, v) with u > v."""
    ends = edges.select("u", "v")
    both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else ends
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = seen.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes in ``edges`` (a, b); the label is the
    smallest node that can be reached. Alternates large-star and small-star
    steps until the edges are stars; each step is a grouping with map-side
    combine and a join, written to the shared folder."""
    now = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v")
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        now = stage(_star(_star(now, True), False), "stars")
        found = now.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)
        ).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    own = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(own)
