"""Dealing documents into bounded shards by what they say."""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import give_back, sampled, stage

# Words are hashed into so many slots. A tree of centroids has up to LEAVES
# leaves, BRANCH to a node, fitted on at most SAMPLE documents. A leaf is cut
# into BUCKETS where a shard can't hold it.
SLOTS, LEAVES, BRANCH, BUCKETS = 1 << 12, 4096, 8, 32
SAMPLE, ROUNDS = 20_000, 8


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Slots of the distinct words, how often each occurs, and a bucket: a
    MinHash of the words, equal for most near copies."""
    found = list(map(crc32, text.encode("utf-8", "surrogatepass").lower().split()))
    if not found:
        return np.empty(0, np.int64), np.empty(0), 0
    words, times = np.unique(np.array(found, np.int64), return_counts=True)
    least = int((words * 2_654_435_761 % (1 << 32)).min())
    return words % SLOTS, times.astype(float), (least * 2_246_822_519 % (1 << 32)) * BUCKETS >> 32


class Tree:
    """Centroids of spherical k-means, node by node. ``nodes`` holds a matrix
    (slot, child) and the children: nodes, or leaves as -1 - leaf."""

    def __init__(self, idf: np.ndarray):
        self.idf = idf
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaves = 0

    def weights(self, slots: np.ndarray, times: np.ndarray) -> np.ndarray:
        found = self.idf[slots] * times / (times + 1)
        return (found / max(1e-9, float(np.sqrt((found**2).sum())))).astype(np.float32)

    def leaf(self, slots: np.ndarray, times: np.ndarray) -> int:
        at, weights = 0, self.weights(slots, times)
        while at >= 0:
            centroids, children = self.nodes[at]
            at = children[int((weights @ centroids[slots]).argmax())]
        return -1 - at


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], leaves: int) -> Tree:
    """Tree on (slots, times, bytes) of sampled documents. A child gets leaves
    by its share of the bytes."""
    df = np.zeros(SLOTS)
    for slots, _, _ in rows:
        df[np.unique(slots)] += 1
    tree = Tree(np.log1p((len(rows) - df + 0.5) / (df + 0.5)))
    vectors = [(slots, tree.weights(slots, times)) for slots, times, _ in rows]
    sizes = np.array([size for *_, size in rows], float)

    def closest(members, centroids):
        return np.array([(w @ centroids[s]).argmax() for s, w in (vectors[m] for m in members)], np.int64)

    def grow(members: np.ndarray, leaves: int) -> int:
        k = min(BRANCH, leaves, len(members))
        if k < 2:
            tree.leaves += 1
            return -tree.leaves
        picked = members[np.linspace(0, len(members) - 1, k).astype(int)]
        centroids = np.zeros((SLOTS, k), np.float32)
        for c, m in enumerate(picked):
            np.add.at(centroids[:, c], *vectors[m])
        for _ in range(ROUNDS):
            centroids /= np.maximum(1e-9, np.sqrt((centroids**2).sum(0)))
            at = closest(members, centroids)
            moved = np.zeros_like(centroids)
            for m, c in zip(members, at, strict=True):
                np.add.at(moved[:, c], *vectors[m])
            empty = ~moved.any(0)
            moved[:, empty] = centroids[:, empty]
            centroids = moved
        centroids /= np.maximum(1e-9, np.sqrt((centroids**2).sum(0)))
        centroids = centroids.astype(np.float16)
        # Children without a document go; a leaf is what can't be told apart.
        mass = np.bincount(closest(members, centroids.astype(np.float32)), sizes[members], minlength=k)
        centroids = centroids[:, mass > 0]
        k = centroids.shape[1]
        if k < 2:
            tree.leaves += 1
            return -tree.leaves
        at = closest(members, centroids.astype(np.float32))
        mass = np.bincount(at, sizes[members], minlength=k)
        share = np.maximum(1, (leaves * mass / max(1.0, mass.sum())).round().astype(int))
        share[mass.argmax()] = max(1, leaves - share.sum() + share[mass.argmax()])
        here = len(tree.nodes)
        children: list[int] = []
        tree.nodes.append((centroids, children))
        children.extend(grow(members[at == c], int(share[c])) for c in range(k))
        return here

    if grow(np.arange(len(rows)), leaves) < 0:
        tree.nodes = [(np.zeros((SLOTS, 1), np.float16), [-1])]
    return tree


def shards_of(sizes: dict[tuple[int, int], int], shard_bytes: int) -> list[tuple[int, int, int, int]]:
    """(leaf, bucket, first shard, shards) of each group of a leaf and bucket
    with its bytes. Leaves share a shard while they fit, and a leaf that
    doesn't fit is cut at buckets; only a larger bucket is dealt by hash."""
    leaves: dict[int, list[tuple[int, int]]] = {}
    for (leaf, bucket), size in sorted(sizes.items()):
        leaves.setdefault(leaf, []).append((bucket, size))
    out, shard, filled = [], 0, 0
    for leaf, groups in leaves.items():
        total = sum(size for _, size in groups)
        if filled and filled + total > shard_bytes:
            shard, filled = shard + 1, 0
        # Parts of about equal size, where there are several.
        part = total / -(-total // shard_bytes)
        for bucket, size in groups:
            if filled and filled + size > shard_bytes or filled >= part and total > shard_bytes:
                shard, filled = shard + 1, 0
            span = max(1, -(-size // shard_bytes))
            out.append((leaf, bucket, shard, span))
            if span > 1:
                shard, filled = shard + span, 0
            else:
                filled += size
    return out


_SAMPLED = T.StructType(
    [
        T.StructField("slots", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
        T.StructField("size", T.LongType()),
    ]
)


def _sampled_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(*words_of(t)[:2], len(t)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([s.astype("<u2").tobytes() for s, *_ in rows], pa.binary()),
                pa.array([t.astype("<u4").tobytes() for _, t, _ in rows], pa.binary()),
                pa.array([n for *_, n in rows], pa.int64()),
            ],
            _SAMPLED.names,
        )


def _placed(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree.nodes = [(c.astype(np.float32), children) for c, children in tree.nodes]
        for batch in batches:
            leaves, buckets = [], []
            for text in batch.column("__text").to_pylist():
                slots, times, bucket = words_of(text)
                leaves.append(tree.leaf(slots, times))
                buckets.append(bucket)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.int32()), pa.array(buckets, pa.int32())],
                [*batch.schema.names, "__leaf", "__bucket"],
            )

    return run


def deal(docs: DataFrame, total_rows: int, total_bytes: int, shard_bytes: int) -> DataFrame:
    """``docs`` (``__id``, ``__text``, ``__hash``) with ``__shard``: documents
    of like words share a shard of about ``shard_bytes`` of text."""
    shards = max(1, -(-total_bytes // shard_bytes))
    if shards == 1:
        return docs.withColumn("__shard", F.lit(0).cast("long"))
    spark = docs.sparkSession
    leaves = min(LEAVES, shards)
    sample = sampled(docs.select("__text", "__hash"), "__hash", SAMPLE, total_rows).select("__text")
    rows = [
        (np.frombuffer(r.slots, "<u2"), np.frombuffer(r.times, "<u4"), r.size)
        for r in sample.mapInArrow(_sampled_words, _SAMPLED).collect()
    ]
    rows.sort(key=lambda r: (r[0].tobytes(), r[1].tobytes(), r[2]))
    kinds = T.StructType(
        [*docs.schema.fields, T.StructField("__leaf", T.IntegerType()), T.StructField("__bucket", T.IntegerType())]
    )
    tree = fit(rows, leaves)
    del rows
    give_back()
    placed = stage(docs.mapInArrow(_placed(tree), kinds), "dealt")
    sizes = placed.groupBy("__leaf", "__bucket").agg(F.sum(F.octet_length("__text") + 8).alias("size"))
    found = {(r["__leaf"], r["__bucket"]): r["size"] for r in sizes.collect()}
    table = pd.DataFrame(shards_of(found, shard_bytes), columns=["__leaf", "__bucket", "__first", "__span"])
    groups = spark.createDataFrame(
        table, "__leaf int, __bucket int, __first long, __span long"
    )
    shard = F.col("__first") + F.pmod("__hash", "__span")
    return placed.join(groups, ["__leaf", "__bucket"]).select(
        "__id", "__text", "__hash", shard.cast("long").alias("__shard")
    )
