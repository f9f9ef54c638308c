"""Near duplicates: banded MinHash candidates, odd sketches, exact confirmation."""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import stage
from assayline.llm.graph import components

# 36 bands of 5: a pair at similarity 0.8 shares no band with probability
# 6e-7, and one at 0.3 shares a band with probability 0.08.
BANDS, ROWS = 36, 5
# MinHash samples of a document (its smallest hashes) and bits they fold into.
SAMPLES, BITS = 1024, 2048
# Members of a bucket that are compared in one task.
BLOCK = 1024
# Standard deviations that count as certain.
SIGMAS = 5.0
REMEMBERED = 400_000
SIGNED = ("__n", "__digest", "__sketch", "__bands")

_rng = np.random.default_rng(20)
XORS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
FACTORS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_MIX = _rng.integers(0, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


def words_of(text: str) -> list[bytes]:
    """Words after lower-casing A-Z; bytes methods know only ASCII here."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    grams = len(words) - width + 1
    total = np.full(grams, width, np.uint64)
    for i in range(width):
        total += _mixed(h[i : i + grams] ^ _MIX[i % 16]) * _MIX[(i * 5 + 3) % 16]
    return np.unique(_mixed(total))


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    width = min(size, len(words))
    return set(zip(*(words[i : len(words) - width + 1 + i] for i in range(width)), strict=True))


def fold(samples: np.ndarray) -> bytes:
    """Odd sketch: parity of the samples that fall on each bit."""
    place = (samples * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (BITS.bit_length() - 1))
    return np.packbits(np.bincount(place.astype(np.int64), minlength=BITS) & 1).tobytes()


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of band keys per (non-empty) set."""
    flat = np.concatenate(sets)
    low = (flat >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((len(sets), BANDS * ROWS), np.uint64)
    for k in range(BANDS * ROWS):
        least[:, k] = np.minimum.reduceat((low ^ XORS[k]) * FACTORS[k], starts)
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for r in range(ROWS):
        keys = _mixed(keys * _MIX[r] + least[:, r::ROWS])
    return _mixed(keys + np.arange(BANDS, dtype=np.uint64) * _MIX[9])


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            counts, digests, sketches, keys, held, held_at = [], [], [], {}, [], []
            weight = 0

            def flush():
                if held:
                    for at, row in zip(held_at, band_keys(held), strict=True):
                        keys[at] = row
                    held.clear()
                    held_at.clear()

            for at, text in enumerate(batch.column("__text")):
                found = shingle_hashes(words_of(text.as_py() or ""), size, known)
                counts.append(len(found))
                if not len(found):
                    digests.append(None)
                    sketches.append(None)
                    continue
                digests.append(blake2b(found.tobytes(), digest_size=16).digest())
                sketches.append(fold(found[:SAMPLES]))
                held.append(found)
                held_at.append(at)
                weight += len(found)
                if weight > 40_000:
                    flush()
                    weight = 0
            flush()
            offsets = np.zeros(len(counts) + 1, np.int32)
            offsets[1:] = np.cumsum([BANDS if at in keys else 0 for at in range(len(counts))])
            flat = np.concatenate([keys[at] for at in sorted(keys)]) if keys else np.empty(0)
            made = [
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(sketches, pa.binary()),
                pa.ListArray.from_arrays(
                    offsets, pa.array(flat.astype(np.uint64).view(np.int64))
                ),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], [*batch.schema.names, *SIGNED]
            )

    return run


def compare(
    n: np.ndarray,
    sketches: np.ndarray,
    percent: int,
    cross: np.ndarray | None = None,
    certain: float = SIGMAS,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block that may be linked, and those that are certain to be, by
    ``certain`` standard deviations.

    The XOR of two odd sketches has a bit for each sample in one of the sets
    only, unless samples met on a bit. So its population count never exceeds
    the number of differing samples: a document of up to ``SAMPLES`` shingles
    is sampled whole and a pair is ruled out without error. Larger documents
    get a margin for the sampling, and the certain pairs one for meeting
    samples (the estimator -bits/2 ln(1 - 2z/bits) and its deviation).
    """
    m = len(n)
    share = np.minimum(1.0, SAMPLES / n)
    samples = np.minimum(n, SAMPLES).astype(np.float64)
    may = np.zeros((m, m), bool)
    sure = np.zeros((m, m), bool)
    wanted = percent / (100.0 + percent)
    for i in range(m - 1):
        rest = slice(i + 1, m)
        z = np.bitwise_count(sketches[i] ^ sketches[rest]).sum(1, dtype=np.int64).astype(float)
        rate = np.minimum(share[i], share[rest])
        need = wanted * (n[i] + n[rest]) * rate
        spread = np.where(rate < 1, SIGMAS * np.sqrt(need * (1 - percent / 100)), 0.0)
        both = samples[i] + samples[rest]
        fits = np.minimum(n[i], n[rest]) * 100 >= percent * np.maximum(n[i], n[rest])
        if cross is not None:
            fits &= cross[i] != cross[rest]
        may[i, rest] = fits & ((both - z) / 2 >= need - spread - 1e-9)
        full = np.minimum(2 * z / BITS, 0.999)
        differ = -BITS / 2 * np.log1p(-full)
        noise = BITS / 4 * -np.expm1(-4 * differ / BITS) - differ * np.exp(-4 * differ / BITS)
        differ += certain * np.sqrt(np.maximum(noise, 0)) * np.exp(2 * differ / BITS)
        sure[i, rest] = may[i, rest] & ((both - differ) / 2 >= need + spread * certain / SIGMAS)
    return may, sure


def block_edges(may: np.ndarray, sure: np.ndarray) -> list[tuple[int, int, bool]]:
    """Edges that keep every link of the block: a spanning forest of the
    certain pairs, and each possible pair between two of its trees. In the
    forest a member hangs on its smallest certain neighbour where it can."""
    m = len(may)
    near = sure | sure.T
    label = np.full(m, -1)
    edges = []
    for root in range(m):
        if label[root] >= 0:
            continue
        label[root] = root
        queue = [root]
        while queue:
            v = queue.pop(0)
            for w in np.nonzero(near[v] & (label < 0))[0].tolist():
                label[w] = root
                edges.append((min(v, w), max(v, w), True))
                queue.append(w)
    a, b = np.nonzero(may & ~sure & (label[:, None] != label[None, :]))
    edges.extend((i, j, False) for i, j in zip(a.tolist(), b.tolist(), strict=True))
    return edges


def _candidates(percent: int, certain: float):
    """Rows arrive sorted by bucket and block. Where they come with the label of
    a component, pairs within one are left out and none is certain."""

    def pairs(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = batch.column("__row").to_numpy()
        n = batch.column("__n").to_numpy().astype(np.float64)
        parts = batch.column("__part").to_numpy()
        first, second = batch.column("__i").to_numpy(), batch.column("__j").to_numpy()
        keys = batch.column("__key").to_numpy()
        labelled = "__label" in batch.schema.names
        labels = batch.column("__label").to_numpy() if labelled else None
        raw = b"".join(batch.column("__sketch").to_pylist())
        sketches = np.frombuffer(raw, np.uint64).reshape(len(rows), BITS // 64)
        change = (np.diff(keys) != 0) | (np.diff(first) != 0) | (np.diff(second) != 0)
        bounds = [0, *(np.nonzero(change)[0] + 1).tolist(), len(rows)]
        out_a, out_b, out_s = [], [], []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if hi - lo < 2:
                continue
            order = lo + np.argsort(rows[lo:hi], kind="stable")
            cross = parts[order] if first[lo] != second[lo] else None
            may, sure = compare(n[order], sketches[order], percent, cross, certain)
            if labels is not None:
                of = labels[order]
                may &= of[:, None] != of[None, :]
                sure[:] = False
            for i, j, is_sure in block_edges(may, sure):
                out_a.append(rows[order[i]])
                out_b.append(rows[order[j]])
                out_s.append(is_sure)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()), pa.array(out_s, pa.bool_())],
            ["a", "b", "sure"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            names = ("__key", "__i", "__j")
            last = [now.column(c)[-1].as_py() for c in names]
            same = np.ones(now.num_rows, bool)
            for c, value in zip(names, last, strict=True):
                same &= now.column(c).to_numpy() == value
            # The last block may go on in the next batch.
            cut = now.num_rows - int(same.sum())
            if cut:
                yield from pairs(now.slice(0, cut))
            rest = now.slice(cut)
        if rest is not None:
            yield from pairs(rest)

    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, kept_text, kept_set = [], None, set()
            for left, right in zip(batch.column("__ta"), batch.column("__tb"), strict=True):
                text = left.as_py()
                if text != kept_text:
                    kept_text, kept_set = text, shingle_set(words_of(text), size)
                other = shingle_set(words_of(right.as_py()), size)
                common = len(kept_set & other)
                linked.append(100 * common >= percent * (len(kept_set) + len(other) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                ["a", "b", "linked"],
            )

    return run


def _compared(
    blocks: DataFrame, signed: DataFrame, percent: int, certain: float, label: DataFrame | None = None
) -> DataFrame:
    """(a, b, sure): the edges of all blocks."""
    rows = blocks.join(signed.select("__row", "__n", "__sketch"), "__row")
    if label is not None:
        of = label.select(F.col("node").alias("__row"), F.col("label").alias("__label"))
        rows = rows.join(of, "__row", "left").withColumn("__label", F.coalesce("__label", "__row"))
    return (
        rows.repartition("__key", "__i", "__j")
        .sortWithinPartitions("__key", "__i", "__j")
        .mapInArrow(_candidates(percent, certain), "a long, b long, sure boolean")
        .groupBy("a", "b")
        .agg(F.max("sure").alias("sure"))
    )


def _between(edges: DataFrame, label: DataFrame) -> DataFrame:
    """The edges whose ends lie in two components."""
    one = label.select(F.col("node").alias("a"), F.col("label").alias("__la"))
    two = label.select(F.col("node").alias("b"), F.col("label").alias("__lb"))
    return (
        edges.join(one, "a", "left")
        .join(two, "b", "left")
        .filter(F.coalesce("__la", "a") != F.coalesce("__lb", "b"))
        .select(*edges.columns)
    )


def _confirmed(edges: DataFrame, texts: DataFrame, size: int, percent: int, label: str):
    """Edges whose full shingle sets are similar enough."""
    left = texts.select(F.col("__row").alias("a"), F.col("__text").alias("__ta"))
    right = texts.select(F.col("__row").alias("b"), F.col("__text").alias("__tb"))
    joined = edges.select("a", "b").join(right, "b").join(left, "a")
    checked = joined.mapInArrow(_confirm(size, percent), "a long, b long, linked boolean")
    return stage(checked.filter("linked").select("a", "b"), label)


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    certain: float = SIGMAS,
) -> DataFrame:
    """Component of each document among near duplicates.

    A document is the set of its distinct word shingles (the whole sequence
    where it has fewer words). Two are linked when ``100 * common >= percent *
    union``; links are transitive.

    1. One pass makes per document: number of shingles, digest of the set,
       band keys, and the odd sketch of its MinHash samples.
    2. Documents with equal sets are one representative, so copies never meet
       in a bucket.
    3. Buckets with the same members are compared once. A bucket above
       ``BLOCK`` members is split into parts and every pair of parts is a
       block of its own, so no task holds a hot bucket and none is cut off.
       Within a block all pairs are compared by XOR of the sketches, but only
       edges that keep its links are emitted.
    4. Edges are confirmed on the full shingle sets, first one per document,
       then those that would still join two components. Where an edge that was
       certain by ``certain`` standard deviations is refuted, its buckets are
       compared once more without certain pairs, so no link stays hidden.
    5. Components are labelled with distributed star contractions.

    Null and empty texts have no shingles and stand alone. A null id is
    allowed; component ids are the smallest non-null ids. Of a component the
    row with the smallest id (null last, then the first read) is kept, so of
    repeated rows one stays. An empty table gives no rows. Texts are compared
    whole.

    Columns: id, n_shingles, component_id, kept.
    """
    judged, _ = _judged(docs, id_col, text_col, shingle, percent, (), certain)
    return judged.drop("__row").withColumnRenamed("__id", id_col)


def keep_one_of_near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps, all columns as they were."""
    carried = [c for c in docs.columns if c != text_col]
    judged, signed = _judged(docs, id_col, text_col, shingle, percent, carried)
    place = {c: f"__keep_{i}" for i, c in enumerate(carried)} | {text_col: "__text"}
    kept = judged.filter("kept").select("__row")
    return signed.join(kept, "__row", "left_semi").select(
        *[F.col(place[c]).alias(c) for c in docs.columns]
    )


def _judged(
    docs, id_col, text_col, shingle, percent, carried, certain=SIGMAS
) -> tuple[DataFrame, DataFrame]:
    """Row, id, n_shingles, component_id and kept; and the signed documents
    with the carried columns, numbered."""
    source = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(id_col).cast("long").alias("__id"),
        F.col(text_col).cast("string").alias("__text"),
        *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(carried)],
    )
    kinds = (T.LongType(), T.BinaryType(), T.BinaryType(), T.ArrayType(T.LongType()))
    made = [T.StructField(name, kind) for name, kind in zip(SIGNED, kinds, strict=True)]
    schema = T.StructType([*source.schema.fields, *made])
    signed = stage(source.mapInArrow(_signatures(shingle), schema), "near-signatures")
    rank = F.struct(F.col("__id").isNull().alias("none"), F.col("__id"), F.col("__row"))
    classes = stage(
        signed.filter("__n > 0")
        .groupBy("__digest")
        .agg(F.min(rank).alias("__best"))
        .select("__digest", F.col("__best.__row").alias("__rep")),
        "near-classes",
    )
    reps = classes.select(F.col("__rep").alias("__row"))
    exploded = signed.select("__row", "__bands").join(reps, "__row", "left_semi").select(
        F.explode("__bands").alias("__key"), "__row"
    )
    placed = stage(exploded, "near-bands")
    buckets = (
        placed.groupBy("__key")
        .agg(
            F.count("*").alias("__m"),
            F.min("__row").alias("__least"),
            F.bit_xor(F.xxhash64("__row")).alias("__who"),
        )
        .filter("__m > 1")
        .groupBy("__m", "__least", "__who")
        .agg(F.min("__key").alias("__key"))
        .select("__key", F.ceil(F.col("__m") / BLOCK).cast("int").alias("__parts"))
    )
    buckets = stage(buckets, "near-buckets")
    part = F.pmod(F.xxhash64("__row", "__key"), F.col("__parts")).cast("int")
    blocks = (
        placed.join(buckets, "__key")
        .withColumn("__part", part)
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
        .select(
            "__key",
            "__row",
            "__part",
            F.least("__part", "__other").alias("__i"),
            F.greatest("__part", "__other").alias("__j"),
        )
    )
    edges = stage(_compared(blocks, signed, percent, certain), "near-edges")
    texts = signed.select("__row", F.coalesce("__text", F.lit("")).alias("__text"))
    first = edges.filter("sure").groupBy("b").agg(F.min("a").alias("a"))
    firm = _confirmed(first, texts, shingle, percent, "near-firm")
    label = components(firm)
    tried = first.select("a", "b")
    apart = _between(edges.join(tried, ["a", "b"], "left_anti"), label)
    links = firm.unionByName(_confirmed(apart, texts, shingle, percent, "near-more"))
    label = components(links)
    refuted = stage(_between(edges.filter("sure"), label).select("a", "b"), "near-refuted")
    if not refuted.isEmpty():
        # A tree that held a refuted edge may have hidden links: its buckets are
        # compared once more, without certain pairs, across components.
        here = placed.select(F.col("__row").alias("a"), "__key")
        there = placed.select(F.col("__row").alias("b"), "__key")
        keys = refuted.join(here, "a").join(there, ["b", "__key"]).select("__key").distinct()
        hidden = _compared(
            blocks.join(keys, "__key", "left_semi"), signed, percent, certain, label
        ).join(edges, ["a", "b"], "left_anti")
        found = _confirmed(hidden, texts, shingle, percent, "near-hidden")
        if not found.isEmpty():
            label = components(links.unionByName(found))
    ids = signed.select("__row", "__id", "__n", "__digest")
    joined = (
        ids.join(classes, "__digest", "left")
        .withColumn("__rep", F.coalesce("__rep", "__row"))
        .join(label.withColumnRenamed("node", "__rep"), "__rep", "left")
        .withColumn("label", F.coalesce("label", "__rep"))
        .select("__row", "__id", "__n", "label")
    )
    joined = stage(joined, "near-labels")
    heads = joined.groupBy("label").agg(F.min(rank).alias("__best"))
    judged = joined.join(heads, "label").select(
        "__row",
        "__id",
        F.col("__n").alias("n_shingles"),
        F.col("__best.__id").alias("component_id"),
        (F.col("__row") == F.col("__best.__row")).alias("kept"),
    )
    return judged, signed
