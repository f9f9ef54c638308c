"""Links between the tokens of two tokenizers over the same texts."""

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import stage
from assayline.llm.packing import byte_of, ranked

# Pairs that are sent to every task, the most frequent ones; others are joined.
SENT = 100_000
# Bytes of text that are aligned in one go.
CHUNK = 1 << 20
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")

Batches = Iterator[pa.RecordBatch]

_TEXT = (
    "key binary, times long, n_a long, n_b long, n_groups long, n_links long, groups string,"
    " pairs array<struct<a: int, b: int, occ: int>>"
)
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteTokens:
    """Ids and token bytes of a byte-level BPE; special strings are plain text."""

    def __init__(self, path: str):
        vocab = json.loads(Path(path).read_text())["model"]["vocab"]
        to_byte = byte_of()
        self.raw = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            known = all(c in to_byte for c in piece)
            self.raw[i] = bytes(to_byte[c] for c in piece) if known else piece.encode()
        self._ranks = ranked(path)
        if self._ranks is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(path)
            self._tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._ranks is not None:
            return [self._ranks.encode(text) for text in texts]
        return [e.ids for e in self._tokenizer.encode_batch(texts, add_special_tokens=False)]


class PieceTokens:
    """Ids and token bytes of a sentence-piece model, which adds a space."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            byte = _BYTE.fullmatch(piece) if self._model.is_byte(i) else None
            self.raw.append(
                bytes([int(byte.group(1), 16)]) if byte else piece.replace("▁", " ").encode()
            )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Aligner:
    """Aligns the tokens of two tokenizers by the bytes they cover."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.length_a = np.array([len(r) for r in self.a.raw])
        self.length_b = np.array([len(r) for r in self.b.raw])
        # Ids as text with what follows them: inside and at the end of a group.
        self.shown = [
            f"{i}{mark}".encode()
            for size, marks in ((len(self.a.raw), ",|"), (len(self.b.raw), ",;"))
            for i in range(size)
            for mark in marks
        ]

    def align(self, texts: list[str]) -> dict[str, list | pa.Array]:
        """Measures, hash of the groups, and distinct linked pairs with their
        number of links, of each text. Texts whose joined token bytes differ
        from space and text have none."""
        raws = [b" " + t.encode() for t in texts]
        ids_a = self.a.encode([" " + t for t in texts])
        ids_b = self.b.encode(texts)
        good = [
            b"".join(map(self.a.raw.__getitem__, x)) == raw
            and b"".join(map(self.b.raw.__getitem__, y)) == raw
            for raw, x, y in zip(raws, ids_a, ids_b, strict=True)
        ]
        none = [[] if not g else None for g in good]
        ids_a = [x if n is None else n for x, n in zip(ids_a, none, strict=True)]
        ids_b = [x if n is None else n for x, n in zip(ids_b, none, strict=True)]
        sizes = np.array([len(r) if g else 0 for r, g in zip(raws, good, strict=True)])
        n = len(texts)
        n_a = np.array([len(x) for x in ids_a], np.int64)
        n_b = np.array([len(x) for x in ids_b], np.int64)
        a = np.array([i for x in ids_a for i in x], np.int64)
        b = np.array([i for x in ids_b for i in x], np.int64)
        # The texts stand one behind the other; mark where tokens end.
        text_ends = np.cumsum(sizes)
        marks = np.zeros(int(text_ends[-1]) + 1 if n else 1, np.uint8)
        marks[np.cumsum(self.length_a[a])] |= 1
        marks[np.cumsum(self.length_b[b])] |= 2
        ends = np.flatnonzero(marks)
        ends_a, ends_b = (marks[ends] & 1).astype(bool), (marks[ends] & 2).astype(bool)
        both = ends_a & ends_b
        # Each stretch between two ends is the overlap of just one pair.
        first = a[np.cumsum(ends_a) - ends_a]
        second = b[np.cumsum(ends_b) - ends_b]
        text = np.searchsorted(text_ends, ends, "left")
        codes, occ = np.unique(
            (text * len(self.a.raw) + first) * len(self.b.raw) + second, return_counts=True
        )
        code_text, code_pair = np.divmod(codes, len(self.a.raw) * len(self.b.raw))
        pairs = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(code_text, np.arange(n + 1)).astype(np.int32)),
            pa.StructArray.from_arrays(
                [
                    pa.array((code_pair // len(self.b.raw)).astype(np.int32)),
                    pa.array((code_pair % len(self.b.raw)).astype(np.int32)),
                    pa.array(occ.astype(np.int32)),
                ],
                ["a", "b", "occ"],
            ),
        )
        return {
            "n_a": n_a.tolist(),
            "n_b": n_b.tolist(),
            "n_groups": np.bincount(text[both], minlength=n).tolist(),
            "n_links": np.bincount(text, minlength=n).tolist(),
            "groups": self._hashes(a, b, ends_a, ends_b, both, n_a + n_b),
            "pairs": pairs,
        }

    def _hashes(self, a, b, ends_a, ends_b, both, counts) -> list[str]:
        """Hash of each text's groups, written as ids of A|ids of B;..."""
        group = np.cumsum(both) - both
        group_a, group_b = group[ends_a], group[ends_b]
        groups = int(group[-1]) + 1 if len(group) else 0
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        of_b = np.bincount(group_b, minlength=groups)
        before_b = np.cumsum(of_b) - of_b
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + before_b[group_a]] = 2 * a + both[ends_a]
        shown[np.arange(len(b)) + upto_a[group_b]] = 2 * (len(self.a.raw) + b) + both[ends_b]
        made, at = [], 0
        for count in counts.tolist():
            part = b"".join(map(self.shown.__getitem__, shown[at : at + count].tolist()))
            made.append(hashlib.sha256(part[:-1]).hexdigest() if count else "")
            at += count
        return made


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _aligned(path_a: str, path_b: str):
    def run(batches: Batches) -> Batches:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column("text")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            parts = np.searchsorted(sizes, np.arange(0, int(sizes[-1]) if len(sizes) else 0, CHUNK))
            cuts = sorted({0, *parts.tolist(), len(texts)})
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                chunk = texts.slice(start, stop - start).to_pylist()
                made = aligner.align(chunk)
                columns = [
                    pa.array([hashlib.sha256(t.encode()).digest() for t in chunk], pa.binary()),
                    batch.column("times").slice(start, stop - start),
                    *[pa.array(made[c], pa.int64()) for c in _MEASURES],
                    pa.array(made["groups"], pa.string()),
                    made["pairs"],
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["key", "times", *_MEASURES, "groups", "pairs"]
                )

    return run


def least_of_most(counted: DataFrame, most: int) -> int:
    """Value of ``n`` from which on at most ``most`` rows have so much. Rows
    are counted by eighths of powers of two, so some hundred rows are looked
    at."""
    step = F.floor(F.log2("n") * 8).cast("int").alias("step")
    sizes = counted.groupBy(step).agg(F.count("*").alias("rows"), F.min("n").alias("least"))
    least, held = 1 << 62, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["step"]):
        held += row["rows"]
        if held > most:
            break
        least = row["least"]
    return least


def link_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Alignment of two tokenizers: (measures of each row, pairs with counts).

    A encodes space and text, B (which adds a space) the text; special strings
    are plain text. Tokens are linked where their byte ranges overlap. Where
    tokens of both end at the same byte, a group ends.

    1. Equal texts are grouped by a shuffle on the full text, counted in the
       map tasks first, so a text that a third of the rows hold moves as one
       row a task. Each distinct text is encoded and aligned once, in chunks
       of ``CHUNK`` bytes (a longer text is a chunk of its own), and staged with
       its measures and distinct linked pairs.
    2. A pair's count, the number of rows that hold it linked, sums the
       multiplicities of the texts that have it, combined in the map tasks.
       ``best`` marks the pairs with the highest count of their A id.
    3. Counts come back to the texts: the most frequent pairs, at most
       ``SENT``, are sent to every task, so the pairs that most texts hold are
       summed where they are read; all others are joined by a shuffle.
    4. Measures are joined to the rows by the SHA-256 of the text; rows of a
       hot text are dealt apart by AQE.

    Null and empty texts, and texts whose joined token bytes of A or B differ
    from space and text, have no tokens: zeros and an empty hash. Repeated rows
    count each, null ids too. Other columns are not looked at. An empty table
    gives no rows and no pairs.

    Measures: id, n_a, n_b, n_groups, n_links, n_best, count_sum long,
    groups_sha256 string. Pairs: a int, b int, n long, best boolean.
    """
    if path_a is None or path_b is None:
        known_a, known_b = default_tokenizers()
        path_a, path_b = path_a or known_a, path_b or known_b
    text = F.nullif(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    distinct = source.filter(F.col("text").isNotNull()).groupBy("text").agg(
        F.count("*").alias("times")
    )
    aligned = stage(distinct.mapInArrow(_aligned(path_a, path_b), _TEXT), "token-texts")
    held = aligned.select("key", "times", F.inline("pairs"))
    counted = stage(held.groupBy("a", "b").agg(F.sum("times").alias("n")), "token-counts")
    highest = counted.groupBy("a").agg(F.max("n").alias("most"))
    pairs = stage(
        counted.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")),
        "token-pairs",
    )
    frequent = F.col("n") >= least_of_most(pairs, SENT)
    sent = F.broadcast(pairs.filter(frequent))
    sums = [
        F.sum(F.when(F.col("best"), F.col("occ")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("occ") * F.col("n")).cast("long").alias("count_sum"),
    ]
    near = held.join(sent, ["a", "b"]).groupBy("key").agg(*sums)
    far = (
        held.join(sent.select("a", "b"), ["a", "b"], "left_anti")
        .join(pairs.filter(~frequent), ["a", "b"])
        .groupBy("key")
        .agg(*sums)
    )
    zero = F.lit(0).cast("long")
    base = aligned.select("key", *_MEASURES, "groups", zero.alias("n_best"), zero.alias("count_sum"))
    blank = [F.lit(None).cast("long").alias(c) for c in _MEASURES]
    parts = [x.select("key", *blank, F.lit(None).cast("string").alias("groups"), "n_best", "count_sum")
             for x in (near, far)]
    measured = (
        base.unionByName(parts[0])
        .unionByName(parts[1])
        .groupBy("key")
        .agg(
            *[F.max(c).alias(c) for c in (*_MEASURES, "groups")],
            F.sum("n_best").alias("n_best"),
            F.sum("count_sum").alias("count_sum"),
        )
    )
    rows = source.select("id", F.unhex(F.sha2("text", 256)).alias("key"))
    joined = rows.join(measured, "key", "left")
    numbers = (*_MEASURES, "n_best", "count_sum")
    measures = joined.select(
        F.col("id").alias(id_col),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("groups", F.lit("")).alias("groups_sha256"),
    )
    return measures, pairs
