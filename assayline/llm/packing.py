"""Packing documents with their lexical neighbours into token windows."""

import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import text_or_empty
from assayline.llm.dealing import deal

WINDOW = 2048
END_ID = 1
# Bytes of text of a shard: what a task holds, and what its index covers.
SHARD_BYTES = 8 << 20
K1, B = 1.2, 0.75
# Terms of more than one document in DENSE are scored by matrix product, in
# blocks of seeds, where a shard's pairs of documents are at most CELLS.
DENSE, BLOCK, CELLS = 16, 256, 1 << 24
# Neighbours of a seed that are sorted at first.
AHEAD = 32
# How byte-level tokenizers of this kind part text into words, and
# what counts as white space there.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same where no two white spaces stand together: nothing to look ahead for.
SINGLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_RUN = re.compile(f"([{SPACES}]+(?![^{SPACES}]))")
_DOUBLE = re.compile(f"[{SPACES}]{{2}}")
# A white space that stands between words which are encoded together.
MARK = "\x0b"
# What a word between two blanks may have where white spaces stand together.
_ODD = re.compile(f"\\A[{SPACES}]|[{SPACES}]\\Z|[{SPACES}]{{2}}")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable
    bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Ranked:
    """Ids by rank of merging, for vocabularies whose ids follow the order of
    merging. Strings of special tokens are plain text.

    A run of white space before a word ends as a piece of its own one character
    short of the word, and one at the end of the text as a whole. Texts are cut
    there; what is left holds no two white spaces together, so it is parted by
    the pattern that never looks ahead, which is much faster.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        made = {"mergeable_ranks": ranks, "special_tokens": {}}
        self._any = tiktoken.Encoding("any", pat_str=PATTERN, **made)
        self._single = tiktoken.Encoding("single", pat_str=SINGLE, **made)

    def encode(self, text: str) -> list[int]:
        if not _DOUBLE.search(text):
            return self._single.encode_ordinary(text)
        ids: list[int] = []
        for k, part in enumerate(_RUN.split(text)):
            if part:
                by = self._any if k % 2 else self._single
                ids += by.encode_ordinary(part)
        return ids

    def encode_words(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of texts without ``MARK``; None for those where white spaces may
        stand together. Only the first character of a part can be a blank, so
        texts are cut before each blank, and each distinct word of them is
        encoded once."""
        if not texts:
            return []
        listed = pc.split_pattern(pa.array([MARK + t for t in texts], pa.large_string()), " ")
        found = listed.flatten().dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        spaced = pc.match_substring_regex(found.dictionary, f"^$|[{SPACES}]").to_numpy(zero_copy_only=False)
        odd = spaced.copy()
        for k in np.flatnonzero(spaced).tolist():
            word = distinct[k]
            odd[k] = not word or _ODD.search(word.removeprefix(MARK)) is not None
        # The first word of a text has no blank before it.
        words = [
            "" if o else w[1:] if w[0] == MARK else " " + w
            for w, o in zip(distinct, odd.tolist(), strict=True)
        ]
        mark = self._single.encode_ordinary(MARK)[0]
        ids = np.array(self._single.encode_ordinary(MARK.join(words)), np.int32)
        marks = np.flatnonzero(ids == mark)
        first = np.concatenate([[0], marks + 1])
        word, starts = found.indices.to_numpy(), listed.offsets.to_numpy()[:-1]
        sizes = (np.concatenate([marks, [len(ids)]]) - first)[word]
        ends = np.cumsum(sizes)
        placed = ids[np.repeat(first[word] - ends + sizes, sizes) + np.arange(ends[-1])]
        cut = np.split(placed, ends[starts[1:] - 1])
        apart = np.add.reduceat(odd[word].astype(np.int64), starts) == 0
        return [x if p else None for x, p in zip(cut, apart.tolist(), strict=True)]


def ranked(path: str) -> Ranked | None:
    """The merges as ranks; None for vocabularies that are ordered otherwise."""
    model = json.loads(Path(path).read_text())["model"]
    vocab, merges, to_byte = model["vocab"], model.get("merges", ()), byte_of()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    made = [vocab.get(left + right, -1) for left, right in pairs]
    if not made or made[0] < 0 or any(x >= y for x, y in zip(made, made[1:], strict=False)):
        return None
    pieces = {p: i for p, i in vocab.items() if all(c in to_byte for c in p)}
    ranks = {bytes(to_byte[c] for c in p): i for p, i in pieces.items()}
    merged = {left + right for left, right in pairs}
    return Ranked(
        {
            raw: i for (p, i), raw in zip(pieces.items(), ranks, strict=True)
            if len(raw) == 1 or p in merged
        }
    )


class Encoder:
    """Token ids of a text as little-endian numbers. Merged by rank where the
    vocabulary allows it, which is much faster; the tokenizer itself encodes
    texts that hold strings of special tokens, and all texts of other kinds of
    vocabularies."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = ranked(path) if self._parts_like_pattern() else None

    def _parts_like_pattern(self) -> bool:
        """Whether the tokenizer parts texts as ``PATTERN`` does."""
        probe = "One two,three\n four's été 12 $5.  x \n\n y\t"
        own = self.tokenizer.pre_tokenizer
        if type(own).__name__ != "ByteLevel" or self.tokenizer.normalizer is not None:
            return False
        to_byte = byte_of()
        parts = [
            bytes(to_byte[c] for c in part).decode() for part, _ in own.pre_tokenize_str(probe)
        ]
        return parts == ["One", " two", ",", "three", "\n", " four", "'s", " été", " 12", " $",
                         "5", ".", " ", " x", " \n\n", " y", "\t"]

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text, then the end id."""
        if self.ranks is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode(text)
        ids.append(END_ID)
        return np.array(ids, dtype=self.kind)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """``encode`` of each text, words that they share encoded once."""
        if self.ranks is None:
            return [self.encode(t) for t in texts]
        plain = [not (MARK in t or any(s in t for s in self.special)) for t in texts]
        shared = iter(self.ranks.encode_words([t for t, p in zip(texts, plain, strict=True) if p]))
        out = []
        for text, p in zip(texts, plain, strict=True):
            ids = next(shared) if p else None
            out.append(self.encode(text) if ids is None else np.append(ids, END_ID).astype(self.kind))
        return out


def starts(groups: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` groups begins in sorted ``groups``, and their end."""
    return np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=n))])


class Index:
    """BM25 index of a shard: postings by term, and the terms of each document."""

    def __init__(self, terms: list[np.ndarray]):
        n = len(terms)
        lengths = np.array([len(t) for t in terms], dtype=np.int64)
        flat = np.concatenate([*terms, np.empty(0, np.int64)])
        ids, _ = pd.factorize(flat)
        owner = np.repeat(np.arange(n), lengths)
        # One entry per (term, document), sorted by term, then document.
        key, times = np.unique(ids.astype(np.int64) * max(1, n) + owner, return_counts=True)
        term, doc = key // max(1, n), key % max(1, n)
        df = np.bincount(term, minlength=1)
        shared = df[term] > 1
        term, doc, times = term[shared], doc[shared], times[shared].astype(float)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        mean = max(1.0, lengths.mean()) if n else 1.0
        norm = K1 * (1 - B + B * lengths / mean)
        self.doc = doc
        self.weight = idf[term] * times * (K1 + 1) / (times + norm[doc])
        frequent = (df > n / DENSE) & (df > 1) & (n * n <= CELLS)
        dense = frequent[term]
        column = np.cumsum(frequent) - 1
        self.dense = np.zeros((n, np.count_nonzero(frequent)), np.float32)
        self.dense[doc[dense], column[term[dense]]] = self.weight[dense]
        self.blocks: dict[int, np.ndarray] = {}
        self.doc, self.weight, self.term = self.doc[~dense], self.weight[~dense], term[~dense]
        self.first = starts(self.term, len(df))
        order = np.lexsort((self.term, self.doc))
        self.by_doc = self.term[order]
        self.doc_first = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.n, self.held = n, n

    def _dense_scores(self, seed: int) -> np.ndarray:
        block, row = divmod(seed, BLOCK)
        if block not in self.blocks:
            asked = self.dense[block * BLOCK : (block + 1) * BLOCK] > 0
            self.blocks[block] = asked.astype(np.float32) @ self.dense.T
        return self.blocks[block][row]

    def forget(self, unused: np.ndarray) -> None:
        """Drop the postings of used documents, each time an eighth of those
        that are left has gone; they can't be neighbours any more."""
        left = int(np.count_nonzero(unused))
        if left > self.held * 7 // 8:
            return
        self.held = left
        kept = unused[self.doc]
        self.doc, self.weight, self.term = self.doc[kept], self.weight[kept], self.term[kept]
        self.first = starts(self.term, len(self.first) - 1)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every unused document by all terms of the seed."""
        query = self.by_doc[self.doc_first[seed] : self.doc_first[seed + 1]]
        first, sizes = self.first[query], self.first[query + 1] - self.first[query]
        ends = np.cumsum(sizes)
        places = np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        scores = np.bincount(self.doc[places], self.weight[places], minlength=self.n)
        return scores + self._dense_scores(seed) if self.dense.shape[1] else scores

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share terms with the seed, best first."""
        return np.fromiter(self.nearest(seed, unused), np.int64)

    def nearest(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """As ``neighbours``, sorted as far as they are asked for."""
        self.forget(unused)
        scores = self.scores(seed)
        found = np.flatnonzero(unused & (scores > 0))
        size = AHEAD
        while len(found):
            if len(found) > size:
                # All that score at least as much as the best of this size.
                least = np.partition(scores[found], len(found) - size)[len(found) - size]
                best = found[scores[found] >= least]
            else:
                best = found
            yield from best[np.argsort(-scores[best], kind="stable")].tolist()
            found = found[scores[found] < scores[best].min()]
            size *= 4


def pack_order(terms: list[np.ndarray], lengths: list[int], window: int = WINDOW) -> list[int]:
    """Order in which a shard's documents fill its windows. A window's seed is
    the document that is running over from the last one, or else the next
    unused one; the window is filled with the seed's unused neighbours, best
    first, and with the next unused document where there is none."""
    index = Index(terms)
    unused = np.ones(len(terms), bool)
    order: list[int] = []
    filled, cursor = 0, 0
    queue: Iterator[int] = iter(())
    while len(order) < len(terms):
        # What stands in the queue was unused when it was asked for, and is
        # taken from its front alone.
        nxt = next(queue, None)
        if nxt is None and order:
            queue = index.nearest(order[-1], unused)
            nxt = next(queue, None)
        if nxt is None:
            while not unused[cursor]:
                cursor += 1
            nxt = cursor
        unused[nxt] = False
        order.append(nxt)
        filled += lengths[nxt]
        if filled >= window:
            # A new window has begun with what ran over: its neighbours are next.
            filled %= window
            queue = index.nearest(nxt, unused)
    return order


PIECES = T.StructType(
    [
        T.StructField("__id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)
_NAMES = PIECES.names
_KINDS = [pa.int64()] * 7 + [pa.list_(pa.int32())]


def _pieces(ids, tokens, order, shard, window, with_ids) -> pa.RecordBatch:
    out: list[list] = [[] for _ in _NAMES]
    sequence, offset = shard << 32, 0
    for d in order:
        mine, start = tokens[d], 0
        while start < len(mine):
            length = min(len(mine) - start, window - offset)
            part = mine[start : start + length]
            crc = zlib.crc32(part.astype("<u4").tobytes())
            row = (ids[d], start, length, crc, len(mine), sequence, offset)
            for column, value in zip(out, row, strict=False):
                column.append(value)
            out[-1].append(part.astype(np.int32) if with_ids else None)
            start += length
            offset += length
            if offset == window:
                sequence, offset = sequence + 1, 0
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(out, _KINDS, strict=True)], _NAMES
    )


def _terms(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(hash, words), np.int64, len(words))


def _packed(path: str, window: int, with_ids: bool):
    def shard_of(rows: pa.Table, encoder: Encoder) -> pa.RecordBatch:
        shard = rows.column("__shard")[0].as_py()
        texts = rows.column("__text").to_pylist()
        tokens = encoder.encode_all(texts)
        order = pack_order([_terms(t) for t in texts], [len(t) for t in tokens], window)
        return _pieces(rows.column("__id").to_pylist(), tokens, order, shard, window, with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shards = batch.column("__shard").to_numpy()
            bounds = [0, *(np.nonzero(np.diff(shards))[0] + 1).tolist(), batch.num_rows]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if held and held[-1].column("__shard")[0].as_py() != shards[lo]:
                    yield shard_of(pa.Table.from_batches(held), encoder)
                    held = []
                held.append(part)
        if held:
            yield shard_of(pa.Table.from_batches(held), encoder)

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    with_ids: bool = True,
) -> DataFrame:
    """Documents cut into pieces that fill windows of ``window`` tokens next
    to lexically similar documents.

    A document is the tokenizer's ids and the end id. Documents are dealt by
    their words into shards of about ``shard_bytes`` of text, however many
    there are: a tree of centroids brings like documents together, and a leaf
    that a shard can't hold is cut by a MinHash of the words, which near copies
    mostly share. A shard is indexed by BM25 on its words and packed by one
    task, which holds that shard alone (and a document larger than it). A seed
    asks its own shard, so neighbours that were dealt elsewhere are missed. A window's seed
    asks the index for its unused neighbours, which fill the window greedily;
    what runs over begins the next window and is its seed. So windows are full
    but for the last of each shard, and the shards grow in number, not size.
    All documents are packed: where no neighbour is left, the next unused
    document follows.

    Text is staged once with its leaf, shuffled once, and tokenized where it is
    packed. A group of copies larger than a shard is dealt by hash of id and
    text among shards of its own. Null and empty
    texts are the end id alone; a null id is allowed; repeated rows are packed
    like other documents, and ties are settled by the order within the shard,
    which is sorted by hash. An empty table gives no rows.

    Columns: id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and ids array<int> (null unless ``with_ids``).
    """
    text = text_or_empty(text_col)
    total, count = docs.agg(F.sum(F.octet_length(text) + 8), F.count("*")).first()
    hashed = F.xxhash64(F.col(id_col).cast("long"), text)
    rows = docs.select(
        F.col(id_col).cast("long").alias("__id"), text.alias("__text"), hashed.alias("__hash")
    )
    dealt = (
        deal(rows, count, int(total or 0), shard_bytes)
        .repartition("__shard")
        .sortWithinPartitions("__shard", "__hash", "__id")
    )
    packed = dealt.select("__id", "__text", "__shard").mapInArrow(
        _packed(tokenizer or default_tokenizer(), window, with_ids), PIECES
    )
    return packed.withColumnRenamed("__id", id_col)
