"""Language-model scores: marginal likelihood over a lattice of subwords."""

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import crc_part, stage

# Words whose counts are sent to every task: the most frequent ones.
SENT = 200_000
# Distinct words that a task gathers before it passes their counts on.
GATHERED = 200_000
# Largest vocabulary whose scores are sent to every task.
MOST_PIECES = 100_000
END = "\n"  # no word has white space, so this is the end token
SPACE = "▁"
LOG10 = math.log(10.0)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str) -> list[bytes]:
    """Words after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words in the training rows; words of other rows with 0, so
    every word gets a score."""

    def passed(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    counts: Counter = Counter()
    for batch in batches:
        for text, held in zip(batch.column("__text"), batch.column("__held"), strict=True):
            words = words_of(text.as_py() or "")
            if held.as_py():
                for word in words:
                    if word not in counts:
                        counts[word] = 0
            else:
                counts.update(words)
                counts[END.encode()] += 1
            if len(counts) >= GATHERED:
                yield passed(counts)
                counts = Counter()
    if counts:
        yield passed(counts)


def load_pieces(vocabulary: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=vocabulary)


def _piece_counts(vocabulary: str):
    """Pieces of the vocabulary's own segmentation of each training word,
    weighted by the word's count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_pieces(vocabulary)
        total: Counter = Counter()
        for batch in batches:
            kept = batch[batch["n"] > 0]
            words = [w.decode("utf-8", "replace") for w in kept["word"]]
            for pieces, n in zip(model.encode(words), kept["n"].tolist(), strict=True):
                for piece in pieces:
                    total[piece] += n
        yield pd.DataFrame({"piece": list(total.keys()), "n": list(total.values())}).astype("int64")

    return run


class Lattice:
    """Log scores of pieces, and the marginal of a word over all its
    segmentations.

    A word is spelled with a leading space mark. Every piece that matches at a
    position is an arc; a character that no piece covers is an arc of its
    UTF-8 byte pieces. The forward recursion sums the arcs in log space.
    ``last`` is the log probability that a text ends rather than begins a
    word, so words and the end share one distribution.
    """

    def __init__(self, scores: dict[str, float], bytes_of: list[float], end: float):
        self.scores = scores
        self.bytes_of = bytes_of
        self.end = end
        self.starts: dict[str, int] = defaultdict(int)
        for piece in scores:
            head = piece[:2]
            self.starts[head] = max(self.starts[head], len(piece))
        self.starts.default_factory = None
        begun = sum(math.exp(s) for piece, s in scores.items() if piece.startswith(SPACE))
        self.last = end - math.log(begun + math.exp(end))

    def word(self, word: str) -> float:
        spelled = SPACE + word
        n = len(spelled)
        reach = [-math.inf] * (n + 1)
        reach[0] = 0.0
        scores, starts = self.scores, self.starts
        for i in range(n):
            here = reach[i]
            if here == -math.inf:
                continue
            longest = min(starts.get(spelled[i : i + 2], 0), n - i)
            for size in range(2, longest + 1):
                score = scores.get(spelled[i : i + size])
                if score is not None:
                    reach[i + size] = _add(reach[i + size], here + score)
            one = scores.get(spelled[i])
            raw = sum(self.bytes_of[b] for b in spelled[i].encode("utf-8", "surrogatepass"))
            one = raw if one is None else _add(one, raw)
            reach[i + 1] = _add(reach[i + 1], here + one)
        return reach[n]


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b != -math.inf else a


def make_lattice(vocabulary: str, counts: dict[int, int], ends: int) -> Lattice:
    """Scores of the vocabulary's pieces: their share in the training words,
    each counted once more; the end of a text is an outcome like a piece."""
    model = load_pieces(vocabulary)
    size = model.get_piece_size()
    total = sum(counts.values()) + ends + size + 1
    scores, raw = {}, [math.log(1 / total)] * 256
    for i in range(size):
        score = math.log((counts.get(i, 0) + 1) / total)
        if model.is_byte(i):
            raw[int(model.id_to_piece(i)[3:-1], 16)] = score
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            scores[model.id_to_piece(i)] = score
    return Lattice(scores, raw, math.log((ends + 1) / total))


def _scored_words(shared, smooth: float, tokens: int, prior: float):
    """Base, lattice and model score of each distinct word, in log10."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = shared.value
        for batch in batches:
            marginal = np.array(
                [
                    lattice.last if w == END.encode() else lattice.word(w.decode("utf-8", "replace"))
                    for w in batch["word"]
                ],
                dtype=float,
            )
            n = batch["n"].to_numpy().astype(float)
            seen = np.log(np.maximum(n, 1e-300))
            model = np.logaddexp(seen, math.log(prior) + marginal) - math.log(tokens + prior)
            yield pd.DataFrame(
                {
                    "word": batch["word"],
                    "n": batch["n"],
                    "base": np.log10((n + 1.0) / smooth),
                    "score": model / LOG10,
                    "pieces": marginal / LOG10,
                }
            )

    return run


_PART = T.StructType(
    [
        T.StructField("__row", T.LongType()),
        T.StructField("__id", T.LongType()),
        T.StructField("__held", T.BooleanType()),
        T.StructField("word", T.BinaryType()),
        T.StructField("__times", T.LongType()),
        T.StructField("__tokens", T.LongType()),
        T.StructField("__known", T.LongType()),
        T.StructField("__base", T.DoubleType()),
        T.StructField("__score", T.DoubleType()),
        T.StructField("__pieces", T.DoubleType()),
    ]
)


def _document_parts(shared):
    """Per document a row of what the frequent words add up to, and a row for
    each rarer word with how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = shared.value
        zero = (0, 0.0, 0.0, 0.0)
        for batch in batches:
            names = ("__row", "__id", "__held", "__text")
            out: list[list] = [[] for _ in _PART]
            for row, own, held, text in zip(
                *(batch.column(c).to_pylist() for c in names), strict=True
            ):
                words = words_of(text or "")
                words.append(END.encode())
                found = [sent.get(w, zero) for w in words]
                known, *scores = zip(*found, strict=True)
                rare = Counter(w for w, f in zip(words, found, strict=True) if f is zero)
                parts = [
                    (row, own, held, None, 0, len(words), sum(known), *map(math.fsum, scores))
                ]
                parts += [(row, None, None, w, k, 0, 0, 0.0, 0.0, 0.0) for w, k in rare.items()]
                for column, values in zip(out, zip(*parts, strict=True), strict=True):
                    column.extend(values)
            kinds = [
                pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(),
                pa.int64(), pa.float64(), pa.float64(), pa.float64(),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _PART.names
            )

    return run


def _least_sent(scored: DataFrame) -> int:
    """Count from which on at most ``SENT`` words have so many. Words are
    counted by eighths of powers of two, so some hundred rows are looked at."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = scored.filter("n > 0").groupBy(step.alias("step")).agg(
        F.count("*").alias("words"), F.min("n").alias("least")
    )
    least, sent = 1 << 62, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["step"]):
        sent += row["words"]
        if sent > SENT:
            break
        least = row["least"]
    return least


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    parts: int = 7,
    held_part: int = 2,
) -> DataFrame:
    """Log10 probability of each whole text under two models.

    Rows whose crc32(id as text) mod ``parts`` is ``held_part`` are held out;
    all others train. Base: unigrams of words (A-Z lower-cased) and an end
    token, add-one smoothed over the distinct training tokens. Model: the
    pieces of an existing subword vocabulary; a piece's score is its share in
    the training words; the probability of a word sums over all segmentations
    of it, by a forward recursion in log space, once per distinct word. Words
    are segmented apart, so ``piece_score``, the marginal of the text over
    these lattices, is the sum over its words. ``score`` adds one more arc to
    each lattice, the whole word by its training count: (count + a * marginal)
    / (tokens + a), with a one more than the number of words seen once, so the
    lattice says how the mass of unseen words is spread.

    1. Words are counted in the map tasks and summed by word.
    2. Piece counts (at most the vocabulary's size) reach the driver; piece
       scores are sent to the tasks that score the distinct words.
    3. The most frequent words, at most ``SENT``, are sent to every task, so most
       occurrences are summed where the text is read. The rarer ones move as
       (row, word, times) to a join with the word table and are summed by row.

    Null and empty texts have the end token only. A null id counts as empty
    text for the remainder. Repeated rows train and are scored one by one.
    Without training rows the counts are 0, and so is train_tokens; an empty
    table gives no rows. Bytes that aren't UTF-8 don't occur in Spark strings.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, piece_score.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    size = load_pieces(vocabulary).get_piece_size()
    if size > MOST_PIECES:
        raise ValueError(f"a vocabulary of {size} pieces is too large to be sent")
    source = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(id_col).cast("long").alias("__id"),
        (crc_part(id_col, parts) == held_part).alias("__held"),
        F.col(text_col).cast("string").alias("__text"),
    )
    words = stage(
        source.select("__text", "__held")
        .mapInArrow(_word_counts, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "lm-words",
    )
    end = F.col("word") == F.lit(END.encode())
    tokens, distinct, once, ends = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count(F.when(F.col("n") > 0, 1)),
        F.count(F.when(F.col("n") == 1, 1)),
        F.coalesce(F.sum(F.when(end, F.col("n"))), F.lit(0)),
    ).first()
    pieces = (
        words.filter(~end)
        .mapInPandas(_piece_counts(vocabulary), "piece long, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    lattice = make_lattice(vocabulary, {r["piece"]: r["n"] for r in pieces}, ends)
    smooth = float(tokens + distinct + 1)
    all_words = words.unionByName(
        spark.createDataFrame([(bytearray(END.encode()), 0)], "word binary, n long")
    ).groupBy("word").agg(F.sum("n").alias("n"))
    scored = stage(
        all_words.mapInPandas(
            _scored_words(spark.sparkContext.broadcast(lattice), smooth, tokens, once + 1.0),
            "word binary, n long, base double, score double, pieces double",
        ),
        "lm-scores",
    )
    sent = {
        bytes(r["word"]): (int(r["n"] > 0), r["base"], r["score"], r["pieces"])
        for r in scored.filter(F.col("n") >= _least_sent(scored)).collect()
    }
    parted = stage(
        source.mapInArrow(
            _document_parts(spark.sparkContext.broadcast(sent)), _PART
        ),
        "lm-parts",
    )
    rare = (
        parted.filter("word IS NOT NULL")
        .select("__row", "word", "__times")
        .join(scored, "word")
        .select(
            "__row",
            F.lit(None).cast("long").alias("__id"),
            F.lit(None).cast("boolean").alias("__held"),
            F.lit(0).cast("long").alias("__tokens"),
            F.when(F.col("n") > 0, F.col("__times")).otherwise(0).alias("__known"),
            (F.col("base") * F.col("__times")).alias("__base"),
            (F.col("score") * F.col("__times")).alias("__score"),
            (F.col("pieces") * F.col("__times")).alias("__pieces"),
        )
    )
    sums = ("__tokens", "__known", "__base", "__score", "__pieces")
    summed = (
        parted.filter("word IS NULL")
        .select("__row", "__id", "__held", *sums)
        .unionByName(rare)
        .groupBy("__row")
        .agg(
            F.max("__id").alias("__id"),
            F.max("__held").alias("__held"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    return summed.select(
        F.col("__id").alias(id_col),
        F.col("__held").alias("held_out"),
        F.col("__tokens").alias("n_tokens"),
        F.col("__known").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        F.col("__base").alias("base_score"),
        F.col("__score").alias("score"),
        F.col("__pieces").alias("piece_score"),
    )
