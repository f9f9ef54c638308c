"""Toxic spans by a linear-chain conditional random field, and document scores."""

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import WORD, crc_part, give_back, sampled

# The fit uses at most so many labelled documents of each kind, whole, and at
# most so many bytes of their texts.
TOXIC_SAMPLE, CLEAN_SAMPLE, SAMPLE_BYTES = 2000, 5000, 64 << 20
# Windows a document that are drawn at random for the chain, besides those that
# cover all tagged tokens.
PLAIN_WINDOWS = 4
# Features are hashed: into COUNTED slots while their documents are counted,
# and those into SLOTS weights.
COUNTED, SLOTS = 1 << 22, 1 << 18
WIDTH = 4
WINDOW = 21
# A feature marks toxic tokens when its document counts could hardly be
# chance: log-likelihood ratio and log odds above these.
LEAST_RATIO, LEAST_ODDS = 9.0, 2.0
REMEMBERED = 400_000
CELLS = 1_000_000
STRIP = b".,;:!?\"'()[]{}<>*#-_/"


def tokens_of(text: str) -> list[bytes]:
    """Words after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def features(token: bytes) -> list[str]:
    """The word without punctuation around it, and its beginnings."""
    word = (token.strip(STRIP) or token).decode("utf-8", "replace")
    return [f"w={word}", *[f"{k}={word[:k]}" for k in (3, 4, 5) if len(word) > k]]


def slots(token: bytes) -> list[int]:
    """Counted slots of a token's features; -1 fills up to WIDTH."""
    found = [xxhash.xxh32_intdigest(f) % COUNTED for f in features(token)]
    return found + [-1] * (WIDTH - len(found))


@dataclass
class Tagger:
    """Weights of token features, and log potentials of the chain: ``start``
    and ``step`` are of the toxic tag against the clean one."""

    weights: np.ndarray
    bias: float
    start: float
    step: np.ndarray
    document: np.ndarray

    def emission(self, token: bytes) -> float:
        return self.bias + float(sum(self.weights[h % SLOTS] for h in slots(token) if h >= 0))


class Emissions(dict):
    def __init__(self, tagger: Tagger):
        super().__init__()
        self.tagger = tagger

    def __missing__(self, token: bytes) -> float:
        value = self.tagger.emission(token)
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = value
        return value


def marginals(chains: list[np.ndarray], start: float, step: np.ndarray) -> list[np.ndarray]:
    """Probability of the toxic tag at every token of every chain.

    Forward-backward on the odds of the two tags, over all chains at once and
    step by step; chains are sorted by length, so a step covers those that
    are still running.
    """
    out: list[np.ndarray] = [np.empty(0)] * len(chains)
    order = sorted((i for i, c in enumerate(chains) if len(c)), key=lambda i: -len(chains[i]))
    a = np.exp(step)
    lo = 0
    while lo < len(order):
        longest = len(chains[order[lo]])
        part = order[lo : lo + max(1, CELLS // longest)]
        lo += len(part)
        lengths = np.array([len(chains[i]) for i in part])
        x = np.ones((longest, len(part)))
        for k, i in enumerate(part):
            x[: lengths[k], k] = np.exp(np.clip(chains[i], -30, 30))
        running = np.searchsorted(-lengths, -np.arange(longest), side="left")
        ahead = np.ones_like(x)
        now = x[0] * np.exp(start)
        ahead[0] = now
        for t in range(1, longest):
            k = running[t]
            now = x[t, :k] * (a[0, 1] + now[:k] * a[1, 1]) / (a[0, 0] + now[:k] * a[1, 0])
            now = np.clip(now, 1e-200, 1e200)
            ahead[t, :k] = now
        back = np.ones(len(part))
        for t in range(longest - 2, -1, -1):
            k = running[t + 1]
            y = x[t + 1, :k] * back[:k]
            back[:k] = (a[1, 0] + a[1, 1] * y) / (a[0, 0] + a[0, 1] * y)
            ahead[t, :k] *= back[:k]
        chance = ahead / (1 + ahead)
        for k, i in enumerate(part):
            out[i] = chance[: lengths[k], k].copy()
    return out


def document_features(chance: np.ndarray) -> tuple[float, ...]:
    """Log of the expected toxic tokens, and log odds of the three likeliest."""
    top = np.full(3, 1e-3)
    k = min(3, len(chance))
    top[:k] = np.sort(chance)[len(chance) - k :][::-1]
    top = np.clip(top, 1e-3, 1 - 1e-3)
    likely = float(chance[chance >= 0.05].sum())
    return (float(np.log(1e-3 + likely)), *np.log(top / (1 - top)).tolist())


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method; the last column is the constant."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + keep * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        w -= np.linalg.solve(hess, grad)
    return w


def _rising(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights that never fall with a feature: a column whose weight
    would be negative is left out and the rest fitted again."""
    use = list(range(x.shape[1]))
    while True:
        w = _logistic(x[:, use], y)
        worst = int(np.argmin(w[:-1])) if len(w) > 1 else -1
        if worst < 0 or w[worst] >= 0:
            break
        use.pop(worst)
    out = np.zeros(x.shape[1])
    out[use] = w
    return out


def _marked(docs: list[np.ndarray], places: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Whether each counted slot is of a feature that occurs in toxic documents
    far beyond chance."""
    count = np.zeros((2, COUNTED), np.int32)
    for doc, kind in zip(docs, toxic, strict=True):
        found = np.unique(places[np.unique(doc)])
        count[int(kind), found[found >= 0]] += 1
    n, m = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    at = np.nonzero(count[1])[0]
    t, c = count[1, at].astype(float), count[0, at].astype(float)
    both = t + c
    expected, other = both * n / (n + m), both * m / (n + m)
    ratio = t * np.log(t / expected) + c * np.log(np.maximum(c, 1e-9) / other)
    odds = np.log((t + 0.5) / (n + 1)) - np.log((c + 0.5) / (m + 1))
    marked = np.zeros(COUNTED, bool)
    marked[at[(t > expected) & (ratio >= LEAST_RATIO) & (odds >= LEAST_ODDS)]] = True
    return marked


def covering(places: np.ndarray, length: int) -> list[int]:
    """Starts of windows in a text of ``length`` tokens that cover all
    ``places``, in rising order, the first of each in its window's middle."""
    starts, end = [], -1
    for place in places.tolist():
        if place >= end:
            start = max(0, min(place - WINDOW // 2, length - WINDOW))
            starts.append(start)
            end = start + WINDOW
    return starts


def fit(
    texts: Iterable[str | None],
    toxic: list[int],
    plain_windows: int = PLAIN_WINDOWS,
    epochs: int = 4,
    seed: int = 5,
) -> Tagger:
    """Tags tokens of the toxic documents by the features that mark them, fits
    the chain by AdaGrad on its exact gradient, and the document score by
    logistic regression on the marginals. The chain is fitted on windows that
    cover every tagged token, wherever in its text, and on ``plain_windows``
    drawn at random from all of each text. Documents are held as numbers of
    their words."""
    known: dict[bytes, int] = {}
    flat = array("i")
    docs = []
    for text in texts:
        ids = array("i")
        for token in tokens_of(text or ""):
            number = known.get(token)
            if number is None:
                number = known[token] = len(known)
                flat.extend(slots(token))
            ids.append(number)
        docs.append(np.array(ids, dtype=np.int32))
    del known
    blank = len(flat) // WIDTH
    flat.extend([-1] * WIDTH)
    places = np.array(flat, dtype=np.int32).reshape(-1, WIDTH)
    y = np.array(toxic, dtype=float)
    marked = _marked(docs, places, y)
    tagged = (marked[places] & (places >= 0)).any(1)
    rng = np.random.default_rng(seed)
    windows, tags = [], []
    for ids, kind in zip(docs, toxic, strict=True):
        if not len(ids):
            continue
        truth = tagged[ids] & bool(kind)
        starts = set(covering(np.nonzero(truth)[0], len(ids)))
        drawn = rng.integers(0, max(1, len(ids) - WINDOW + 1), plain_windows)
        starts |= {int(i) for i in drawn}
        for s in sorted(starts):
            piece = np.full(WINDOW, blank, np.int32)
            mark = np.zeros(WINDOW, np.float32)
            part = ids[s : s + WINDOW]
            piece[: len(part)] = part
            mark[: len(part)] = truth[s : s + WINDOW]
            windows.append(piece)
            tags.append(mark)
    weights = np.zeros(SLOTS + 1)
    chain = np.array([-3.0, -3.0, 0.0, 0.0, 0.0, 0.0])  # bias, start, step by row
    at = np.where(places >= 0, places % SLOTS, SLOTS)
    if windows:
        _descend(weights, chain, at, np.array(windows), np.array(tags), epochs, rng)
    step = chain[2:].reshape(2, 2)
    tagger = Tagger(weights[:SLOTS], float(chain[0]), float(chain[1]), step, np.zeros(5))
    emission = tagger.bias + weights[at].sum(1)
    found = []
    for lo in range(0, len(docs), 500):
        chains = [emission[ids] for ids in docs[lo : lo + 500]]
        found += [document_features(p) for p in marginals(chains, tagger.start, step)]
    x = np.array([[*f, 1.0] for f in found]) if found else np.zeros((0, 5))
    if len(x) and 0 < y.sum() < len(y):
        tagger.document = _rising(x, y)
    else:
        tagger.document = np.array([0.0] * 4 + [3.0 if len(y) and y.all() else -3.0])
    return tagger


def _descend(weights, chain, at_word, windows, tags, epochs, rng, rate=0.5, ridge=1e-5) -> None:
    """AdaGrad on the negative log-likelihood of the tags."""
    sums, chain_sums = np.full(len(weights), 1e-8), np.full(len(chain), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for lo in range(0, len(order), 256):
            at = order[lo : lo + 256]
            cells, truth = at_word[windows[at]], tags[at]
            score = weights[cells].sum(2) + chain[0]
            unary, pair = _expected(score, chain[1], chain[2:].reshape(2, 2))
            size = len(at)
            miss = (unary - truth) / size
            grad = np.zeros(len(weights))
            np.add.at(grad, cells.ravel(), np.repeat(miss.ravel(), WIDTH))
            grad[SLOTS] = 0
            touched = np.nonzero(grad)[0]
            g = grad[touched] + ridge * weights[touched]
            sums[touched] += g * g
            weights[touched] -= rate * g / np.sqrt(sums[touched])
            one = truth
            seen = np.array(
                [
                    [((1 - one[:, :-1]) * (1 - one[:, 1:])).sum(), ((1 - one[:, :-1]) * one[:, 1:]).sum()],
                    [(one[:, :-1] * (1 - one[:, 1:])).sum(), (one[:, :-1] * one[:, 1:]).sum()],
                ]
            )
            g = np.concatenate(
                [[miss.sum(), (unary[:, 0] - one[:, 0]).sum() / size], ((pair - seen) / size).ravel()]
            )
            chain_sums += g * g
            chain -= 0.2 * g / np.sqrt(chain_sums)


def _expected(score: np.ndarray, start: float, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tags and tag pairs of equally long chains."""
    b, n = score.shape
    a, x = np.exp(step), np.exp(np.clip(score, -30, 30))
    ahead = np.empty((n, b, 2))
    now = np.stack([np.ones(b), x[:, 0] * np.exp(start)], 1)
    ahead[0] = now = now / now.sum(1, keepdims=True)
    for t in range(1, n):
        now = now @ a
        now[:, 1] *= x[:, t]
        ahead[t] = now = now / now.sum(1, keepdims=True)
    back = np.ones((b, 2))
    unary = np.empty((b, n))
    pair = np.zeros((2, 2))
    unary[:, n - 1] = ahead[n - 1][:, 1]
    for t in range(n - 2, -1, -1):
        reach = back.copy()
        reach[:, 1] *= x[:, t + 1]
        joint = ahead[t][:, :, None] * a[None] * reach[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pair += joint.sum(0)
        unary[:, t] = joint[:, 1, :].sum(1)
        back = reach @ a.T
        back /= back.sum(1, keepdims=True)
    return unary, pair


ADDED = ("held_out", "score", "predicted", "spans")
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("chance", T.DoubleType()),
        ]
    )
)
_ARROW_SPANS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())])
)
_WORD = re.compile(WORD)


def _tagged(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        emissions = Emissions(tagger)
        for batch in batches:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            chains = []
            for text in texts:
                tokens = tokens_of(text)
                chains.append(np.fromiter(map(emissions.__getitem__, tokens), float, len(tokens)))
            scores, spans = [], []
            for text, chance in zip(
                texts, marginals(chains, tagger.start, tagger.step), strict=True
            ):
                w = tagger.document
                logit = float(np.dot(w[:-1], document_features(chance)) + w[-1])
                scores.append(float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))))
                hits = set(np.nonzero(chance >= 0.5)[0].tolist())
                spans.append(
                    [
                        {"start": m.start(), "end": m.end(), "chance": float(chance[i])}
                        for i, m in enumerate(_WORD.finditer(text))
                        if i in hits
                    ]
                    if hits
                    else []
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, _ARROW_SPANS)],
                [*batch.schema.names, "__score", "__spans"],
            )

    return run


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    toxic: int,
    clean: int,
    most_bytes: int = SAMPLE_BYTES,
) -> tuple[list[str], list[int]]:
    """At most so many labelled documents of each kind, those with the
    smallest hashes of their ids, as long as their texts have ``most_bytes``
    together; rows with remainder 1 are left out. Of the texts of a repeated id
    the first in order stands."""
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & (crc_part("doc_id", 3) != 1))
        .groupBy(F.col("doc_id").alias("__label_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("__toxic"))
        .withColumn("__h", F.xxhash64("__label_id"))
    )
    totals = {r["__toxic"]: r["count"] for r in chosen.groupBy("__toxic").count().collect()}
    parts = [
        sampled(chosen.filter(F.col("__toxic") == kind), "__label_id", most, totals.get(kind, 0))
        for kind, most in ((1, toxic), (0, clean))
    ]
    # At most ``toxic + clean`` ids.
    ids = F.broadcast(parts[0].unionByName(parts[1]).select("__label_id", "__toxic", "__h"))
    found = (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
        .join(ids, F.col("__id") == F.col("__label_id"))
        .groupBy("__h", "__id", "__toxic")
        .agg(F.min("__text").alias("__text"))
    )
    # At most ``toxic + clean`` rows, so one task may number them.
    size = F.coalesce(F.octet_length("__text"), F.lit(0))
    upto = F.sum(size).over(Window.orderBy("__h", "__id"))
    rows = (
        found.withColumn("__upto", upto)
        .filter(F.col("__upto") <= most_bytes)
        .orderBy("__h", "__id")
        .select("__toxic", "__text")
        .collect()
    )
    return [r["__text"] for r in rows], [r["__toxic"] for r in rows]


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    toxic_sample: int = TOXIC_SAMPLE,
    clean_sample: int = CLEAN_SAMPLE,
    train_docs: DataFrame | None = None,
    sample_bytes: int = SAMPLE_BYTES,
    plain_windows: int = PLAIN_WINDOWS,
) -> DataFrame:
    """``docs`` with a toxicity score and the offending offsets.

    The tagger is fitted on the driver from at most ``toxic_sample +
    clean_sample`` labelled documents (``labels``: doc_id, toxic) of at most
    ``sample_bytes`` of text together, whose remainder crc32(id) mod 3 is not 1,
    taken from ``train_docs`` (default: ``docs``); only their text is an input.
    Sampled texts are used whole (see ``fit`` for ``plain_windows``). The tagger
    is then applied to every whole text in the map tasks: no shuffle, and
    memory for one batch.

    Null and empty texts have no tokens and get the score of a document
    without toxic ones. Without labels of both kinds every score is a
    constant on the side of the labels there are. A null id is allowed and
    never a training row; repeated rows are scored one by one; an empty table
    gives no rows. All columns of ``docs`` are kept as they are but for those
    named like an added one, which takes their place. Added are held_out
    boolean, score double, predicted int, spans array<struct<start, end,
    chance>> in code points, end exclusive.
    """
    spark = docs.sparkSession
    texts, kinds = training_sample(
        docs if train_docs is None else train_docs,
        labels,
        id_col,
        text_col,
        toxic_sample,
        clean_sample,
        sample_bytes,
    )
    shared = spark.sparkContext.broadcast(fit(texts, kinds, plain_windows))
    del texts, kinds
    give_back()
    kept = [c for c in docs.columns if c not in ADDED]
    source = docs.select(
        F.struct(*[F.col(c) for c in kept]).alias("__doc"),
        F.col(text_col).cast("string").alias("__text"),
        F.col(id_col).alias("__id"),
    )
    schema = T.StructType(
        [
            *source.schema.fields,
            T.StructField("__score", T.DoubleType()),
            T.StructField("__spans", SPANS),
        ]
    )
    scored = source.mapInArrow(_tagged(shared), schema)
    return scored.select(
        *[F.col("__doc").getField(c).alias(c) for c in kept],
        (crc_part("__id", 3) == 1).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
        F.col("__spans").alias("spans"),
    )
