"""Quality scores from random-indexing word vectors and a two-layer network.

Tokens are runs of letters, digits or signs. Every token has a fixed sparse random index vector (chosen by
its hash) and a shape (lower, capital, upper, mixed, digits, signs; repeated or not) with one of its own. Over the
learning texts each token and shape gathers the index vectors of its neighbours: the context vectors. A
document is the mean of its tokens' vectors beside the mean of its shapes' vectors. A network with one hidden
layer, written in numpy, scores it; its logits are divided by a temperature fitted on a part of the
learning texts that the network has not seen, and moved to the labels' true shares.

The learning sample is bounded: ``per_class`` labelled texts of each class of at most ``max_chars`` characters.
Only rows outside the held-out fold are learned from. Scoring reads every text whole.

Defined cases: null and empty texts are scored as the zero document; without labels of both classes all scores are the
share of good labels (0.5 without any); several labels of one id count as the lowest; labels without a
value, an id or a document are ignored; repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out, mapped, slices, stored, text_of, where_text
from .sampling import labelled_sample

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
PER_CLASS = 1000
MAX_CHARS = 30_000
WIDTH = 48
PLACES = 1 << 15
SHAPES = 16
SPARSE = 6
WINDOW = 2
HIDDEN = 24
STEPS = 400
RATE = 0.01
DECAY = 1e-3
REMEMBERED = 1 << 17
REMEMBERED_CHARS = 40
SLICE_BYTES = 1 << 20

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def _shape(token: str) -> int:
    if token[0].isalpha():
        if token.islower():
            return 0
        if token.isupper():
            return 2 if len(token) > 1 else 1
        return 1 if token[1:].islower() else 3
    return 4 if token[0].isdigit() else 5


class TokenCodes(dict):
    """Token -> place of its lower-case form and its shape, in one number."""

    def __missing__(self, token: str) -> int:
        code = (crc32(token.lower().encode()) % PLACES) * SHAPES + 2 * _shape(token)
        if len(token) <= REMEMBERED_CHARS:
            self[token] = code
        return code


@lru_cache(maxsize=1)
def _codes() -> TokenCodes:
    return TokenCodes()


def token_codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and shapes of the tokens in order; a token like the one before it has an odd shape."""
    known = _codes()
    if len(known) > REMEMBERED:
        known.clear()
    tokens = TOKEN.findall(text)
    codes = np.fromiter(map(known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    again = np.zeros(codes.size, dtype=np.int64)
    again[1:] = codes[1:] == codes[:-1]
    return codes // SHAPES, codes % SHAPES + again


def index_vectors(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the places of its few non-zero entries, and their signs."""
    draw = np.random.default_rng(seed)
    return draw.integers(0, WIDTH, (rows, SPARSE)), draw.choice([-1.0, 1.0], (rows, SPARSE))


def _gather(targets: np.ndarray, rows: int, sources: np.ndarray, index) -> np.ndarray:
    """Sum over (target, source) pairs of the source's index vector, by target."""
    places, signs = index
    out = np.zeros(rows * WIDTH)
    for entry in range(SPARSE):
        flat = targets * WIDTH + places[sources, entry]
        out += np.bincount(flat, weights=signs[sources, entry], minlength=rows * WIDTH)
    return out.reshape(rows, WIDTH)


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(size > 0, size, 1)).astype(np.float32)


def _dense(rows: int, index) -> np.ndarray:
    own = np.arange(rows)
    return _gather(own, rows, own, index)


@dataclass
class Vectors:
    words: np.ndarray
    shapes: np.ndarray

    def pool(self, text: str) -> np.ndarray:
        places, shapes = token_codes(text)
        if not places.size:
            return np.zeros(2 * WIDTH, dtype=np.float32)
        share = np.bincount(shapes, minlength=SHAPES)[:SHAPES].astype(np.float32) / shapes.size
        total = sum(
            self.words[places[a : a + 65536]].sum(axis=0, dtype=np.float32)
            for a in range(0, places.size, 65536)
        )
        return np.concatenate([total / places.size, share @ self.shapes])


def learn_vectors(texts: list[str]) -> Vectors:
    """Context vectors of all places and shapes over the texts; unseen places keep their index vector."""
    word_index, shape_index = index_vectors(PLACES, 11), index_vectors(SHAPES, 12)
    word_sum = _dense(PLACES, word_index)
    shape_sum = _dense(SHAPES, shape_index)
    gap = np.full(WINDOW, -1)
    streams = [token_codes(t) for t in texts]
    places = np.concatenate([x for p, _ in streams for x in (p, gap)] or [gap])
    shapes = np.concatenate([x for _, s in streams for x in (s, gap)] or [gap])
    for step in range(1, WINDOW + 1):
        for left, right in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
            both = (places[left] >= 0) & (places[right] >= 0)
            target, source = places[left][both], places[right][both]
            target_shape, source_shape = shapes[left][both], shapes[right][both]
            word_sum += _gather(target, PLACES, source, word_index)
            word_sum += _gather(target, PLACES, source_shape, shape_index)
            shape_sum += _gather(target_shape, SHAPES, source_shape, shape_index)
    return Vectors(_unit(word_sum), _unit(shape_sum))


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((rows - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2


def fit_network(rows: np.ndarray, good: np.ndarray, seed: int = 7) -> Network:
    """Full-batch Adam on the logistic loss with weight decay."""
    draw = np.random.default_rng(seed)
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = (rows - mean) / scale
    size = x.shape[1]
    params = [
        draw.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN),
        draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        w1, b1, w2, b2 = params
        hidden = np.tanh(x @ w1 + b1)
        error = (1 / (1 + np.exp(-(hidden @ w2 + b2))) - good) / len(good)
        back = np.outer(error, w2) * (1 - hidden**2)
        grads = [x.T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ error + DECAY * w2, error.sum(keepdims=True)]
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad**2
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
            )
    w1, b1, w2, b2 = params
    return Network(mean, scale, w1, b1, w2, float(b2[0]))


def temperature(logits: np.ndarray, good: np.ndarray) -> float:
    """The divisor of the logits with the least logistic loss on unseen rows."""
    choices = np.geomspace(0.1, 10, 81)
    losses = [np.logaddexp(0, np.where(good > 0, -1, 1) * logits / t).mean() for t in choices]
    return float(choices[int(np.argmin(losses))])


@dataclass
class Model:
    vectors: Vectors | None
    network: Network | None
    temperature: float
    shift: float  # log odds of the labels' shares, beside the balanced sample
    default: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), self.default)
        rows = np.stack([self.vectors.pool(t) for t in texts])
        logits = self.network.logits(rows) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def fit(texts: list[str], good: list[int], share: float | None = None) -> Model:
    """``share`` is the share of good labels in all learning rows; the sample may be balanced."""
    marks = np.array(good, dtype=np.float64)
    if not 0 < marks.sum() < marks.size:
        return Model(None, None, 1.0, 0.0, float(marks.mean()) if marks.size else 0.5)
    vectors = learn_vectors(texts)
    rows = np.stack([vectors.pool(t) for t in texts])
    seen = np.arange(marks.size) % 5 != 0
    heat = 1.0
    if 0 < marks[seen].sum() < seen.sum() and not seen.all():
        part = fit_network(rows[seen], marks[seen])
        heat = temperature(part.logits(rows[~seen]), marks[~seen])
    own = marks.mean()
    share = own if share is None else min(max(share, 1e-3), 1 - 1e-3)
    shift = float(np.log(share / (1 - share)) - np.log(own / (1 - own)))
    return Model(vectors, fit_network(rows, marks), heat, shift, share)


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS,
) -> Model:
    """Learn from a bounded sample of labelled documents outside the held-out fold.

    Drawn are ids with a label and a document, ``per_class`` of each label or all there are, however often a row repeats and
    whatever else is labelled. Texts over ``max_chars`` serve where a label has too few others. Of several texts of
    an id the least short one in code-point order counts.
    """
    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .filter(~held_out(id_col, FOLDS, HELD_OUT))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.min(F.col(label_col).cast("int")).alias("label"))
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    texts = texts.withColumn("long", F.char_length("text") > max_chars)
    there = stored(
        texts.groupBy("id").agg(F.min("long").alias("long")).join(known, "id").select("id", "label", "long"), "labelled"
    )
    counts = {r["label"]: r["count"] for r in there.groupBy("label").count().collect()}
    picked = labelled_sample(there, "label", ["id"], per_label=per_class, max_labels=2, carry=["id"], later=F.col("long"))
    if not picked:
        return fit([], [])
    # At most 2 * per_class ids: small enough for every executor.
    ids = F.broadcast(
        docs.sparkSession.createDataFrame([(r["id"], r["label"]) for r in picked], "id long, label int")
    )
    sample = (
        texts.join(ids, "id").groupBy("id", "label").agg(F.min(F.struct("long", "text")).alias("best"))
        .orderBy(F.xxhash64("id"), "id").select("label", "best.text").collect()
    )
    share = counts.get(1, 0) / sum(counts.values())
    return fit([r["text"] for r in sample], [r["label"] for r in sample], share)


def predict(
    docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, held_out, score, predicted) per row; a map over the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_BYTES):
            scores = shared.value.scores([t.as_py() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=[id_col, "held_out", "score", "predicted"],
            )

    picked = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        text_of(text_col).alias("text"),
        held_out(id_col, FOLDS, HELD_OUT).alias("held_out"),
    )
    return mapped(picked, run, f"`{id_col}` long, held_out boolean, score double, predicted int")


def good_enough(
    docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows that score at least the threshold, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def good(column: pa.Array) -> np.ndarray:
        return shared.value.scores([t.as_py() for t in column]) >= threshold

    return where_text(docs, text_col, good, SLICE_BYTES)
