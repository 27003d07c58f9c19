"""Language identification with string kernels.

Kernel: the number of distinct letter sequences of one to three characters (word borders included) that
two texts share, divided by the root of their own numbers: a blended-spectrum presence kernel, with
sequences hashed to ``1 << BITS`` places. A bounded sample of labelled texts gives Nyström landmarks; kernel
ridge regression, one language against the rest, is solved in their feature space. Scoring a block of
texts is two matrix products: presence with the landmarks' presence, and kernel rows with the weights.

Every language of the table is learned. The learning sample is bounded: at most ``per_language`` texts for each, and
beyond ``SAMPLE`` texts in all at least ``LEAST_TEXTS``; texts over ``max_chars`` characters are learned from only
where a language lacks shorter ones, by their first ``max_chars``. Scoring reads every text whole.

Defined cases: a null text or one without letters is ``und`` with score 0; without any labelled text all
are ``und``; null ids and repeated rows are scored like others; rows without a language are not learned
from; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import code_points, held_out, letters, mapped, slices, text_of, where_text
from .sampling import labelled_sample

FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE = 120
SAMPLE = 6000
LEAST_TEXTS = 8
MAX_CHARS = 20_000
LANDMARKS = 96  # at least, and at least LEAST_LANDMARKS a language
LEAST_LANDMARKS = 4
ROWS_FITTED = 1024
BITS = 15
LONGEST = 3
RIDGE = 1e-2
SHARPNESS = 8.0
UNKNOWN = "und"
#: The sample comes to the driver and the model to every executor; both grow with the languages.
MOST_LANGUAGES = 2000

SLICE_BYTES = 1 << 20
ROWS_AT_ONCE = 256
PIECE = 1 << 20

# Odd multipliers that spread a sequence of one, two or three letters over the places.
SPREAD = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)
STEP = np.uint32(1_000_003)


def _places(text: str) -> Iterator[np.ndarray]:
    """Places of all letter sequences of a text, piece by piece."""
    table = letters()
    points = code_points(text)
    for start in range(0, points.size, PIECE):
        end = start + PIECE + LONGEST
        low = table[points[max(0, start - 1) : end]]
        # A border stands before the first and after the last character of the text.
        border = np.zeros(1, dtype=np.uint32)
        low = np.concatenate([border[: start == 0], low, border[: end >= points.size]])
        low = low[(low != 0) | (np.concatenate([[np.uint32(1)], low[:-1]]) != 0)]
        if low.size < 2 or not low.any():
            continue
        code = low
        yield (code[low != 0] * SPREAD[0]) >> np.uint32(32 - BITS)
        for length in range(2, LONGEST + 1):
            code = code[:-1] * STEP + low[length - 1 :]
            yield (code * SPREAD[length - 1]) >> np.uint32(32 - BITS)


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: 1 where some sequence of the text falls."""
    out = np.zeros((len(texts), 1 << BITS), dtype=np.uint8)
    for row, text in zip(out, texts):
        for places in _places(text):
            row[places] = 1
    return out


@dataclass
class Model:
    languages: list[str]
    columns: np.ndarray  # places that some landmark has
    landmarks: np.ndarray  # places x landmarks, scaled
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        own = np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.float32), 1))
        return rows[:, self.columns].astype(np.float32) @ self.landmarks / own[:, None]

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        rows = presence(texts)
        empty = ~rows.any(axis=1)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        margins = SHARPNESS * (self.kernel(rows) @ self.weights + self.bias)
        odds = np.exp(margins - margins.max(axis=1, keepdims=True))
        share = odds / odds.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names = [UNKNOWN if e else self.languages[b] for e, b in zip(empty, best)]
        return names, np.where(empty, 0.0, share.max(axis=1)).astype(np.float64)


def fit(texts: list[str], labels: list[str], *, landmarks: int = LANDMARKS) -> Model:
    """Nyström kernel ridge regression over the given texts."""
    languages = sorted(set(labels))
    rows = presence(texts) if texts else np.zeros((0, 1 << BITS), dtype=np.uint8)
    useful = rows.any(axis=1)
    rows, labels = rows[useful], [name for name, ok in zip(labels, useful) if ok]
    if not labels:
        nothing = np.zeros((0, 0), dtype=np.float32)
        return Model([], np.zeros(0, dtype=np.int64), nothing, nothing, np.zeros(0, dtype=np.float32))
    # Landmarks alternate between the languages, in sample order.
    turn: dict[str, int] = {}
    order = []
    for place, name in enumerate(labels):
        turn[name] = turn.get(name, -1) + 1
        order.append((turn[name], name, place))
    chosen = [place for _, _, place in sorted(order)[: max(landmarks, LEAST_LANDMARKS * len(languages))]]
    columns = np.flatnonzero(rows[chosen].any(axis=0))
    scaled = rows[chosen][:, columns] / np.sqrt(rows[chosen].sum(axis=1, keepdims=True))
    model = Model(languages, columns, scaled.T.astype(np.float32), np.empty(0), np.empty(0))
    parts = [model.kernel(rows[at : at + ROWS_FITTED]) for at in range(0, len(rows), ROWS_FITTED)]
    cross = np.concatenate(parts).astype(np.float64)
    values, vectors = np.linalg.eigh(cross[chosen])
    kept = values > 1e-6 * values[-1]
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = cross @ root
    targets = np.array([[1.0 if name == own else -1.0 for own in languages] for name in labels])
    # Every language weighs the same, however many texts it has.
    weight = np.array([1 / labels.count(name) for name in labels])
    weight *= len(labels) / weight.sum()
    centre, middle = np.average(features, axis=0, weights=weight), np.average(targets, axis=0, weights=weight)
    moved = (features - centre) * weight[:, None]
    gram = moved.T @ (features - centre) + RIDGE * len(labels) * np.eye(features.shape[1]) / len(languages)
    solved = np.linalg.solve(gram, moved.T @ (targets - middle))
    model.weights = (root @ solved).astype(np.float32)
    model.bias = (middle - centre @ solved).astype(np.float32)
    return model


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS,
) -> Model:
    """Learn from a bounded sample of the rows outside the held-out fold."""
    rows = docs.filter(~held_out(id_col, FOLDS, HELD_OUT)).select(
        F.col(lang_col).cast("string").alias("label"), text_of(text_col).alias("text")
    )
    languages = rows.select(F.count_distinct("label")).first()[0]
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} languages are more than a model of {MOST_LANGUAGES} takes")
    rows = rows.filter(F.char_length("text") > 0).select(
        "label", F.substring("text", 1, max_chars).alias("text"), (F.char_length("text") > max_chars).alias("long")
    )
    sample = labelled_sample(
        rows, "label", ["text"], per_label=min(per_language, max(LEAST_TEXTS, SAMPLE // max(1, languages))),
        max_labels=None, carry=["text"], later=F.col("long"),
    )
    return fit([r["text"] for r in sample], [r["label"] for r in sample])


def _classified(model: Model, column: pa.Array):
    """(names, scores) of the texts, a bounded number at a time."""
    texts = [t.as_py() or "" for t in column]
    names, scores = [], [np.zeros(0)]
    for start in range(0, len(texts), ROWS_AT_ONCE):
        name, score = model.classify(texts[start : start + ROWS_AT_ONCE])
        names += name
        scores.append(score)
    return names, np.concatenate(scores)


def predict(
    docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, lang_pred, score) per row; a map over the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_BYTES):
            names, scores = _classified(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores)],
                names=[id_col, "held_out", "lang_pred", "score"],
            )

    picked = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        text_of(text_col).alias("text"),
        held_out(id_col, FOLDS, HELD_OUT).alias("held_out"),
    )
    return mapped(picked, run, f"`{id_col}` long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows whose text has a known language, as ``predict`` tells it; columns unchanged.

    A text without letters goes. Without any learned language only those texts go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(column: pa.Array) -> np.ndarray:
        if not shared.value.languages:
            return np.array([bool(letters()[code_points(t.as_py())].any()) for t in column], dtype=bool)
        names, _ = _classified(shared.value, column)
        return np.array([name != UNKNOWN for name in names], dtype=bool)

    return where_text(docs, text_col, known, SLICE_BYTES)
