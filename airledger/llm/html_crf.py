"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Every leaf block of a page is main text or not. Its features are the elements around it (names and the words of
their class, id and role), its own element, its neighbours' elements, and its text: length, link share, punctuation, signs, and
the words of short blocks. The chain's weights are fitted by conditional likelihood on labelled pages that
``html_pages`` writes by rule; Viterbi decoding labels a page's blocks together.

Defined cases: a null or empty page, and one without main text, gives the empty text of length 0; broken
markup ends at the end of the page; ids may be null or repeat, every row gets its own result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mapped
from .html_blocks import Block, Path, blocks, described
from .html_pages import labelled_pages

PAGES = 400
STEPS = 150
RATE = 0.1
DECAY = 0.02
SHORT = 60
JOINT = "\n\n"
SLICE_ROWS = 256

WORD = re.compile(r"[^\W\d_]+")


def element_features(element: str) -> tuple[list[str], list[str]]:
    """(features of all blocks inside an element, features of those directly in it)."""
    name, marks = described(element)
    return ["in:" + name, *("mark:" + m for m in marks if m not in ("class", "id", "role"))], ["own:" + name]


def path_features(path: tuple[str, ...]) -> list[str]:
    """The elements around a block: each name, each marking word, and the two innermost names."""
    found = dict.fromkeys(f for element in path for f in element_features(element)[0])
    found |= dict.fromkeys(f for element in path[-1:] for f in element_features(element)[1])
    if len(path) > 1:
        found["pair:" + described(path[-2])[0] + ">" + described(path[-1])[0]] = None
    if not any(described(e)[1] for e in path):
        found["unmarked"] = None
    return list(found)


def text_features(block: Block) -> list[str]:
    text = block.text
    size = len(text)
    share = block.linked / size
    out = [
        "size:%d" % min(size.bit_length(), 10),
        "links:%d" % (0 if share < 0.1 else 1 if share < 0.6 else 2),
        "ends:" + (text[-1] if text[-1] in ".?!:;,…" else "other"),
    ]
    if "," in text or ". " in text:
        out.append("flowing")
    if size < SHORT:
        out += ["word:" + w for w in {w.lower() for w in WORD.findall(text)}]
    for sign in "©|»›→":
        if sign in text:
            out.append("sign:" + sign)
    if text.isupper():
        out.append("upper")
    return out


@dataclass
class Chain:
    """Weights of the field: emission of "main" per feature, and between neighbouring labels."""

    weights: dict[str, float]
    step: np.ndarray  # from label, to label
    first: np.ndarray
    last: np.ndarray

    def _around(self, path: Path | None) -> float:
        """What the elements around a block say, each worked out once from the one it lies in.

        An element keeps (its own sum, the weighed features seen down to it, whether all are unmarked, sum for blocks in it).
        """
        weights = self.weights
        todo, here = [], path
        while here is not None and (here.score is None or here.score[0] is not self):
            todo.append(here)
            here = here.parent
        for node in reversed(todo):
            _, total, seen, plain, _ = node.parent.score if node.parent else (self, 0.0, frozenset(), True, 0.0)
            inside, own = element_features(node.element)
            new = {f for f in inside if f in weights and f not in seen}
            total += sum(weights[f] for f in sorted(new))
            name, marks = described(node.element)
            plain = plain and not marks
            direct = total + sum(weights.get(f, 0.0) for f in own) + (weights.get("unmarked", 0.0) if plain else 0.0)
            if node.parent:
                direct += weights.get(f"pair:{described(node.parent.element)[0]}>{name}", 0.0)
            node.score = (self, total, seen | new if new else seen, plain, direct)
        return path.score[-1] if path else weights.get("unmarked", 0.0)

    def emissions(self, page: list[Block]) -> list[float]:
        weights = self.weights
        return [
            self._around(block.around) + sum([weights.get(f, 0.0) for f in text_features(block)]) for block in page
        ]

    def decode(self, page: list[Block]) -> list[int]:
        """The most likely labels of the whole page (Viterbi)."""
        if not page:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        scores = self.emissions(page)
        off, on = self.first[0], self.first[1] + scores[0]
        back = []
        for score in scores[1:]:
            from_off, from_on = off + s01 >= on + s11, off + s00 >= on + s10
            back.append((0 if from_on else 1, 0 if from_off else 1))
            off, on = max(off + s00, on + s10), max(off + s01, on + s11) + score
        label = int(on + self.last[1] > off + self.last[0])
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]

    def extract(self, html: str | None) -> str:
        page = blocks(html or "")
        return JOINT.join(b.text for b, main in zip(page, self.decode(page)) if main)


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(pages: list[tuple[list[Block], list[int]]]) -> Chain:
    """Maximum conditional likelihood with weight decay, by Adam on all pages at once."""
    names: dict[str, int] = {}
    longest = max(len(p) for p, _ in pages)
    rows, columns = [], []
    labels = np.zeros((len(pages), longest), dtype=np.int64)
    real = np.zeros((len(pages), longest), dtype=bool)
    for number, (page, marks) in enumerate(pages):
        labels[number, : len(marks)], real[number, : len(marks)] = marks, True
        for place, block in enumerate(page):
            for feature in (*path_features(block.path), *text_features(block)):
                rows.append(number * longest + place)
                columns.append(names.setdefault(feature, len(names)))
    row, column = np.array(rows), np.array(columns)
    rare = np.bincount(column) < 8
    lengths = real.sum(axis=1)
    ends = (np.arange(len(pages)), lengths - 1)
    size = len(names)
    params = np.zeros(size + 8)
    first_moment, second_moment = np.zeros_like(params), np.zeros_like(params)
    chain_on = real[:, 1:] & real[:, :-1]
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (labels[:, :-1][chain_on], labels[:, 1:][chain_on]), 1)
    seen_first = np.bincount(labels[:, 0], minlength=2)
    seen_last = np.bincount(labels[ends], minlength=2)
    for number in range(1, STEPS + 1):
        weights, step = params[:size], params[size : size + 4].reshape(2, 2)
        start, stop = params[size + 4 : size + 6], params[size + 6 :]
        score = np.bincount(row, weights=weights[column], minlength=real.size).reshape(real.shape)
        emit = np.stack([np.zeros_like(score), score], axis=2)
        ahead = np.zeros((longest, len(pages), 2))
        behind = np.zeros((longest, len(pages), 2))
        ahead[0] = start + emit[:, 0]
        for t in range(1, longest):
            moved = _log_sum(ahead[t - 1][:, :, None] + step, 1) + emit[:, t]
            ahead[t] = np.where(real[:, t, None], moved, ahead[t - 1])
        behind[:] = stop
        for t in range(longest - 2, -1, -1):
            moved = _log_sum(step[None] + (emit[:, t + 1] + behind[t + 1])[:, None, :], 2)
            behind[t] = np.where(real[:, t + 1, None], moved, stop)
        total = _log_sum(ahead[-1] + stop, 1)
        here = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2)
        both = np.exp(
            ahead[:-1][:, :, :, None] + step + (emit.transpose(1, 0, 2)[1:] + behind[1:])[:, :, None, :]
            - total[None, :, None, None]
        ).transpose(1, 0, 2, 3)
        miss = np.where(real, labels - here[:, :, 1], 0.0).ravel()
        grad = np.concatenate([
            np.bincount(column, weights=miss[row], minlength=size),
            (seen_steps - both[chain_on].sum(axis=0)).ravel(),
            seen_first - here[:, 0].sum(axis=0),
            seen_last - here[ends].sum(axis=0),
        ]) / len(pages) - DECAY / len(pages) * params * 10
        first_moment = 0.9 * first_moment + 0.1 * grad
        second_moment = 0.99 * second_moment + 0.01 * grad**2
        params = params + RATE * (first_moment / (1 - 0.9**number)) / (
            np.sqrt(second_moment / (1 - 0.99**number)) + 1e-8
        )
        params[:size][rare] = 0.0
    weights = {n: float(params[i]) for n, i in names.items() if params[i]}
    return Chain(weights, params[size : size + 4].reshape(2, 2), params[size + 4 : size + 6], params[size + 6 :])


def train(pages: int = PAGES, seed: int = 1) -> Chain:
    """Fit the field to a fixed number of written pages."""
    learned = []
    for html, marks in labelled_pages(pages, seed):
        page = blocks(html)
        if [b.text for b in page] != [text for text, _ in marks]:
            raise ValueError("a written page does not parse into the blocks it was written with")
        learned.append((page, [label for _, label in marks]))
    return fit(learned)


def main_texts(
    pages: DataFrame, chain: Chain, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) per page; a map over the scan."""
    shared = pages.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                texts = [shared.value.extract(h.as_py()) for h in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=[id_col, url_col, "text", "n_chars"],
                )

    picked = pages.select(
        F.col(id_col).cast("long").alias(id_col),
        F.col(url_col).cast("string").alias(url_col),
        F.col(html_col).cast("string").alias("html"),
    )
    return mapped(picked, run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
