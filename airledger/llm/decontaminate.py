"""Benchmark passages inside documents, by q-gram counts in diagonal bands and banded alignment.

Texts are compared as code points with letters lowered and white space as blanks. A passage of n
characters within k = ``RATE`` * n edits of a region shares at least n + 1 - q(k + 1) of its q-grams with it (the
q-gram lemma), and all of them lie on k + 1 neighbouring diagonals. Shared q-grams are counted in bands of
diagonals that overlap by k, so some band holds all of a region's. Bands that reach the count are
verified by alignment inside the band; nothing else decides.

The passages are the stated query set: they are indexed in blocks of a fixed number of characters, and
every block is scanned against all documents. Documents are streamed; nothing is shuffled.

A passage too short for q-grams of ``Q`` characters at its budget is indexed by shorter ones. Passages under
``SHORTEST`` characters (trimmed) are searched exactly and as whole words: where one begins or ends with a letter or
digit, none adjoins it in the text.

Defined cases: null and empty texts hold nothing; passages that fold to the same text count as one, named by the
smallest item id, or by null if none has an id; ids may be null or repeat, every row is searched; without
passages every document is clean; other columns are not read.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import islice
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import code_points, folded, mapped, slices, stored, text_of, where_text

Q = 8
RATE = 0.1
SHORTEST = 20
BLOCK_CHARS = 1 << 20
SLICE_BYTES = 1 << 19
FILTER_BITS = 22
HITS_AT_ONCE = 1 << 19
BLOCKS_AT_ONCE = 4
FAR = np.uint32(0x1FFFFF)  # no character: ends every text
STEP = np.uint64(0x9E3779B97F4A7C15)


def fold(text: str) -> np.ndarray:
    return folded()[code_points(text)]


def gram_hashes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each place on, by doubling the length."""
    if points.size < q:
        return np.empty(0, dtype=np.uint64)
    part, length = points.astype(np.uint64), 1
    for bit in bin(q)[3:]:
        grown = part[:-length] * STEP ** np.uint64(length) + part[length:]
        part, length = grown, 2 * length
        if bit == "1":
            part, length = part[:-1] * STEP + points[length:], length + 1
    part ^= part >> np.uint64(32)
    part *= STEP
    return part ^ (part >> np.uint64(29))


def gram_size(length: int, rate: float) -> int:
    """The longest q-gram, up to ``Q``, that a passage surely shares at the rate's edits."""
    return max(1, min(Q, length // (int(rate * length) + 1)))


def edit_budget(length: int, rate: float, q: int) -> int:
    """The allowed edits: the rate's share, but no more than leave one q-gram sure to be shared."""
    return max(0, min(int(rate * length), (length - q) // q))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys with their counts, each key once."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=keys.size)
    return keys, counts.astype(np.int64)


@dataclass
class Passages:
    """The index of one block of passages."""

    ids: list[int | None]
    texts: list[np.ndarray]
    budget: np.ndarray  # allowed edits
    step: np.ndarray  # diagonals from band to band
    needed: np.ndarray  # shared q-grams
    grams: np.ndarray  # sorted hashes, one per distinct q-gram
    first: np.ndarray  # of each hash, into owner and place
    owner: np.ndarray
    place: np.ndarray
    maybe: np.ndarray  # hash prefix -> may be in grams
    q: int = Q

    @staticmethod
    def build(items: list[tuple[int | None, str]], rate: float, q: int = Q) -> Passages:
        texts = [fold(text) for _, text in items]
        sizes = np.array([t.size for t in texts], dtype=np.int64)
        budget = np.array([edit_budget(int(n), rate, q) for n in sizes], dtype=np.int64)
        hashes = [gram_hashes(t, q) for t in texts]
        every = np.concatenate([*hashes, np.empty(0, dtype=np.uint64)])
        owner = np.repeat(np.arange(len(texts)), [h.size for h in hashes])
        place = np.concatenate([*(np.arange(h.size) for h in hashes), np.empty(0, dtype=np.int64)])
        order = np.argsort(every, kind="stable")
        grams, first = np.unique(every[order], return_index=True)
        maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        maybe[grams >> np.uint64(64 - FILTER_BITS)] = True
        return Passages(
            [i for i, _ in items], texts, budget, budget + 16, sizes + 1 - q * (budget + 1), grams,
            np.append(first, every.size), owner[order], place[order], maybe, q,
        )

    def candidates(self, points: np.ndarray, starts: np.ndarray):
        """(document, passage, lowest diagonal) of the bands with enough shared q-grams.

        ``points`` holds several folded documents, each ended by FAR; ``starts`` are their first places.
        """
        hashes = gram_hashes(points, self.q)
        hits = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
        at = np.searchsorted(self.grams, hashes[hits])
        real = at < self.grams.size
        real[real] = self.grams[at[real]] == hashes[hits[real]]
        hits, at = hits[real], at[real]
        if not hits.size:
            return (np.empty(0, np.int64),) * 3
        many = self.first[at + 1] - self.first[at]
        document = np.searchsorted(starts, hits, side="right") - 1
        spot = hits - starts[document]
        # Every band of any diagonal has a place of its own in a key.
        low = -int(max(t.size for t in self.texts)) // int(self.step.min()) - 2
        span, items = int(spot.max()) // int(self.step.min()) + 2 - low, len(self.texts)
        held = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        waiting = 0
        ends = np.cumsum(many)
        start = done = 0
        while done < ends[-1]:
            # So many shared q-grams at a time, at most; a single place may be split.
            stop = int(np.searchsorted(ends, done + HITS_AT_ONCE, side="right"))
            upto = min(done + HITS_AT_ONCE, int(ends[-1]))
            rows = np.arange(start, min(stop + 1, ends.size))
            first = np.maximum(done, ends[rows] - many[rows])
            number = np.minimum(upto, ends[rows]) - first
            rows, first, number = rows[number > 0], first[number > 0], number[number > 0]
            inner = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            skipped = first - (ends[rows] - many[rows])
            entry = np.repeat(self.first[at[rows]] + skipped, number) + inner
            owner = self.owner[entry]
            diagonal = np.repeat(spot[rows], number) - self.place[entry]
            step = self.step[owner]
            band = diagonal // step
            key = (np.repeat(document[rows], number) * items + owner) * span + (band - low)
            shared = diagonal - band * step < self.budget[owner]  # also in the overlap with the band before
            held.append(np.unique(np.r_[key, key[shared] - 1], return_counts=True))
            waiting += held[-1][0].size
            if waiting > 2 * held[0][0].size + HITS_AT_ONCE:
                held, waiting = [_summed(held)], 0
            start, done = stop, upto
        keys, counts = _summed(held)
        owner = keys // span % items
        enough = counts >= self.needed[owner]
        keys, owner = keys[enough], owner[enough]
        return keys // span // items, owner, (keys % span + low) * self.step[owner]

    def search(self, documents, points, starts, every: bool) -> list[tuple[int, int, int, int, int]]:
        return verified(self, documents, self.candidates(points, starts), every)


@lru_cache(maxsize=1)
def word_characters() -> np.ndarray:
    """Code point -> letter, mark or digit."""
    table_ = np.zeros(int(FAR) + 1, dtype=bool)
    table_[: sys.maxunicode + 1] = [category(chr(point))[0] in "LMN" for point in range(sys.maxunicode + 1)]
    return table_


@dataclass
class Words:
    """The index of passages too short for edits, by length."""

    ids: list[int | None]
    texts: list[np.ndarray]
    lengths: list[tuple[int, np.ndarray, np.ndarray]]  # characters, sorted hashes, their passages

    @staticmethod
    def build(items: list[tuple[int | None, str]]) -> Words:
        texts = [fold(text) for _, text in items]
        lengths = []
        for size in sorted({t.size for t in texts}):
            owner = np.array([i for i, t in enumerate(texts) if t.size == size])
            hashes = np.array([gram_hashes(texts[i], size)[0] for i in owner])
            order = np.argsort(hashes)
            lengths.append((size, hashes[order], owner[order]))
        return Words([i for i, _ in items], texts, lengths)

    def search(self, documents, points, starts, every: bool) -> list[tuple[int, int, int, int, int]]:
        """(document, passage, start, end, 0) of the whole words equal to a passage, without overlap."""
        out, word = [], word_characters()
        for size, grams, owners in self.lengths:
            hashes = gram_hashes(points, size)
            at = np.searchsorted(grams, hashes)
            hits = np.flatnonzero(grams[np.minimum(at, grams.size - 1)] == hashes)
            owner = owners[at[hits]]
            wanted = np.stack([self.texts[i] for i in owners])[at[hits]]
            before, after = points[hits - 1], points[hits + size]  # FAR ends the last text
            real = (points[hits[:, None] + np.arange(size)] == wanted).all(axis=1)
            real &= ~(word[wanted[:, 0]] & word[before]) & ~(word[wanted[:, -1]] & word[after])
            hits, owner = hits[real], owner[real]
            document = np.searchsorted(starts, hits, side="right") - 1
            ends: dict[tuple[int, int], int] = {}
            for d, o, start in zip(document.tolist(), owner.tolist(), (hits - starts[document]).tolist()):
                if start >= ends.get((d, o), 0):
                    ends[d, o] = start + size
                    out.append((d, o, start, start + size, 0))
        return out


def indexes(items: list[tuple[int | None, str]], rate: float) -> list[Passages | Words]:
    """The indexes of a block of passages, by how each must be searched."""
    groups: dict[int, list[tuple[int | None, str]]] = {}
    for item in items:
        size = len(item[1])
        groups.setdefault(gram_size(size, rate) if size >= SHORTEST else 0, []).append(item)
    return [Passages.build(some, rate, q) if q else Words.build(some) for q, some in sorted(groups.items())]


def band_distance(
    passage: np.ndarray, texts: list[np.ndarray], lows: np.ndarray, width: int, from_start: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of the passage against a stretch of each text, and the stretch's end.

    The stretch starts on one of the ``width`` diagonals from ``lows`` on (at the text's first place with
    ``from_start``); alignments stay inside the band. Ties end at the first place.
    """
    size = passage.size
    window = np.full((len(texts), size + width), FAR, dtype=np.uint32)
    for row, (text, low) in enumerate(zip(texts, lows)):
        a, b = max(0, low), min(text.size, low + size + width)
        if b > a:
            window[row, a - low : b - low] = text[a:b]
    ramp = np.arange(width)
    cost = np.zeros((len(texts), width), dtype=np.int64)
    if from_start:
        skipped = ramp + lows[:, None]
        cost += np.where(skipped >= 0, skipped, size + width)
    for i in range(size):
        best = cost + (window[:, i : i + width] != passage[i])
        best[:, :-1] = np.minimum(best[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(best - ramp, axis=1) + ramp
    end = cost.argmin(axis=1)
    return cost[np.arange(len(texts)), end], lows + size + end


class Spans:
    """Regions of one passage in one document that do not overlap, in order."""

    def __init__(self):
        self.taken: list[tuple[int, int, int]] = []  # start, end, edits

    def add(self, start: int, end: int, edits: int) -> bool:
        """Keep the region unless a kept one overlaps it."""
        at = bisect_left(self.taken, (start,))
        if at and self.taken[at - 1][1] > start or at < len(self.taken) and self.taken[at][0] < end:
            return False
        self.taken.insert(at, (start, end, edits))
        return True

    def inside(self, a: int, b: int) -> list[tuple[int, int]]:
        """The parts of kept regions between two places."""
        first, last = bisect_left(self.taken, (a,)), bisect_left(self.taken, (b,))
        near = self.taken[max(0, first - 1) : last]
        return [(max(start, a), min(end, b)) for start, end, _ in near if end > a]


def exact_hits(passage: np.ndarray, text: np.ndarray, places: list[tuple[int, int]]) -> Iterator[int]:
    """Where the passage stands in the given stretches of the text, without overlap."""
    wanted, done = passage.tobytes(), 0
    stretches: list[list[int]] = []
    for a, b in sorted((max(0, a), max(0, b)) for a, b in places):
        if stretches and a <= stretches[-1][1]:
            stretches[-1][1] = max(b, stretches[-1][1])
        else:
            stretches.append([a, b])
    for a, b in stretches:
        a = max(a, done)
        region = text[a:b].tobytes()
        at = region.find(wanted)
        while at >= 0:
            if at % 4:
                at = region.find(wanted, at + 1)
                continue
            yield a + at // 4
            done = a + at // 4 + passage.size
            at = region.find(wanted, at + len(wanted))


def stretch(passage: np.ndarray, text: np.ndarray, end: int, k: int, offset: int) -> tuple[int, int]:
    """The shortest stretch up to ``end`` with the fewest edits, without hidden places at its ends."""
    end = min(end, text.size)
    while text[end - 1] == FAR:
        end -= 1
    back = text[max(0, end - passage.size - k) : end][::-1]
    _, size = band_distance(passage[::-1], [back], np.array([-k]), 2 * k + 1, from_start=True)
    start = max(0, end - int(size[0]))
    while text[start] == FAR:
        start += 1
    return offset + start, offset + end


def verified(
    passages: Passages, documents: list[np.ndarray], found, every: bool = True
) -> list[tuple[int, int, int, int, int]]:
    """(document, passage, start, end, edits) of the regions within budget that do not overlap.

    Of regions of one passage that overlap, the one with the fewest edits counts, then the first. Without
    ``every`` a document's search for a passage ends with the first regions found.
    """
    kept: dict[tuple[int, int], Spans] = {}
    bands: dict[int, dict[int, list[tuple[int, int]]]] = {}
    for document, owner, low in zip(*(x.tolist() for x in found)):
        # An alignment may leave the band of its q-grams by the budget on either side.
        k, step = int(passages.budget[owner]), int(passages.step[owner])
        a, b = low - k, low + passages.texts[owner].size + step + 2 * k + 1
        bands.setdefault(owner, {}).setdefault(document, []).append((a, b))
    for owner, places in bands.items():
        passage, k = passages.texts[owner], int(passages.budget[owner])
        width, shortest = int(passages.step[owner]) + 3 * k + 1, passage.size - k
        for document, windows in places.items():
            spans = kept[document, owner] = Spans()
            for start in exact_hits(passage, documents[document], windows):
                spans.add(start, start + passage.size, 0)
        todo = [(d, max(0, a), b) for d, windows in places.items() for a, b in windows]
        while todo:
            # Only windows with room for one more region; regions found are hidden from the alignment.
            open_, hidden = [], []
            for d, a, b in todo:
                if not every and kept[d, owner].taken:
                    continue
                text = documents[d][a : max(a, b)]
                known = kept[d, owner].inside(a, a + text.size)
                if known:
                    borders = [a, *(x for span in known for x in span), a + text.size]
                    if max(y - x for x, y in zip(borders[::2], borders[1::2])) < shortest:
                        continue
                    text = text.copy()
                    for x, y in known:
                        text[x - a : y - a] = FAR
                open_.append((d, a, b))
                hidden.append(text)
            near: dict[int, list[tuple[int, int, int]]] = {}
            for at in range(0, len(open_), 256):
                some, texts = open_[at : at + 256], hidden[at : at + 256]
                lows = np.array([b - passage.size - width - a for _, a, b in some])  # 0, or before the text
                edits, ends = band_distance(passage, texts, lows, width)
                for (d, a, _), text, edit, end in zip(some, texts, edits.tolist(), ends.tolist()):
                    if edit <= k:
                        near.setdefault(d, []).append((edit, *stretch(passage, text, end, k, a)))
            grown = {
                d for d, regions_ in near.items()
                if any([kept[d, owner].add(start, end, edit) for edit, start, end in sorted(regions_)])
            }
            todo = [window for window in open_ if window[0] in grown]
    return [(d, o, s, e, n) for (d, o), spans in kept.items() for s, e, n in spans.taken]


def passage_blocks(
    benchmark: DataFrame, *, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS
) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct passages, folded as documents are, a bounded number of characters at a time."""

    def folded_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [fold(t.as_py()).astype("<u4").tobytes().decode("utf-32-le").strip(" ") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    picked = benchmark.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    distinct = (
        mapped(picked, folded_texts, "id long, text string")
        .filter(F.char_length("text") > 0)
        .groupBy("text")
        .agg(F.min("id").alias("id"))
    )
    block, held = [], 0
    for row in distinct.orderBy("id", "text").toLocalIterator():
        block.append((row["id"], row["text"]))
        held += len(row["text"])
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def _search(parts: list[Passages | Words], column: pa.Array, first: int = 0, every: bool = True):
    """(document, index, passage, start, end, edits) of the regions in the documents of a batch; indexes are
    numbered from ``first`` on."""
    documents = [fold(t.as_py() or "") for t in column]
    points = np.concatenate([x for d in documents for x in (d, [FAR])] or [np.empty(0)]).astype(np.uint32)
    starts = np.cumsum([0, *(d.size + 1 for d in documents)])[:-1]
    return [
        (row[0], number, *row[1:])
        for number, part in enumerate(parts, first) for row in part.search(documents, points, starts, every)
    ]


def regions(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", rate: float = RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item, start, end, edits): every region of a passage in a document; those of one passage do not overlap."""
    spark = docs.sparkSession
    schema = f"`{id_col}` long, `{item_col}` long, start long, end long, edits int"
    picked = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("text"))
    found = [spark.createDataFrame([], schema)]
    for parts in _shared_indexes(spark, benchmark, item_col, rate, block_chars):

        def run(batches: Iterable[pa.RecordBatch], parts=parts) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, SLICE_BYTES):
                rows, passages = [], []
                for block in parts:
                    rows += _search(block.value, batch.column(1), len(passages))
                    passages += block.value
                if not rows:
                    continue
                rows.sort()
                at = [r[0] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int64())),
                        pa.array([passages[r[1]].ids[r[2]] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.int64()),
                        pa.array([r[4] for r in rows], pa.int64()),
                        pa.array([r[5] for r in rows], pa.int32()),
                    ],
                    names=[id_col, item_col, "start", "end", "edits"],
                )

        found.append(mapped(picked, run, schema))
    return reduce(DataFrame.unionByName, found[1:] or found)


def _shared_indexes(
    spark: SparkSession, benchmark: DataFrame, item_col: str, rate: float, block_chars: int
) -> Iterator[list[Broadcast]]:
    """The blocks' indexes, as many at a time as one worker holds."""
    blocks = passage_blocks(benchmark, id_col=item_col, text_col="text", block_chars=block_chars)
    while some := list(islice(blocks, BLOCKS_AT_ONCE)):
        yield [spark.sparkContext.broadcast(indexes(block, rate)) for block in some]


def clean(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    rate: float = RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents that hold no passage, columns unchanged.

    A pass over the documents searches ``BLOCKS_AT_ONCE`` blocks of passages, one after the other in the same worker; a long
    benchmark takes several passes, each over what the one before kept and stored.
    """
    last = None
    for parts in _shared_indexes(docs.sparkSession, benchmark, item_col, rate, block_chars):

        def holds_none(column: pa.Array, parts=parts) -> np.ndarray:
            kept = np.ones(len(column), dtype=bool)
            for block in parts:
                open_ = np.flatnonzero(kept)
                if not open_.size:
                    break
                found = _search(block.value, column.take(pa.array(open_)), every=False)
                kept[open_[[r[0] for r in found]]] = False
            return kept

        if last is not None:
            docs = stored(last, "clean")
        last = where_text(docs, text_col, holds_none, SLICE_BYTES)
    return docs if last is None else last
