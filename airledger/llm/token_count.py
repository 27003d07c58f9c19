"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as its bytes. Adjacent pairs wait in a heap by (rank, place); the lowest is popped, its
right symbol is unlinked, and the two new neighbours enter the heap. A word has as many tokens as it
had symbols less the merges made; no identifier is looked up. Words repeat, so each Python worker
remembers the counts of a bounded number of words of bounded length.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a special token's string inside a text
is one token; ids may be null or repeat, every row gets its own result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import binary_lengths, mapped, text_of
from .word_bpe import Vocabulary, vocabulary

OVER_LIMIT = 2048
REMEMBERED = 1 << 19
REMEMBERED_CHARS = 40


def run_merges(symbols: list[str | None], ranks: dict[tuple[str, str], int]) -> int:
    """Merge in place, absorbed symbols becoming None, and return the number of merges."""
    size = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = [
        ranks[pair] * size + place
        for place, pair in enumerate(zip(symbols, symbols[1:]))
        if pair in ranks
    ]
    heapify(heap)
    merges = 0
    while heap:
        rank, place = divmod(heappop(heap), size)
        left, right_place = symbols[place], after[place]
        if left is None or right_place >= size:
            continue
        right = symbols[right_place]
        if ranks.get((left, right)) != rank:
            continue  # one of the two has grown since this entry was made
        joined = symbols[place] = left + right
        symbols[right_place] = None
        merges += 1
        following = after[place] = after[right_place]
        if following < size:
            before[following] = place
            rank = ranks.get((joined, symbols[following]))
            if rank is not None:
                heappush(heap, rank * size + place)
        previous = before[place]
        if previous >= 0:
            rank = ranks.get((symbols[previous], joined))
            if rank is not None:
                heappush(heap, rank * size + previous)
    return merges


class WordCounts(dict):
    """Word -> number of tokens, computed when first asked for."""

    def __init__(self, vocab: Vocabulary):
        super().__init__(dict.fromkeys(vocab.special, 1))
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        symbols = self.vocab.symbols(word)
        count = len(symbols) - run_merges(symbols, self.vocab.ranks)
        if len(word) <= REMEMBERED_CHARS:
            self[word] = count
        return count

    def of_text(self, text: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.vocab.special, 1))
        return sum(map(self.__getitem__, self.vocab.words(text)))


@lru_cache(maxsize=2)
def word_counts(path: str | None) -> WordCounts:
    return WordCounts(vocabulary(path))


def token_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    limit: int = OVER_LIMIT,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row; a map over the scan, nothing is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(path)
        for batch in batches:
            texts = batch.column(1)
            tokens = [counts.of_text(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(binary_lengths(texts), pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("text"))
    return mapped(picked, run, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")
