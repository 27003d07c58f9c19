"""Byte-pair encoding and decoding with forced boundaries.

Two neighbouring byte symbols that stand side by side inside no token of the vocabulary can never end
up in one token, so the word is cut there at once. The fragments are merged independently and their
ids concatenated; no merge could have crossed a cut, so the ids are those of the whole word.

Decoding joins the tokens' strings by one blank, as the library does for files without a decoder.

Defined cases: a null or empty text has no ids and decodes to the empty text; a special token's string
inside a text is its id; unknown ids decode to nothing; ids of rows may be null or repeat.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mapped, text_of
from .token_count import run_merges
from .word_bpe import Vocabulary, vocabulary

REMEMBERED = 400_000
REMEMBERED_CHARS = 40


class Codec:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.joined = self._neighbours()
        self._words: dict[str, tuple[str, str, int]] = {}

    def _neighbours(self) -> set[tuple[str, str]]:
        """Pairs of adjacent byte symbols that occur inside some token; all others are cuts."""
        end, pairs = self.vocab.end, set()
        for token in self.vocab.ids:
            body = token[: -len(end)] if end and token.endswith(end) else token
            symbols = list(body)
            if body != token and symbols:
                symbols[-1] += end
            pairs.update(zip(symbols, symbols[1:]))
        return pairs

    def fragments(self, word: str) -> list[list[str]]:
        symbols = self.vocab.symbols(word)
        cuts = [i + 1 for i, pair in enumerate(zip(symbols, symbols[1:])) if pair not in self.joined]
        edges = [0, *cuts, len(symbols)]
        return [symbols[a:b] for a, b in zip(edges, edges[1:])]

    def word_ids(self, word: str) -> list[int]:
        if word in self.vocab.special:
            return [self.vocab.special[word]]
        out = []
        for fragment in self.fragments(word):
            if len(fragment) > 1:
                run_merges(fragment, self.vocab.ranks)
            out += [self.vocab.ids[s] for s in fragment if s is not None]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for word in self.vocab.words(text) for i in self.word_ids(word)]

    def decode(self, ids: Iterable[int], skip_special_tokens: bool = False) -> str:
        skipped = set(self.vocab.special.values()) if skip_special_tokens else ()
        tokens = self.vocab.tokens
        return " ".join(tokens[i] for i in ids if i in tokens and i not in skipped)

    def _word(self, word: str) -> tuple[str, str, int]:
        ids = self.word_ids(word)
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Token count, SHA-256 of the ids as decimals, SHA-256 of the decoded text."""
        known, words = self._words, self.vocab.words(text)
        if len(known) > REMEMBERED:
            known.clear()
        long_ = {}
        for word in set(words):
            if word not in known:
                (known if len(word) <= REMEMBERED_CHARS else long_)[word] = self._word(word)
        parts = [known[w] if w in known else long_[w] for w in words] if long_ else [known[w] for w in words]
        ids = " ".join([p[0] for p in parts])
        decoded = " ".join([p[1] for p in parts])
        return (
            sum([p[2] for p in parts]),
            sha256(ids.encode()).hexdigest(),
            sha256(decoded.encode("utf-8")).hexdigest(),
        )


@lru_cache(maxsize=2)
def codec(path: str | None = None) -> Codec:
    return Codec(vocabulary(path))


def encoded(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """(id, ids, decoded) per row: the token ids and the text they decode to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = [own.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([own.decode(i) for i in ids], pa.string()),
                ],
                names=[id_col, "ids", "decoded"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("text"))
    return mapped(picked, run, f"`{id_col}` long, ids array<int>, decoded string")


def encoded_digests(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row; a map over the scan, nothing is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            done = [own.digest(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([d[0] for d in done], pa.int64()),
                    pa.array([d[1] for d in done], pa.string()),
                    pa.array([d[2] for d in done], pa.string()),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("text"))
    return mapped(
        picked, run, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
