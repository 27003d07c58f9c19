"""Phrases whose words stand together more often than chance, found by Rabin-Karp fingerprints.

A slice of texts is lowered and its words are laid out with one blank between them. Prefix polynomials over that
line give the fingerprint of every phrase by two look-ups, whatever its length. Tasks count equal fingerprints, Spark
sums (fingerprint, count) rows. A phrase can be frequent only if its parts are, so words are counted first, then
pairs of frequent words, then longer phrases made of frequent pairs. The frequent fingerprints of a level reach the tasks
as a Bloom filter of bounded size: what it lets through by mistake costs a row, never a result.

At the end the frequent phrases alone take shape: in every slice each such fingerprint points to its first occurrence,
all its occurrences are compared with that one byte by byte (those that differ are counted by their own text), and
the text cut there goes through the shuffle with its count. So the counts are those of texts; equal fingerprints
of different phrases can only bring in a phrase that the exact count drops again.

A text of any length is read in blocks. A block ends where a piece ends, or repeats the last words before it, which
then only serve phrases that go on into the block.

Defined cases: a null text is empty; a null language is ``und``, together with rows that say so; equal rows count as often
as they stand there; ties as the contract of ``collocations`` says; an empty table gives an empty result; ids and other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import bloom
from .common import mapped, slices, stored, text_of
from .polynomials import Prefixes

NO_LANGUAGE = "und"
MOST_WORDS = 5
LEAST_TIMES = 100
MOST_PER_LANGUAGE = 2000
SHARE = 100
SCALE = 1000

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
BLOCK_BYTES = 15 << 15  # with the line's breaks below the table of powers that is remembered
COMPARED_AT_ONCE = 1 << 20
BITS_PER_KEY = 12
HASHES = 4

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = _BLANK
_KIND[list(BREAKS)] = _BREAK
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A") : ord("Z") + 1] += 32
_ONWARD = re.compile(b"[^%s]+|[%s]" % (re.escape(BLANKS + BREAKS), re.escape(BREAKS)))


def blocks(text: bytes, most: int) -> Iterator[tuple[int, bytes, int]]:
    """Parts of about ``most`` bytes as (place, bytes, number of its first words that were in a part before)."""
    start = done = piece = repeated = 0
    while len(text) - start > most:
        end = start + most
        cut = max(text.rfind(bytes([b]), start, end) for b in BREAKS) + 1
        if cut <= start:
            cut = max(text.rfind(bytes([b]), start, end) for b in BLANKS) + 1
            if not text[done:cut].strip(BLANKS):
                found = _ONWARD.search(text, max(done, end))  # nothing new yet: to the end of the next word
                cut = found.end() if found else len(text)
        yield start, text[start:cut], repeated
        done = cut
        if text[cut - 1] in BREAKS or cut == len(text):
            start = piece = cut
            repeated = 0
            continue
        piece = max(piece, max(text.rfind(bytes([b]), start, cut) for b in BREAKS) + 1)
        start, repeated = cut, 0
        while repeated < MOST_WORDS - 1:
            end = len(text[piece:start].rstrip(BLANKS)) + piece
            if end <= piece:
                break
            start = max(piece, max(text.rfind(bytes([b]), piece, end) for b in BLANKS) + 1)
            repeated += 1
    if start < len(text):
        yield start, text[start:], repeated


class Line:
    """The words of some texts with one blank between them; the first ``repeated`` words only lead in."""

    def __init__(self, data: bytes, language: str, repeated: int = 0):
        raw = np.frombuffer(data, np.uint8)
        kind = _KIND[raw]
        inside = kind == _WORD
        kept = inside.copy()
        kept[1:] |= inside[:-1]
        self.places = np.flatnonzero(kept)
        inside = inside[kept]
        self.text = np.where(inside, _LOW[raw[kept]], np.uint8(32))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == _BREAK)[self.places[self.starts]]
        self.repeated = repeated
        self.salt = xxhash.xxh64_intdigest(language.encode())
        self._fields = [Prefixes(self.text.astype(np.uint64) + np.uint64(1), field) for field in (0, 1)]

    def __len__(self) -> int:
        return len(self.starts)

    def fingerprints(self, at: np.ndarray, size: int) -> np.ndarray:
        """Of the phrases of ``size`` words that start with the given words; languages and sizes differ."""
        high, low = (f.between(self.starts[at], self.ends[at + size - 1]) for f in self._fields)
        return bloom.mixed(high << np.uint64(31) | low, self.salt + size).view(np.int64)

    def phrases(self, size: int, parts: np.ndarray | None = None, length: int = 0) -> np.ndarray:
        """First words of the phrases of ``size`` words inside one piece; with ``parts`` (by first word) only those
        whose parts of ``length`` words are all among them."""
        at = np.arange(max(0, len(self) - size + 1))
        at = at[self.piece[at] == self.piece[at + size - 1]]
        for step in range(size - length + 1 if parts is not None else 0):
            at = at[parts[at + step]]
        return at

    def own(self, at: np.ndarray, size: int) -> np.ndarray:
        """Which of the phrases end in a word that is not repeated."""
        return at + size - 1 >= self.repeated

    def marked(self, at: np.ndarray) -> np.ndarray:
        marks = np.zeros(len(self), dtype=bool)
        marks[at] = True
        return marks

    def frequent(self, size: int, filter_: bloom.Bloom) -> np.ndarray:
        """By first word, whether the phrase of ``size`` words seems frequent."""
        at = self.phrases(size)
        prints = self.fingerprints(at, size)
        return self.marked(at[filter_.holds(prints, prints)])

    def cut(self, at: np.ndarray, size: int) -> pa.Array:
        """The texts of the phrases."""
        starts, sizes = self.starts[at], self.ends[at + size - 1] - self.starts[at]
        ends = np.cumsum(sizes)
        data = self.text[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def counted(self, at: np.ndarray, size: int, prints: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(texts, numbers) of the phrases, exact. Equal fingerprints point at their first occurrence, and every
        occurrence is compared with that one; those that differ are counted by their own text."""
        _, first, group, number = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        own = at[first][group]
        starts, ends, sample, sample_end = self.starts[at], self.ends[at + size - 1], self.starts[own], self.ends[own + size - 1]
        differs = (ends - starts) != (sample_end - sample)
        todo = np.flatnonzero((at != own) & ~differs)
        sums = np.cumsum(ends[todo] - starts[todo])
        cuts = np.searchsorted(sums, np.arange(0, sums[-1] if len(sums) else 0, COMPARED_AT_ONCE), side="left").tolist()
        for low, high in zip(cuts, cuts[1:] + [len(todo)]):
            rows = todo[low:high]
            if not len(rows):
                continue
            sizes = ends[rows] - starts[rows]
            heads = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) + np.repeat(starts[rows] - heads, sizes)
            unlike = self.text[place] != self.text[place + np.repeat(sample[rows] - starts[rows], sizes)]
            if unlike.any():
                differs[rows] = np.add.reduceat(unlike, heads) > 0
        texts = self.cut(at[first], size)
        if not differs.any():
            return texts, number
        number = number - np.bincount(group[differs], minlength=len(number))
        strays = Counter(self.cut(at[differs], size).to_pylist())
        return (
            pa.concat_arrays([texts, pa.array(list(strays), pa.binary())]),
            np.concatenate((number, np.array(list(strays.values()), dtype=number.dtype))),
        )


def _lines(batches: Iterable[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[str, Line]]:
    """(language, line) of batches (lang, text)."""
    for batch in slices(batches, block_bytes):
        held: dict[str, list[bytes]] = {}
        for language, text in zip(*(c.to_pylist() for c in batch.columns[:2])):
            if len(text) > block_bytes:
                for _, part, repeated in blocks(text, block_bytes):
                    yield language, Line(part, language, repeated)
            else:
                held.setdefault(language, []).append(text)
        for language, texts in held.items():
            yield language, Line(b"\n".join(texts), language)


def _count(texts: DataFrame, sizes: tuple[int, ...], level: int, frequent: bloom.Bloom | None, block_bytes: int) -> DataFrame:
    """(lang, print, n) of all phrases of the sizes whose parts of ``level`` words seem frequent; with the words also
    one row per language with the number of its words and no print."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, line in _lines(batches, block_bytes):
            parts = line.frequent(level, shared.value) if level else None
            for size in sizes:
                at = line.phrases(size, parts, level)
                at = at[line.own(at, size)]
                if not level:
                    yield pa.RecordBatch.from_pydict({"lang": [language], "print": pa.nulls(1, pa.int64()), "n": [len(at)]})
                prints, number = np.unique(line.fingerprints(at, size), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.nulls(len(prints), pa.string()), "print": prints, "n": number.astype(np.int64)}
                )

    rows = mapped(texts, run, "lang string, print long, n long")
    return rows.groupBy("lang", "print").agg(F.sum("n").alias("n"))


def _materialised(texts: DataFrame, most: int, frequent: bloom.Bloom, block_bytes: int) -> DataFrame:
    """(lang, phrase, size, n) of all phrases whose fingerprint, and whose parts', seem frequent."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, line in _lines(batches, block_bytes):
            parts = None
            for size in range(1, most + 1):
                at = line.phrases(size, parts, size - 1)
                prints = line.fingerprints(at, size)
                kept = shared.value.holds(prints, prints)
                at, prints = at[kept], prints[kept]
                parts = line.marked(at)
                own = line.own(at, size)
                found, number = line.counted(at[own], size, prints[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(language, pa.string()), len(found)),
                        found,
                        pa.repeat(pa.scalar(size, pa.int32()), len(found)),
                        pa.array(number, pa.int64()),
                    ],
                    names=["lang", "phrase", "size", "n"],
                )

    rows = mapped(texts, run, "lang string, phrase binary, size int, n long")
    counted = rows.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return counted.withColumn("phrase", F.col("phrase").cast("string"))


def phrases(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
    least: int = LEAST_TIMES, most: int = MOST_WORDS, block_bytes: int = BLOCK_BYTES, most_bits: int = bloom.MOST_BITS,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``most`` words that occur ``least`` times or more, (lang, phrase, size, n), and the number of
    words of each language, (lang, n)."""
    if not 1 <= most <= MOST_WORDS:
        raise ValueError(f"phrases have 1 to {MOST_WORDS} words")
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        text_of(text_col).cast("binary").alias("text"),
    )

    def frequent(found: DataFrame, salt: int) -> bloom.Bloom:
        prints = found.where("print IS NOT NULL").select(F.col("print").alias("a"), F.col("print").alias("b"))
        return bloom.of(prints, prints.count(), BITS_PER_KEY, salt, most_bits, HASHES)

    seen = totals = below = None
    for level, sizes in enumerate([(1,), (2,), tuple(range(3, most + 1))]):
        if not sizes or sizes[0] > most:
            break
        counted = _count(texts, sizes, level, below, block_bytes)
        found = stored(counted.where((F.col("n") >= least) | F.col("lang").isNotNull()), f"phrases-{level}")
        totals = found.where("lang IS NOT NULL").select("lang", "n") if totals is None else totals
        seen = found if seen is None else seen.unionByName(found)
        below = frequent(found, level)
    whole = _materialised(texts, most, frequent(seen, 3), block_bytes)
    return stored(whole.where(F.col("n") >= least), "phrases"), totals


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def floored_ratio(scale: int, a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(scale * a * n / (left * right)) in whole numbers of up to 38 digits."""
    def whole(number: Column, digits: int = 18) -> Column:
        return number.cast(f"decimal({digits}, 0)")

    product = whole(F.lit(scale) * whole(a, 15), 19) * whole(n, 19)
    return F.call_function("div", product, whole(left) * whole(right))


def scored(frequent: DataFrame, totals: DataFrame, *, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of the phrases of two words and more: the cut with the lowest score."""
    words = F.split("phrase", " ")
    first, rest = (
        frequent.select("lang", F.col("phrase").alias(part), F.col("n").alias(count)) for part, count in (("first", "l"), ("rest", "r"))
    )
    cuts = frequent.where("size > 1").select(
        "lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _part(words, F.lit(1), F.col("k")), "rest": _part(words, F.col("k") + 1, F.col("size") - F.col("k"))})
    rated = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    score = floored_ratio(scale, F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    best = rated.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def covered(frequent: DataFrame, *, share: int = SHARE) -> DataFrame:
    """(lang, phrase, longest) of phrases inside a longer one, with the largest count of those."""
    longer = frequent.where("size > 2").select("lang", "size", "n", F.split("phrase", " ").alias("words"))
    shorter = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = shorter.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    parts = inner.select("lang", _part(F.col("words"), F.col("start"), F.col("length")).alias("phrase"), "n")
    return parts.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_TIMES, top: int = MOST_PER_LANGUAGE,
    share: int = SHARE, scale: int = SCALE, block_bytes: int = BLOCK_BYTES, most_bits: int = bloom.MOST_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to five words of each language.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` how often the parts of its weakest cut do (ties: the first cut),
    ``n`` the words of the language, and the score floor(scale * a * n / (l * r)). A phrase inside a longer frequent
    one with at least ``share`` percent of its count is left out. Order: score, a, phrase (in byte order).
    """
    frequent, totals = phrases(
        docs, text_col=text_col, lang_col=lang_col, least=least, block_bytes=block_bytes, most_bits=most_bits
    )
    rated = scored(frequent, totals, scale=scale).join(covered(frequent, share=share), ["lang", "phrase"], "left")
    own = rated.where(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = own.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
