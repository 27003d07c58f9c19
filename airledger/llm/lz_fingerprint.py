"""Lempel-Ziv phrase fingerprints.

A text is parsed into phrases, each the shortest string not yet in the dictionary, which it then joins.
Phrases side by side spell the text, so their 64-bit hashes are sums over stretches of it. The fingerprint
holds the ``KEPT`` smallest mixed hashes of the set. Two fingerprints' likeness is the share of common
values among the ``KEPT`` smallest of both together: an estimate of the phrase sets' Jaccard index, which rises
as one text compresses well with the other's dictionary.

Neighbours: documents are dealt by ranges of ids, ``RANGE`` wide, and streamed in order of id; the first
document of a range is also dealt to the range before it, so each task knows every document's successor. Memory
holds two documents at a time. Only the ranges' first ids are ordered globally. A range in which ids repeat so often
that it holds more than ``CROWDED_ROWS`` rows is dealt in parts, by id and hash of the text, and equal rows of it are put
together before they are shuffled.

Defined cases: null and empty texts have no phrases and an empty fingerprint; two empty fingerprints
have likeness 1, an empty and another one 0. A null id comes before all ids. Rows with the same id follow each
other in order of text, in a crowded range in order of the text's hash. A single row is its own next document. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import code_points, mapped, stored, text_of
from .order import cyclic_predecessors

KEPT = 64
RANGE_BITS = 8
SPREAD = np.uint64(0x5851F42D4C957F2D)
LOWEST = -(1 << 63)
OUT_ROWS = 512
BROADCAST_ROWS = 1 << 20
#: Rows from which on a range is crowded, and the number its parts aim at.
CROWDED_ROWS = 1 << 14
ROWS_PER_PART = 1 << 12


def parse(text: str, phrases: dict[str, None], open_: str = "") -> str:
    """Continue a parse over more text: append the phrases it ends, return the open one."""
    for char in text:
        open_ += char
        if open_ not in phrases:
            phrases[open_] = None
            open_ = ""
    return open_


def phrase_hashes(text: str, lengths: np.ndarray) -> np.ndarray:
    """Mixed hashes of the phrases of the given lengths that the text starts with."""
    if not lengths.size:
        return np.empty(0, dtype=np.uint64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    points = code_points(text)[: ends[-1]].astype(np.uint64) + np.uint64(1)
    power = np.multiply.accumulate(np.full(int(lengths.max()), SPREAD))
    inside = np.arange(points.size) - np.repeat(starts, lengths)
    points *= power[inside]
    mixed = np.add.reduceat(points, starts)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest hashes, ascending, cut to 32 bits."""
    least = np.partition(hashes, KEPT - 1)[:KEPT] if hashes.size > KEPT else hashes
    return np.unique(least >> np.uint64(32)).astype(">u4")


def _lengths(phrases: Iterable[str], count: int) -> np.ndarray:
    return np.fromiter(map(len, phrases), dtype=np.int64, count=count)


def fingerprint(text: str) -> str:
    phrases: dict[str, None] = {}
    parse(text, phrases)
    return signature(phrase_hashes(text, _lengths(phrases, len(phrases)))).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    left, right = set(a.tolist()), set(b.tolist())
    if not left and not right:
        return 1.0
    least = sorted(left | right)[:KEPT]
    common = left & right
    return sum(v in common for v in least) / len(least)


class _Document:
    """A parsed text with the state of the parse where its edited form departs from it."""

    def __init__(self, doc_id, text: str):
        self.id, self.text = doc_id, text
        self.n_chars = len(text)
        self.moved = self.n_chars // 4
        self.cut = self.n_chars - self.moved
        phrases: dict[str, None] = {}
        self.open = parse(text[: self.cut], phrases)
        self.kept = phrases.copy()
        parse(text[self.cut :], phrases, self.open)
        self.hashes = phrase_hashes(text, _lengths(phrases, len(phrases)))
        self.signature = signature(self.hashes)

    def row(self, following: _Document) -> tuple:
        tail = following.text[: self.moved]
        before = len(self.kept)
        parse(tail, self.kept, self.open)
        new = _lengths(islice(self.kept, before, None), len(self.kept) - before)
        mark = signature(np.concatenate([self.hashes[:before], phrase_hashes(self.open + tail, new)]))
        edited = self.text[: self.cut] + tail
        return (
            self.id, self.n_chars, sha256(edited.encode("utf-8")).hexdigest(),
            self.signature.tobytes().hex(), mark.tobytes().hex(),
            likeness(self.signature, mark), likeness(self.signature, following.signature),
        )


COLUMNS = (
    ("n_chars", pa.int64(), "long"), ("edited_sha256", pa.string(), "string"),
    ("fingerprint", pa.string(), "string"), ("edited_fingerprint", pa.string(), "string"),
    ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double"),
)


def _parts(own: DataFrame, range_bits: int, crowded_rows: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their range, the part of it, their place in the order (at, h) and how often they stand there;
    and the first place of each part.

    A range of ids is one part, unless ids repeat so often that it is crowded.
    """
    place = F.shiftright("at", range_bits).alias("range")
    sizes = stored(own.groupBy(place).agg(F.min("at").alias("at"), F.count("*").alias("rows")), "ranges")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    whole = own.withColumns({"range": F.shiftright("at", range_bits), "part": none, "h": none, "times": one})
    firsts = sizes.select("range", none.alias("part"), "at", none.alias("h"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("rows") / ROWS_PER_PART)), F.lit(1)), F.lit(20)).cast("int")
    crowded = stored(sizes.where(F.col("rows") > crowded_rows).select("range", bits.alias("bits")), "crowded")
    many = crowded.count()
    if not many:
        return whole, firsts
    if many <= BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    light = whole.join(crowded, "range", "left_anti")
    part = F.expr(f"shiftleft(at & {(1 << range_bits) - 1}L, bits) + shiftright(h, 64 - bits) + shiftleft(1L, bits - 1)")
    heavy = (
        whole.join(crowded, "range").withColumn("h", F.xxhash64("text")).withColumn("part", part)
        .groupBy("range", "part", "at", "h", "id", "text").agg(F.count("*").alias("times"))
    )
    heavy_firsts = heavy.groupBy("range", "part").agg(F.min(F.struct("at", "h")).alias("f")).select("range", "part", "f.*")
    return light.unionByName(heavy), firsts.join(crowded, "range", "left_anti").unionByName(heavy_firsts)


def with_next(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", range_bits: int = RANGE_BITS,
    crowded_rows: int = CROWDED_ROWS,
) -> DataFrame:
    """One row per document: fingerprints of it and of its edited form, likeness to both neighbours."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn(
        "at", F.coalesce("id", F.lit(LOWEST))
    )
    placed, firsts = _parts(own, range_bits, crowded_rows)
    within = Window.partitionBy("range").orderBy("part")
    before = cyclic_predecessors(firsts.select("range"), "range")
    lasts = firsts.groupBy(F.col("range").alias("prev")).agg(F.max("part").alias("last"))
    handed = (
        firsts.withColumn("lag", F.lag("part").over(within)).join(before, "range").join(lasts, "prev")
        .select(
            "range", "part", "at", "h", F.when(F.col("lag").isNull(), F.col("prev")).otherwise(F.col("range")).alias("to_range"),
            F.coalesce("lag", "last").alias("to_part"),
        )
    )
    handed = stored(handed, "handed")
    if handed.count() <= BROADCAST_ROWS:  # six numbers a row; beyond that Spark joins by sorting
        handed = F.broadcast(handed)
    copies = placed.join(handed, ["range", "part", "at", "h"]).drop("range", "part")
    copies = copies.withColumnsRenamed({"to_range": "range", "to_part": "part"}).withColumn("copy", F.lit(True))
    dealt = placed.withColumn("copy", F.lit(False)).unionByName(copies)
    names = [id_col, *(n for n, _, _ in COLUMNS)]
    types = [pa.int64(), *(t for _, t, _ in COLUMNS)]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current, pending, closed = None, None, False
        for batch in batches:
            for range_, part, copy, doc_id, text, times in zip(*(c for c in batch.columns)):
                place, copy = (range_.as_py(), part.as_py()), copy.as_py()
                if place != current:
                    current, pending, closed = place, None, False
                if closed:
                    continue  # further rows with the place of the next part's first document
                document = _Document(doc_id.as_py(), text.as_py())
                if pending is not None:
                    rows.append(pending.row(document))
                pending, closed = document, copy
                again = 0 if copy else times.as_py() - 1
                if again:  # equal rows follow one another
                    row = _Document(doc_id.as_py(), text.as_py()).row(document)
                    for start in range(0, again, OUT_ROWS):
                        yield packed([row] * min(OUT_ROWS, again - start))
                if len(rows) >= OUT_ROWS:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)

    order = ["range", "part", "copy", "at", "h", "text"]
    in_order = dealt.repartition("range", "part").sortWithinPartitions(*order)
    schema = ", ".join([f"`{id_col}` long", *(f"{n} {s}" for n, _, s in COLUMNS)])
    return mapped(in_order.select("range", "part", "copy", "id", "text", "times"), run, schema)
