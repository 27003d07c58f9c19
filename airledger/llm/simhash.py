"""SimHash near-duplicates with pivot distance tables.

Fingerprint: words of the text with A-Z lowered, shingles of ``width`` words joined by one blank, the
64-bit XXH64 (seed 42) of each; a bit is set if it is set in over half of the hashes.

Links: fingerprints that differ in at most ``distance`` bits. Only distinct fingerprints are compared.
They meet in buckets of equal bits: with the 64 bits in ``distance + 2`` blocks, two fingerprints within
the distance agree in some two whole blocks (about 26 bits), so no link is lost. The buckets are coarse on purpose:
what they hold together by chance is left to the pivots. Inside a bucket the
table of Hamming distances to ``PIVOTS`` fixed reference fingerprints is computed once; by the triangle
inequality a pair whose coordinates differ by more than ``distance`` anywhere is discarded, survivors
are verified bit by bit. A bucket sends on one star per connected part, never its pairs. Buckets above
``BUCKET`` members are dealt in chunks, and every pair of chunks is one piece of work, so a bucket of any
size is compared whole in bounded pieces.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; copies share a
fingerprint; null ids never become a component's id unless it holds no other (then the id is null);
repeated rows each get a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import mapped, stored, text_of
from .components import components

SEED = 42
WIDTH = 3
DISTANCE = 3
PIVOTS = 24
BUCKET = 4096
SHINGLES_AT_ONCE = 1 << 16

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The 64-bit fingerprint of UTF-8 text, unsigned."""
    words = WORD.findall(text.translate(LOWER))
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, dtype=np.int64), len(last)
    for at in range(0, total, SHINGLES_AT_ONCE):
        spans = zip(starts[at : at + SHINGLES_AT_ONCE], last[at : at + SHINGLES_AT_ONCE])
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """(id, fp, row_key, row_check): fp holds the 64 bits as a signed long; the others are two hashes of id and text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2), batch.column(3)],
                names=["id", "fp", *ROW_KEY],
            )

    picked = docs.select(
        F.col(id_col).cast("long").alias("id"),
        text_of(text_col).cast("binary").alias("text"),
        *row_keys(id_col, text_col),
    )
    return mapped(picked, run, "id long, fp long, row_key long, row_check long")


#: Two hashes that tell rows of different id or text apart, 128 bits together.
ROW_KEY = ("row_key", "row_check")


def row_keys(id_col: str, text_col: str, names: tuple[str, str] = ROW_KEY) -> list[Column]:
    values = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return [F.xxhash64(*values).alias(names[0]), F.xxhash64(F.lit(names[1]), *values).alias(names[1])]


def block_masks(distance: int) -> list[int]:
    """Masks of every choice of two among ``distance + 2`` blocks of bits, as signed longs."""
    blocks = distance + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(masks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def pivot_prints(count: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints, spread by hashing their number."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(count)], dtype=np.uint64)


def pivot_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ pivots[None, :]).astype(np.int8)


def local_stars(prints: np.ndarray, table: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Indices (member, least member) of the connected parts among distinct prints of one bucket."""
    stars, open_ = [], np.argsort(prints.view(np.int64), kind="stable")
    while open_.size > 1:
        root, open_ = open_[0], open_[1:]
        waiting = [root]
        while waiting and open_.size:
            at = waiting.pop()
            close = np.abs(table[open_] - table[at]).max(axis=1) <= distance
            survivors = np.flatnonzero(close)
            near = survivors[np.bitwise_count(prints[open_[survivors]] ^ prints[at]) <= distance]
            if near.size:
                found = open_[near]
                stars += [(int(i), int(root)) for i in found]
                waiting += found.tolist()
                open_ = np.delete(open_, near)
    return stars


def _bucket_links(distance: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = pivot_prints()
        names = ("table_no", "bucket", "low", "high", "fp")
        kept = [np.empty(0, dtype=np.int64) for _ in names]

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            group, prints = np.stack(columns[:4]), columns[4].view(np.uint64)
            table = pivot_table(prints, pivots)
            edges = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            starts, ends = np.r_[0, edges], np.r_[edges, prints.size]
            pairs = starts[ends - starts == 2]
            pairs = pairs[np.abs(table[pairs] - table[pairs + 1]).max(axis=1, initial=0) <= distance]
            pairs = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= distance]
            a, b = [columns[4][pairs]], [columns[4][pairs + 1]]
            for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                stars = local_stars(prints[start:end], table[start:end], distance)
                if stars:
                    member, root = np.array(stars).T + start
                    a.append(columns[4][member])
                    b.append(columns[4][root])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [
                np.concatenate([old, batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)])
                for old, n in zip(kept, names)
            ]
            group = np.stack(columns[:4])
            change = np.flatnonzero((group != group[:, -1:]).any(axis=0))
            cut = int(change[-1]) + 1 if change.size else 0  # the last group may go on in the next batch
            kept = [c[cut:] for c in columns]
            if cut:
                yield links([c[:cut] for c in columns])
        if kept[0].size:
            yield links(kept)

    return run


def fingerprint_links(distinct: DataFrame, *, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within the distance, directly or by others."""
    keys = [
        F.struct(F.lit(n).cast("byte").alias("table_no"), F.col("fp").bitwiseAND(F.lit(m)).alias("bucket"))
        for n, m in enumerate(block_masks(distance))
    ]
    keyed = distinct.select("fp", F.inline(F.array(*keys)))
    sizes = keyed.groupBy("table_no", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / bucket).cast("int")
    dealt = (
        keyed.join(sizes, ["table_no", "bucket"])
        .withColumn("chunks", chunks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "table_no", "bucket", F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"), "fp",
        )
    )
    place = ["table_no", "bucket", "low", "high"]
    in_order = dealt.repartition(*place).sortWithinPartitions(*place)
    return mapped(in_order, _bucket_links(distance), "a long, b long")


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint; root is a fingerprint of the same component."""
    distinct = prints.select("fp").distinct()
    roots = components(fingerprint_links(distinct, distance=distance))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
    distance: int = DISTANCE,
) -> DataFrame:
    """(id, fingerprint, component_id): one row per row of ``docs``."""
    prints = stored(
        fingerprints(docs, id_col=id_col, text_col=text_col, width=width).drop(*ROW_KEY), "simhash"
    )
    classes = _classes(prints, distance)
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    named = classes.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = classes.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def first_of_each_group(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
    distance: int = DISTANCE,
) -> DataFrame:
    """The documents with one row left of each component: the smallest id, then the least row key.

    Rows without an id come last. Rows equal in id and text count as one. All columns are kept.
    """
    prints = stored(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "simhash")
    classes = _classes(prints, distance)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", *ROW_KEY)
    kept_key = ["__kept_key", "__kept_check"]
    per_print = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = (
        per_print.join(classes, "fp")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(*[F.col(f"first.{key}").alias(name) for key, name in zip(ROW_KEY, kept_key)])
    )
    keyed = docs.select("*", *[c.alias(name) for c, name in zip(row_keys(id_col, text_col), kept_key)])
    return (
        keyed.join(kept, kept_key, "leftsemi")
        .dropDuplicates(kept_key)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
