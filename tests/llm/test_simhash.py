"""SimHash, components and the survivors of each group against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from airledger.llm import simhash
from airledger.llm.components import components


def plain_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(edges, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    """(id, print, component) per row."""
    prints = [plain_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    edges = [
        (a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 3
    ]
    root = roots(edges, distinct)
    least = {}
    for (doc_id, _), mark in zip(rows, prints):
        if doc_id is not None:
            least[root[mark]] = min(least.get(root[mark], doc_id), doc_id)
    return sorted(
        ((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)), key=repr
    )


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_documents_and_odd_rows(docs, odd, empty):
    for frame in (docs, odd):
        got = sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=repr)
        assert got == brute(pairs(frame))
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.near_duplicates(empty).columns == ["doc_id", "fingerprint", "component_id"]


def test_whole_fixture_at_a_larger_size(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=repr)
    assert got == brute(pairs(frame))


@pytest.mark.parametrize("bucket", [3, 64])
def test_links_connect_exactly_what_is_close(spark, bucket):
    """Dense and sparse prints; small buckets force chunks and pairs of chunks."""
    draw = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(draw.choice((1, 2, 30))):
            moved = centre
            for bit in draw.sample(range(64), draw.randrange(5)):
                moved ^= 1 << bit
            prints.add(moved)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [tuple(r) for r in simhash.fingerprint_links(distinct, bucket=bucket).collect()]
    mask = (1 << 64) - 1
    assert all((a ^ b & mask).bit_count() for a, b in links)
    close = [
        (a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & mask).bit_count() <= 3
    ]
    assert roots(links, signed) == roots(close, signed)


def test_pivot_table_discards_no_close_pair():
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 1 << 63, 200, dtype=np.uint64)
    near = prints ^ (np.uint64(1) << draw.integers(0, 64, 200, dtype=np.uint64))
    pivots = simhash.pivot_prints()
    gaps = np.abs(simhash.pivot_table(prints, pivots) - simhash.pivot_table(near, pivots)).max(axis=1)
    assert gaps.max() <= 1
    far = np.abs(simhash.pivot_table(prints[:-1], pivots) - simhash.pivot_table(prints[1:], pivots))
    assert (far.max(axis=1) > 3).mean() > 0.9


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(2)
    edges = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(100, 160)],
        "random": [(draw.randrange(60), draw.randrange(60)) for _ in range(40)],
        "none": [],
    }[shape]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert got == roots(linked, {n for e in linked for n in e})


def test_one_document_of_each_group_stays(spark, docs, odd, empty):
    for frame in (docs, odd):
        found = brute(pairs(frame))
        kept = simhash.first_of_each_group(frame)
        assert kept.columns == frame.columns
        rows = [(r.doc_id, r.text) for r in kept.collect()]
        groups = [plain_print(t) for _, t in rows]
        assert len(set(groups)) == len(groups)
        by_print = {p: c for _, p, c in found}
        want = {(c, None if c is not None else p) for p, c in by_print.items()}
        assert {(i, None if i is not None else f"{plain_print(t):016x}") for i, t in rows} == want
    assert simhash.first_of_each_group(empty).count() == 0


def test_plan_has_no_cross_join_and_hot_prints_are_one_row(spark):
    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same words every time").alias("text"))
    got = simhash.near_duplicates(copies)
    assert got.filter("component_id <> 0").count() == 0 and got.count() == 3000
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_pivots_discard_most_of_what_buckets_bring_together(spark):
    """Of the pairs that meet by chance in a bucket the distance tables discard the most part."""
    prints = np.array([r.fp for r in simhash.fingerprints(
        spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).select("fp").distinct().collect()]).view(np.uint64)
    table = simhash.pivot_table(prints, simhash.pivot_prints())
    met = set()
    for mask in simhash.block_masks(3):
        keys = prints & np.uint64(mask % (1 << 64))
        order = np.argsort(keys)
        for part in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
            met.update((int(a), int(b)) for i, a in enumerate(sorted(part)) for b in sorted(part)[i + 1 :])
    a, b = np.array(sorted(met)).T
    apart = np.bitwise_count(prints[a] ^ prints[b]) > 3
    kept = np.abs(table[a] - table[b]).max(axis=1) <= 3
    assert kept[~apart].all() and (~kept[apart]).mean() > 0.6
    print(f"{len(a)} pairs meet, {(~kept).sum()} discarded by pivots, {(~apart).sum()} links")
