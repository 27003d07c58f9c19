"""Phrase fingerprints against a plain parse, and the order of documents."""

import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from airledger.llm import lz_fingerprint as lz
from airledger.llm.order import cyclic_predecessors


def plain_phrases(text):
    seen, start = [], 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.append(text[start:end])
            start = end
    return seen


def test_phrases_and_their_hashes():
    text = "abababcabcdé😀😀😀"
    phrases = {}
    rest = lz.parse(text, phrases)
    assert list(phrases) == plain_phrases(text) and "".join(phrases) + rest == text
    hashes = lz.phrase_hashes(text, lz._lengths(phrases, len(phrases)))
    alone = [lz.phrase_hashes(p, lz._lengths([p], 1))[0] for p in phrases]
    assert hashes.tolist() == alone and len(set(alone)) == len(alone)


def test_likeness_estimates_the_common_phrases():
    a, b = "the cat sat on the mat " * 30, "the cat sat on the mat " * 29 + "and left the house at once"
    pa, pb = {}, {}
    lz.parse(a, pa), lz.parse(b, pb)
    exact = len(set(pa) & set(pb)) / len(set(pa) | set(pb))
    marks = [lz.signature(lz.phrase_hashes(t, lz._lengths(p, len(p)))) for t, p in ((a, pa), (b, pb))]
    assert lz.likeness(*marks) == pytest.approx(exact, abs=0.15)
    none = lz.signature(lz.phrase_hashes("", lz._lengths({}, 0)))
    assert lz.likeness(none, none) == 1.0 and lz.likeness(none, marks[0]) == 0.0


def hash_of(text):
    value = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def expected(rows, bits=8, crowded=1 << 60):
    """One row per (id, text), ordered by id (null first) and text; in crowded ranges by the text's hash before the text."""
    def range_of(i):
        return (-(1 << 63) if i is None else i) >> bits

    sizes = Counter(range_of(i) for i, _ in rows)
    rows = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, hash_of(r[1]) if sizes[range_of(r[0])] > crowded else 0, r[1].encode()),
    )
    out = []
    for place, (doc_id, text) in enumerate(rows):
        following = rows[(place + 1) % len(rows)][1]
        moved = len(text) // 4
        edited = text[: len(text) - moved] + following[:moved]
        own, mark, after = lz.fingerprint(text), lz.fingerprint(edited), lz.fingerprint(following)
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, mark, like(own, mark), like(own, after),
        ))
    return sorted(out, key=repr)


def like(a, b):
    def values(mark):
        return {int(mark[i : i + 8], 16) for i in range(0, len(mark), 8)}

    a, b = values(a), values(b)
    least = sorted(a | b)[: lz.KEPT]
    return sum(v in a and v in b for v in least) / len(least) if least else 1.0


@pytest.mark.parametrize("bits", [0, 3, 8])
def test_rows_and_their_successors(docs, odd, bits):
    for frame in (docs, odd, odd.limit(1)):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        got = lz.with_next(frame, range_bits=bits)
        assert got.columns == [
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
        ]
        if len(rows) > 1:
            assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("bits, crowded", [(0, 1), (3, 2), (8, 4), (8, 1)])
def test_crowded_ranges_are_dealt_in_parts(spark, odd, monkeypatch, bits, crowded):
    monkeypatch.setattr(lz, "ROWS_PER_PART", 2)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    rows += [(None, f"a text without an id, number {i % 13}") for i in range(40)] + [(3, f"text {i} of one id") for i in range(30)]
    rows += [(3, "the same text again")] * 25 + [(700, "far away")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = lz.with_next(frame, range_bits=bits, crowded_rows=crowded).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, bits, crowded)


def test_one_id_spreads_over_tasks(spark, monkeypatch):
    """Half of all rows without an id: no part of the order holds more than its share."""
    monkeypatch.setattr(lz, "ROWS_PER_PART", 64)
    frame = spark.range(8000).selectExpr("if(id % 2 = 0, null, id) AS id", "concat('text ', if(id % 4 = 0, 'x', cast(id as string))) AS text")
    own = frame.withColumn("at", F.coalesce("id", F.lit(lz.LOWEST)))
    placed, firsts = lz._parts(own, 8, 1000)
    sizes = [r["count"] for r in placed.groupBy("range", "part").count().collect()]
    assert max(sizes) < 260 and placed.agg(F.sum("times")).first()[0] == 8000 and firsts.count() == len(sizes)


def test_edited_texts_are_near_and_neighbours_are_not(docs):
    rows = [r for r in lz.with_next(docs).collect() if r.n_chars > 200]
    near, far = (sum(getattr(r, n) for r in rows) / len(rows) for n in ("near_edited", "near_next"))
    assert near > 0.5 and far < 0.25


def test_empty_table(empty):
    assert lz.with_next(empty).count() == 0


@pytest.mark.parametrize("at_once", [2, 5, 1000])
def test_order_of_keys_in_ranges(spark, at_once):
    values = [-(1 << 63), -70_000, -1, 0, 1, 5, 4096, 9_000, 1 << 40, (1 << 40) + 1, (1 << 63) - 1]
    frame = spark.createDataFrame([(v,) for v in values * 2], "k long")
    got = {r.k: r.prev for r in cyclic_predecessors(frame, "k", at_once=at_once).collect()}
    assert got == dict(zip(values, [values[-1], *values[:-1]]))
