"""Regions against plain dynamic programming, planted passages, odd rows, blocks."""

import random

import numpy as np
import pytest

from airledger.llm import decontaminate as D

PARTS = ["the", "of", "ation", "er", "thand", "on", "ing", "ent", "is", "hare", "ore", "blest"]


def edits_in(passage, text):
    """Least edits of the passage against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def prose(draw, size):
    return "".join(draw.choice(PARTS) + draw.choice(["", "", " "]) for _ in range(size))[: size * 3].strip()


def damaged(draw, passage, edits):
    chars = list(passage)
    for _ in range(edits):
        at = draw.randrange(len(chars))
        kind = draw.randrange(3)
        if kind == 0:
            chars[at] = draw.choice("abcz")
        elif kind == 1:
            chars.insert(at, draw.choice("abcz"))
        else:
            del chars[at]
    return "".join(chars)


def searched(items, docs):
    passages = D.Passages.build(items, D.RATE)
    folded = [D.fold(t) for t in docs]
    points = np.concatenate([x for d in folded for x in (d, [D.FAR])]).astype(np.uint32)
    starts = np.cumsum([0, *(d.size + 1 for d in folded)])[:-1]
    return passages, {(r[0], r[1]): r for r in D.verified(passages, folded, passages.candidates(points, starts))}


@pytest.mark.parametrize("seed", range(6))
def test_no_region_within_budget_is_missed(seed):
    draw = random.Random(seed)
    for _ in range(12):
        items = [(i, t) for i, t in enumerate(prose(draw, draw.randrange(8, 40)) for _ in range(4)) if len(t) >= 20]
        docs = []
        for _ in range(4):
            text = prose(draw, draw.randrange(5, 60))
            passage = draw.choice(items)[1]
            at = draw.randrange(len(text) + 1)
            docs.append(text[:at] + damaged(draw, passage, draw.randrange(len(passage) // 8)) + text[at:])
        passages, got = searched(items, docs)
        for d, text in enumerate(docs):
            for j, (_, passage) in enumerate(items):
                edits = edits_in(passage, text)
                assert (edits <= passages.budget[j]) == ((d, j) in got)
                if (d, j) in got:
                    _, _, start, end, found = got[d, j]
                    assert found == edits
                    assert edits_in(text[start:end], passage) <= 2 * edits + 1


def test_the_lemma_bounds_the_count():
    for size in (20, 30, 95, 394, 5000):
        k = D.edit_budget(size, D.RATE, D.Q)
        assert size + 1 - D.Q * (k + 1) >= 1 and k <= D.RATE * size


def plain_pairs(docs, items):
    return {(r.doc_id, i) for r in docs for i, t in items if r.text and t.lower() in " ".join(r.text.lower().split(" "))}


def test_documents(spark, docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text.strip()) for r in benchmark.collect()]
    want = plain_pairs(docs.collect(), items)
    for chars in (D.BLOCK_CHARS, 500):  # one block, many blocks
        got = D.regions(docs, benchmark, block_chars=chars).collect()
        assert {(r.doc_id, r.item_id) for r in got if r.edits == 0} == want and want
        assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
    text = {r.doc_id: r.text for r in docs.collect()}
    for row in got:
        assert D.fold(text[row.doc_id])[row.start : row.end].tolist() == D.fold(dict(items)[row.item_id]).tolist()
    left = D.clean(docs, benchmark, block_chars=500)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in left.collect()} == {d for d, _ in want}
    assert left.columns == docs.columns


def test_planted_changes_and_odd_rows(spark, odd, empty):
    passage = "A benchmark question: which of these answers is the right one, and why is it so?"
    benchmark = spark.createDataFrame(
        [(3, passage), (1, passage.upper()), (None, passage), (4, None), (5, ""), (6, "short"), (7, "   ")],
        "item_id bigint, text string",
    )
    changed = passage.replace("which", "What").replace("\n", " ").replace("right", "rigth").upper()
    planted = spark.createDataFrame(
        [(1, "x " + passage + " y"), (2, "before " + changed), (3, passage[:40]), (None, passage), (4, passage.replace(" ", "\n"))],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: r for r in D.regions(planted, benchmark).collect()}
    assert set(got) == {1, 2, None, 4} and {r.item_id for r in got.values()} == {1}
    assert (got[1].start, got[1].edits, got[4].edits) == (2, 0, 0) and got[2].edits > 0
    assert [r.doc_id for r in D.clean(planted, benchmark).collect()] == [3]
    assert D.regions(odd, benchmark).count() == 0 and D.clean(odd, benchmark).count() == odd.count()
    assert D.regions(empty, benchmark).count() == 0
    assert D.clean(odd, benchmark.limit(0)).count() == odd.count()
    assert D.regions(odd, benchmark.limit(0)).columns == ["doc_id", "item_id", "start", "end", "edits"]


def spread(passages, docs):
    """All regions by document and passage."""
    folded = [D.fold(t) for t in docs]
    points = np.concatenate([x for d in folded for x in (d, [D.FAR])]).astype(np.uint32)
    starts = np.cumsum([0, *(d.size + 1 for d in folded)])[:-1]
    out = {}
    for d, j, start, end, edits in sorted(D.verified(passages, folded, passages.candidates(points, starts))):
        out.setdefault((d, j), []).append((start, end, edits))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_every_region_of_a_passage_is_found(seed):
    draw = random.Random(seed)
    for size in (20, 24, 31, 40, 90, 300):
        passage = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)).replace(" ", "x")
        passages = D.Passages.build([(1, passage)], D.RATE)
        k = int(passages.budget[0])
        for _ in range(8):
            text, want = "", []
            for _ in range(draw.randrange(2, 7)):
                text += "-" * draw.choice((0, 0, 1, 5, 30, 400)) + "."
                edits = draw.choice((0, 0, 1, k))
                copy = list(passage)
                for at in draw.sample(range(2, size - 2), edits):
                    copy[at] = "#"
                want.append((len(text), len(text) + size, edits))
                text += "".join(copy)
            text += "-" * draw.choice((0, 3, 500))
            assert spread(passages, [text]) == {(0, 0): want}


def test_adjacent_and_periodic_copies():
    passage = "what is the sum of one and two and three?"
    passages = D.Passages.build([(1, passage), (2, "ab" * 20)], D.RATE)
    size = len(passage)
    got = spread(passages, [passage * 5, "xab" + "ab" * 60 + "y", passage + " " + passage.replace("sum", "sun") + passage])
    assert got[0, 0] == [(i * size, (i + 1) * size, 0) for i in range(5)]
    assert [r for r in got[1, 1] if r[2] == 0] == [(1, 41, 0), (41, 81, 0), (81, 121, 0)]
    assert [(start, edits) for start, _, edits in got[2, 0]] == [(0, 0), (size + 1, 1), (2 * size + 1, 0)]


def test_repeated_passages_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = {r.item_id: r.text.strip().lower() for r in benchmark.collect()}
    hits = [(r.doc_id, r.item_id) for r in D.regions(docs, benchmark).filter("edits = 0").collect()]
    more = {pair: hits.count(pair) for pair in hits if hits.count(pair) > 1}
    texts = {r.doc_id: r.text.lower() for r in docs.filter(docs.doc_id.isin([d for d, _ in more])).collect()}
    assert more and {(d, i): texts[d].count(items[i]) for d, i in more} == more


def test_a_passage_in_many_places_of_a_long_document(spark):
    passage = "A benchmark question: which of these answers is the right one, and why is it so?"
    frame = spark.createDataFrame([(1, ("filler words " * 3 + passage) * 2_000)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(3, passage)], "item_id bigint, text string")
    assert D.regions(frame, benchmark).count() == 2_000 and D.clean(frame, benchmark).count() == 0


def test_passages_without_an_id_are_searched(spark):
    first, second = "a passage that nobody gave an id, yet it is one", "another one of the same kind, also unnamed"
    benchmark = spark.createDataFrame([(None, first), (None, second), (7, "certainly named so: " + first)], "item_id bigint, text string")
    frame = spark.createDataFrame(
        [(1, "x " + first), (2, second + "."), (3, "nothing"), (4, "certainly named so: " + first)], "doc_id bigint, text string"
    )
    for chars in (D.BLOCK_CHARS, 10):
        got = {(r.doc_id, r.item_id) for r in D.regions(frame, benchmark, block_chars=chars).collect()}
        assert got == {(1, None), (2, None), (4, None), (4, 7)}
        assert [r.doc_id for r in D.clean(frame, benchmark, block_chars=chars).collect()] == [3]


def test_short_passages_are_searched_exactly_as_whole_words(spark):
    benchmark = spark.createDataFrame([(1, "Forty  two"), (2, "ha ha"), (3, " é "), (4, "x = 7?"), (5, "")], "item_id bigint, text string")
    frame = spark.createDataFrame(
        [
            (1, "so forty  TWO, and (forty\n\ntwo)"), (2, "forty  twos"), (3, "ha ha ha ha ha"), (4, "É"), (5, "née"),
            (6, "ax = 7?"), (7, "if x = 7?yes"), (8, None), (9, "aha ha"),
        ],
        "doc_id bigint, text string",
    )
    got = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in D.regions(frame, benchmark).collect())
    assert got == [
        (1, 1, 3, 13, 0), (1, 1, 20, 30, 0), (3, 2, 0, 5, 0), (3, 2, 6, 11, 0), (4, 3, 0, 1, 0), (7, 4, 3, 9, 0),
    ]
    assert sorted(r.doc_id for r in D.clean(frame, benchmark).collect()) == [2, 5, 6, 8, 9]


@pytest.mark.parametrize("size", [20, 21, 22, 23, 30, 31, 49])
def test_the_budget_is_a_tenth_for_every_length(spark, size):
    passage = "".join(random.Random(size).sample("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".lower()[:36] * 2, size))
    k, changed = size // 10, list(passage)
    for i in range(1, k + 2):
        changed[i * size // (k + 2)] = "#"
    worst = "".join(changed)
    within = worst.replace("#", passage[worst.index("#")], 1)
    frame = spark.createDataFrame([(1, "- " + within + " -"), (2, "- " + worst + " -")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(3, passage)], "item_id bigint, text string")
    assert [(r.doc_id, r.edits) for r in D.regions(frame, benchmark).collect()] == [(1, k)]


def test_runs_of_one_character_stay_small():
    """Every place of a ruler shares its q-grams with every place of a table line; they are counted in pieces."""
    import tracemalloc

    passages = D.Passages.build([(1, "-" * 300), (2, "=" * 40 + " and some words " + "=" * 40)], D.RATE)
    text = D.fold("-" * 500_000 + " end")
    points = np.append(text, D.FAR).astype(np.uint32)
    tracemalloc.start()
    found = passages.candidates(points, np.array([0]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20 and set(found[1].tolist()) == {0}
    assert found[2].min() <= 0 and found[2].max() >= 499_000 // int(passages.step[0]) * int(passages.step[0])


@pytest.mark.parametrize("at_once", [7, 100, 1 << 19])
def test_pieces_count_like_the_whole(monkeypatch, at_once):
    monkeypatch.setattr(D, "HITS_AT_ONCE", at_once)
    draw = random.Random(at_once)
    items = [(i, t) for i, t in enumerate([prose(draw, 30), "ab" * 30, "-" * 50, prose(draw, 20)]) if len(t) >= 20]
    docs = [prose(draw, 60), "x" + "-" * 120 + "y", "ab" * 80, items[0][1] + " " + items[-1][1], ""]
    passages, found = searched(items, docs)
    for d, text in enumerate(docs):
        for o, (_, passage) in enumerate(items):
            assert ((d, o) in found) == (edits_in(passage, text) <= passages.budget[o] and bool(text)), (d, o)


def test_passages_and_documents_are_folded_alike(spark):
    """Greek capitals with a final sigma, a dotted capital I, wide blanks: a passage is found in its own text."""
    texts = ["ΟΔΟΣ ΑΒΓΔ", "ΠΟΙΟΣ ΕΙΝΑΙ Ο ΤΡΟΠΟΣ ΤΗΣ ΠΟΛΕΩΣ ΑΥΤΗΣ", "İZMİR", "İSTANBUL'DA İYİ BİR GÜN GEÇİRMEK İÇİN NE YAPILIR",
             "STRAẞE  UND ǅ WORTE SIND ES DOCH AUCH", "ﬁne ﬂour ΑΣ"]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(i, f"vorher {t} nachher") for i, t in enumerate(texts)] + [(99, "nichts davon")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.regions(docs, benchmark).collect()}
    assert got == {(i, i) for i in range(len(texts))}
    assert [r.doc_id for r in D.clean(docs, benchmark).collect()] == [99]


@pytest.mark.parametrize("at_once", [1, 3, 99])
def test_many_blocks_of_passages(spark, monkeypatch, at_once):
    monkeypatch.setattr(D, "BLOCKS_AT_ONCE", at_once)
    draw = random.Random(4)
    items = [(i, prose(draw, 25) + f" number {i}") for i in range(10)]
    docs = [(i, f"{prose(draw, 20)} {items[i % 10][1]} {items[(i + 3) % 10][1]}" if i % 3 else prose(draw, 40)) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    whole = {tuple(r) for r in D.regions(frame, benchmark).collect()}
    assert {tuple(r) for r in D.regions(frame, benchmark, block_chars=60).collect()} == whole
    kept = sorted(r.doc_id for r in D.clean(frame, benchmark, block_chars=60).collect())
    assert kept == sorted({i for i, _ in docs} - {r[0] for r in whole}) == [i for i in range(0, 60, 3)]
