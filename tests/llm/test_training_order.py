"""The permutation, the shard files and resuming."""

import zlib

import numpy as np
import pytest

from airledger.llm import training_order as T


@pytest.mark.parametrize("total", [1, 2, 3, 17, 1000, 4096, 4097])
def test_slots_are_a_keyed_permutation(total):
    numbers = np.arange(total)
    got = T.slots(numbers, total)
    assert sorted(got.tolist()) == numbers.tolist()
    if total > 100:
        assert (got != T.slots(numbers, total, key=5)).mean() > 0.9
        assert abs(np.corrcoef(numbers, got)[0, 1]) < 0.2
        assert T.slots(numbers[10:20], total).tolist() == got[10:20].tolist()


@pytest.mark.parametrize("shard_rows, stride", [(16, 64), (8192, 2048)])
def test_files_hold_every_document_in_order_of_slot(spark, docs, odd, root, shard_rows, stride):
    encoder = T._encoder(T.public_tokenizers.path(T.VOCABULARY))
    for name, frame in (("docs", spark.read.parquet("/root/testdata/sf0.001/documents.parquet")), ("odd", odd)):
        index = T.materialise(frame, f"{root}/{name}", shard_rows=shard_rows, stride=stride).collect()
        rows = sorted(index, key=lambda r: r.slot)
        texts = sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=repr)
        assert [r.slot for r in rows] == list(range(len(texts)))
        found, streams = [], {}
        for row in rows:
            assert row.shard == row.slot // shard_rows
            if row.shard not in streams:
                streams[row.shard] = T.read_rows(f"{root}/{name}", row.shard, stride=stride).ravel()
            ids = streams[row.shard][row.first_token : row.first_token + row.n_tokens + 1]
            assert ids[-1] == T.END and zlib.crc32(ids[:-1].tobytes()) == row.tokens_crc32
            found.append((row.doc_id, encoder.decode(ids[:-1].tolist())))
        assert sorted(found, key=repr) == texts
        for shard, stream in streams.items():
            ends = max(r.first_token + r.n_tokens + 1 for r in rows if r.shard == shard)
            assert stream.size % stride == 0 and stream.size - ends < stride and (stream[ends:] == T.END).all()


def test_reading_goes_on_from_any_row(spark, docs, root):
    T.materialise(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), root, stride=128)
    whole = T.read_rows(root, 0, stride=128)
    assert (T.read_rows(root, 0, row=5, stride=128) == whole[5:]).all()
    assert (T.read_rows(root, 0, row=7, count=2, stride=128) == whole[7:9]).all()
    assert T.read_rows(root, 0, row=len(whole), stride=128).size == 0


def test_writing_again_gives_the_same_bytes(spark, root):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    T.materialise(frame, f"{root}/a")
    first = T.read_rows(f"{root}/a", 0)
    T.materialise(frame, f"{root}/a")
    assert (T.read_rows(f"{root}/a", 0) == first).all()
    T.materialise(frame, f"{root}/b", key=9)
    assert first.shape != T.read_rows(f"{root}/b", 0).shape or (first != T.read_rows(f"{root}/b", 0)).any()


def test_empty_table(empty, root):
    assert T.materialise(empty, root).count() == 0


def plain_slot(number, total, key=T.KEY):
    """The permutation written out for one number."""
    wide = (1 << 64) - 1

    def mixed(value):
        value = (value ^ (value >> 30)) * 0xBF58476D1CE4E5B9 & wide
        value = (value ^ (value >> 27)) * 0x94D049BB133111EB & wide
        return value ^ (value >> 31)

    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    keys = [mixed(key + i * 0x9E3779B97F4A7C15 & wide) for i in range(1, T.ROUNDS + 1)]
    while True:
        left, right = number >> half, number & ((1 << half) - 1)
        for round_key in keys:
            left, right = right, left ^ (mixed(right + round_key & wide) & ((1 << half) - 1))
        number = left << half | right
        if number < total:
            return number


@pytest.mark.parametrize("total", [1, 2, 5, 1000, 4097, 123_456_789_012])
def test_slots_equal_a_plain_feistel_network(total):
    numbers = np.unique(np.linspace(0, total - 1, 200).astype(np.int64))
    assert T.slots(numbers, total).tolist() == [plain_slot(n, total) for n in numbers.tolist()]


LONG = {"blanks": " " * 10**7, "newlines": "\n" * 10**7, "letters": "a" * 10**6, "signs": "-" * 10**6}


@pytest.mark.parametrize("name", sorted(LONG))
def test_long_runs_are_encoded(name):
    encoder = T._encoder(T.public_tokenizers.path(T.VOCABULARY))
    for text in (LONG[name], f"a {LONG[name]} b", f"{LONG[name]}x{LONG[name]}"):
        assert encoder.decode(T.token_ids(encoder, text)) == text


def test_cut_runs_give_the_ids_of_the_library(monkeypatch):
    """With a short limit every run is cut out; the ids are those of the library over the whole text."""
    import random
    import re

    encoder = T._encoder(T.public_tokenizers.path(T.VOCABULARY))
    monkeypatch.setattr(T, "_BLANKS", re.compile(T._BLANKS.pattern.replace(f"{{{T.LONG_RUN},}}", "{3,}")))
    draw = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "　", "\x85", "\xa0", "\x1c", "word", "É", "12", "!?", "'s", "    ", "\n\n\n", "\r\n"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 12)))
        assert T.token_ids(encoder, text) == encoder.encode_ordinary(text), repr(text)


def test_a_text_of_blanks_goes_through_spark(spark, root):
    frame = spark.createDataFrame([(1, " " * 10**6), (2, "a b")], "doc_id long, text string")
    assert T.materialise(frame, f"{root}/runs").count() == 2


def test_tasks_take_ranges_of_shards(spark, root, monkeypatch):
    monkeypatch.setattr(T, "MOST_TASKS", 3)
    frame = spark.range(100).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(4)
    index = T.materialise(frame, f"{root}/few", shard_rows=10, stride=16)
    assert sorted(r.slot for r in index.collect()) == list(range(100))
    shards = [sorted({r.shard for r in rows}) for rows in index.rdd.glom().collect() if rows]
    assert sum(len(s) for s in shards) == 10 and all(s == list(range(s[0], s[-1] + 1)) for s in shards) and len(shards) <= 3
