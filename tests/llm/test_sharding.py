"""Shards: everything placed once, bytes near equal, slots gapless, copies together, no Python."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from airledger.llm import sharding


def placed(frame, **options):
    got = [r.asDict() for r in sharding.shards(frame, **options).collect()]
    slots = defaultdict(list)
    for row in got:
        slots[row["shard"]].append(row["slot"])
        assert row["law"] == "bytes" and row["grown_shard"] is None and 0 <= row["shard"] < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_every_row_is_placed_once_with_its_digest(docs, odd, empty):
    for frame in (docs, odd):
        rows = Counter(
            (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))
            for r in frame.collect()
        )
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in placed(frame)) == rows
    assert placed(empty) == []


def test_sizes_are_near_equal_and_copies_stay_together(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = placed(frame)
    sizes = Counter()
    for row in got:
        sizes[row["shard"]] += row["size"]
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and max(abs(s - mean) for s in sizes.values()) < 0.05 * mean
    homes = defaultdict(set)
    for row in got:
        homes[row["text_crc32"], row["size"]].add(row["shard"])
    assert sum(len(h) > 1 for h in homes.values()) <= 1


def test_a_text_with_a_third_of_all_rows_is_subdivided(spark):
    text = F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text no "), F.col("id")))
    sizes = Counter(r["shard"] for r in placed(spark.range(30_000).select(F.col("id").alias("doc_id"), text.alias("text"))))
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * min(sizes.values())


def test_result_does_not_depend_on_the_order_of_rows(docs):
    def result(frame):
        return sorted(map(str, sharding.shards(frame).collect()))

    assert result(docs.repartition(1)) == result(docs.orderBy(F.desc("doc_id")).repartition(5))


def test_plan_runs_no_python(docs):
    assert "Python" not in sharding.shards(docs)._jdf.queryExecution().toString()


@pytest.mark.parametrize("ids", ["null", "id", "7", "id % 40", "if(id % 2 = 0, null, id)"])
def test_the_law_holds_for_ties(spark, ids):
    """Half of all rows are one text, with null ids, one id, a few ids, or distinct ones."""
    frame = spark.range(20_000).repartition(6).selectExpr(
        f"cast(if(id % 2 = 0, {ids}, id) as long) AS doc_id", "if(id % 2 = 0, 'the same text', concat('text no ', id)) AS text"
    )
    sizes = Counter()
    for row in placed(frame):
        sizes[row["shard"]] += row["size"]
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * min(sizes.values()), sizes


def test_one_row_in_many_copies_is_dealt_out(spark):
    frame = spark.range(30_000).selectExpr("cast(null as long) AS doc_id", "'all rows alike' AS text").repartition(5)
    sizes = Counter(r["shard"] for r in placed(frame))
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * min(sizes.values())


def test_placement_equals_a_plain_version(spark):
    """Ranges of the given splitters, filled shard by shard in their order."""
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = placed(frame)
    digest = {
        r.id: (r.k, r.id, r.size, r.crc)
        for r in sharding._records(frame, "doc_id", "text").collect()
    }
    in_order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    keys = [digest[r["doc_id"]][0] for r in in_order]
    assert keys == sorted(keys)  # shards are ranges of the key, slots follow it
    sizes = [r["size"] for r in in_order]
    middle = {}
    for place, row in enumerate(in_order):
        middle.setdefault(row["shard"], []).append((sum(sizes[:place]) + sizes[place] / 2) * 24 / sum(sizes))
    largest = max(sizes) * 24 / sum(sizes)
    for shard, found in middle.items():
        assert min(found) > shard - largest and max(found) < shard + 1 + largest
