"""Shards of near-equal bytes by sampled splitters. DataFrame functions only.

The range key of a record is a hash of its text, so equal texts are neighbours. Records are
drawn with a chance in proportion to their size (a record as large as several draws counts as often);
the quantiles of the drawn keys are the splitters. A key that several quantiles fall on is a group too
large for one range: it gets a range of its own, subdivided by the quantiles of a hash of its drawn ids. An id that
repeats so often in one text that several of those quantiles fall on it (null is an id like others here) is dealt out
in turn between their parts by the rows' places: such rows are equal, so it does not matter which goes where. The ranges are
finer than the shards; their exact bytes are summed, and consecutive ranges go to the shard their
middle byte falls in. Which rows are drawn only moves the splitters; every row is counted and placed.

Defined cases: a null text has no bytes (size 8) and crc 0; a null id comes first in its part; ties are numbered in
order of hash, id and size (equal rows are interchangeable); fewer rows than shards leave shards empty;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import stored

SHARDS = 24
OVERHEAD = 8
RANGES_PER_SHARD = 64
MOST_RANGES_PER_SHARD = 2048
ROWS_PER_RANGE = 200_000
DRAWS_PER_RANGE = 40
ACCURACY = 100_000


def _uniform(*columns: str) -> Column:
    """A number in [0, 1) fixed by the columns' values."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 32)) / F.lit(float(1 << 32))


def _records(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    data = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("crc"),
        # 52 bits: quantiles are computed in doubles and must return the keys themselves.
        F.shiftrightunsigned(F.xxhash64(data), 12).alias("k"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("long")), 12).alias("t"),
        F.monotonically_increasing_id().alias("place"),
    )


def _quantiles(column: str, parts: int) -> Column:
    return F.percentile_approx(column, [i / parts for i in range(1, parts)], ACCURACY)


def _longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _below(bounds: list[int], value: Column) -> Column:
    """How many of the sorted bounds are at or below the value: two short scans, one of every n-th bound."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = _longs([b[0] for b in blocks])
    block = F.size(F.filter(heads, lambda b: b <= value))
    inner = F.array(*[_longs(b) for b in blocks])
    at = F.element_at(inner, F.greatest(block, F.lit(1)))
    count = F.size(F.filter(at, lambda b: b <= value))
    return F.when(block == 0, 0).otherwise((block - 1) * step + count).cast("int")


def _ranged(records: DataFrame, ranges: int, total: int) -> DataFrame:
    """Add range_no (order of the key's range) and part_no (subdivision of a range of one key)."""
    # Equal rows are drawn together, in proportion to their number.
    equal = records.groupBy("k", "t", "id", "size", "crc").agg(F.count("*").alias("n"))
    rate = ranges * DRAWS_PER_RANGE / max(total, 1)
    draws = F.floor(F.col("n") * F.col("size") * F.lit(rate) + _uniform("k", "id", "crc"))
    drawn = stored(
        equal.select("k", "t", draws.cast("int").alias("draws")).filter("draws > 0"), "splitters"
    ).withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("draws"))))
    cuts = drawn.agg(_quantiles("k", ranges).alias("q")).first()["q"] or []
    heavy = {k: cuts.count(k) for k in set(cuts) if cuts.count(k) > 1}
    # A heavy key starts its own range and the next key starts another.
    bounds = sorted({*cuts, *(k + 1 for k in heavy)})
    ranged = records.withColumn("range_no", _below(bounds, F.col("k")))
    if not heavy:
        return ranged.withColumn("part_no", F.lit(0))
    # At most one row per range, with at most one bound per range: small enough for every executor.
    inner = (
        drawn.filter(F.expr(f"k IN ({', '.join(f'{k}L' for k in heavy)})"))
        .groupBy("k")
        .agg(_quantiles("t", max(heavy.values()) + 1).alias("bounds"))
    )
    below = F.size(F.filter("bounds", lambda b: b < F.col("t")))
    level = F.size(F.filter("bounds", lambda b: b == F.col("t")))
    turn = F.pmod(F.xxhash64("place"), F.greatest(level, F.lit(1)))
    part = F.when(level == 0, below).otherwise(below + 1 + turn)
    return (
        ranged.join(F.broadcast(inner), "k", "left")
        .withColumn("part_no", F.when(F.col("bounds").isNull(), 0).otherwise(part).cast("int"))
        .drop("bounds")
    )


def shards(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per row under the law ``bytes``.

    A large table gets more ranges, so that one holds about ``ROWS_PER_RANGE`` rows.
    """
    records = stored(_records(docs, id_col, text_col), "records")
    total, rows = records.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    wanted = min(MOST_RANGES_PER_SHARD, rows // (ROWS_PER_RANGE * shards))
    placed = stored(_ranged(records, shards * max(ranges_per_shard, wanted), total), "ranged")
    # One row per range and part: bounded by the parameters, not by the table.
    parts = placed.groupBy("range_no", "part_no").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    order = Window.orderBy("range_no", "part_no")
    before = F.sum("bytes").over(order) - F.col("bytes")
    total = F.sum("bytes").over(Window.partitionBy())
    middle = (before + F.col("bytes") / 2) * shards / total
    layout = parts.withColumn("shard", F.least(F.floor(middle), F.lit(shards - 1)).cast("int"))
    in_shard = Window.partitionBy("shard").orderBy("range_no", "part_no")
    layout = layout.withColumn("first_slot", F.sum("rows").over(in_shard) - F.col("rows"))
    layout = layout.select("range_no", "part_no", "shard", "first_slot")
    inside = Window.partitionBy("range_no", "part_no").orderBy("k", "id", "size", "crc")
    return (
        placed.withColumn("row", F.row_number().over(inside) - 1)
        .join(layout, ["range_no", "part_no"])
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first_slot") + F.col("row")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
