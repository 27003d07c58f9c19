"""Neighbours in the order of a long key, without one task that sees all keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import stored

AT_ONCE = 1 << 16
SHIFT = 12


def cyclic_predecessors(values: DataFrame, column: str, *, at_once: int = AT_ONCE) -> DataFrame:
    """(column, prev): the next smaller distinct value; the smallest is preceded by the largest.

    Up to ``at_once`` values (counted first) are ordered in one window. Beyond that a window covers the
    values that share all but ``SHIFT`` low bits, so at most ``1 << SHIFT`` of them, and the first of each
    such range takes the last of the range before, found by the same function over the ranges.
    """
    at_once = max(at_once, 2)  # ranges of keys below and above zero never become one
    values = stored(values.select(F.col(column).cast("long").alias("v")).distinct(), "ordered")
    if values.count() <= at_once:
        near = Window.orderBy("v")
        last = F.max("v").over(Window.partitionBy())
        return values.select(F.col("v").alias(column), F.coalesce(F.lag("v").over(near), last).alias("prev"))
    ranged = values.withColumn("r", F.shiftright("v", SHIFT))
    lasts = ranged.groupBy("r").agg(F.max("v").alias("last"))
    before = cyclic_predecessors(lasts, "r", at_once=at_once)
    entry = before.join(lasts.withColumnRenamed("r", "prev"), "prev").select("r", "last")
    within = ranged.withColumn("near", F.lag("v").over(Window.partitionBy("r").orderBy("v")))
    return within.join(entry, "r").select(F.col("v").alias(column), F.coalesce("near", "last").alias("prev"))
