"""Bounded samples of labelled rows to fit a model on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType


def labelled_sample(
    rows: DataFrame, label: str, key: list[str], *, per_label: int, max_labels: int | None, carry: list[str],
    later: Column | None = None,
) -> list:
    """``per_label`` distinct rows, or all there are, of each of the ``max_labels`` labels with most of them, collected.

    Without ``max_labels`` every label counts. Rows that are ``later`` are drawn only where a label lacks others.

    Null labels are left out. Rows with equal key columns count as one, however often they repeat. The smallest
    hashes of the key columns are drawn, so the draw is fixed by the rows themselves; a label's rows come in
    that order. At most ``per_label`` rows a label come back.
    """
    spark = rows.sparkSession
    known = rows.filter(F.col(label).isNotNull()).withColumn("__hash", F.xxhash64(*key))
    late = F.lit(False) if later is None else F.coalesce(later, F.lit(False))
    distinct = known.select(label, "__hash", late.alias("__later")).distinct()
    sizes = distinct.groupBy(label).agg(F.count("*").alias("all"), F.count_if("__later").alias("later"))
    sizes = sizes.orderBy(F.desc("all"), label)
    counts = (sizes if max_labels is None else sizes.limit(max_labels)).collect()
    if not counts:
        return []

    def share(wanted: int, there: int) -> float:
        """So much above the wanted number that fewer never come."""
        return min(1.0, (wanted + 8 * wanted**0.5 + 32) / there) * (1 << 32)

    shares = []
    for row in counts:
        early = row["all"] - row["later"]
        if early:
            shares.append((row[label], False, share(per_label, early)))
        if early < per_label and row["later"]:
            shares.append((row[label], True, share(per_label - early, row["later"])))
    shares = spark.createDataFrame(
        shares,
        StructType([distinct.schema[label], StructField("__later", BooleanType()), StructField("__share", DoubleType())]),
    )
    draw = F.pmod("__hash", F.lit(1 << 32))
    near = distinct.join(F.broadcast(shares), [label, "__later"]).filter(draw < F.col("__share")).collect()
    hashes: dict = {}
    for row in sorted(near, key=lambda row: (row["__later"], row["__hash"] % (1 << 32), row["__hash"])):
        hashes.setdefault(row[label], {})[row["__hash"]] = None
    places = {(name, h): place for name, own in hashes.items() for place, h in enumerate(list(own)[:per_label])}
    # At most per_label hashes a label: small enough for every executor.
    drawn = F.broadcast(spark.createDataFrame(list(places), StructType([distinct.schema[label], distinct.schema["__hash"]])))
    taken = known.join(drawn, [label, "__hash"]).groupBy(label, "__hash").agg(F.min(F.struct(*carry)).alias("__row"))
    ordered = sorted(taken.collect(), key=lambda row: (row[label], places[row[label], row["__hash"]]))
    return [Row(**{label: row[label], **row["__row"].asDict()}) for row in ordered]
