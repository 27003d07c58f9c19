"""Latest reading per sensor.

Readings of one sensor are ordered by (event time, arrival, id), so ties have one answer. Where
the feed has no ``seq`` column the order is (event time, id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Rules
from ..functions import rules as R, times
from ..schemas import CURRENT_STATUS
from . import constraints


def recency(frame: DataFrame, time: str = "measurement_time") -> list[str]:
    """Ordering columns, most significant first."""
    return [c for c in (time, "seq", "id") if c in frame.columns]


def newest(frame: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` for each key (a column or several), as a keyed aggregate.

    Works on batch input and, in update mode, on a stream. Each input partition passes on one row
    per key, so a hot key costs no more than a rare one after the shuffle. Structs compare field
    by field, so putting the order columns first ranks by them and leaves no tie undecided.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in frame.columns if c not in keys and c not in order]
    best = frame.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("best"))
    return best.select(*keys, *[F.col("best")[c].alias(c) for c in (*order, *rest)])


def numbered(frame: DataFrame, key: str, order: list[str], name: str = "row_num") -> DataFrame:
    """Batch only: all columns plus the row's rank in its key, newest first.

    Filtered to ``row_num = 1`` Spark prunes to one row per key before and after the shuffle.
    """
    newest_first: list[Column] = [F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*newest_first))
    return frame.select("*", rank.alias(name))


def as_status(latest: DataFrame, rules: Rules = Rules(), *, carry: tuple[str, ...] = ()) -> DataFrame:
    return latest.select(
        "sensor_id",
        "co2_level",
        R.status(F.col("co2_level"), rules).alias("status"),
        times.local_time("measurement_time").alias("last_updated"),
        "location",
        *carry,
    )


def valid_status(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Status rows the result table accepts, with their ordering columns.

    Both batch and stream choose the newest among these, so a broken reading cannot hide the good
    one before it. Bronze keeps the broken ones with the reason.
    """
    carry = tuple(c for c in ("seq", "id") if c in readings.columns)
    rows = as_status(readings, rules, carry=carry)
    return rows.where(constraints.violations(CURRENT_STATUS).isNull())


def current_status(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The newest valid status of each sensor. Works in update mode on a stream as well, where
    the ordering columns of ``newest_status`` are needed too."""
    return newest_status(readings, rules).select(*CURRENT_STATUS.names)


def newest_status(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    rows = valid_status(readings, rules)
    return newest(rows, "sensor_id", recency(rows, "last_updated"))


def current_status_ranked(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Batch only: the same result through ``row_number() = 1``."""
    rows = valid_status(readings, rules)
    ranked = numbered(rows, "sensor_id", recency(rows, "last_updated"))
    return ranked.where(F.col("row_num") == 1).select(*CURRENT_STATUS.names)
