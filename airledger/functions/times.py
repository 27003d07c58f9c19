"""Time expressions.

Event times travel as TIMESTAMP because watermarks need that type, and leave every query as
TIMESTAMP_NTZ, the zone-less type of the result tables.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_millis(micros: ColumnOrName) -> Column:
    """Epoch microseconds to milliseconds, truncated toward zero in integers."""
    return F.call_function("div", _column(micros), F.lit(1000))


def event_time(micros: ColumnOrName) -> Column:
    """Event time of an epoch-microsecond value; digits below a millisecond are cut."""
    return F.timestamp_millis(whole_millis(micros))


def local_time(instant: ColumnOrName) -> Column:
    return _column(instant).cast("timestamp_ntz")


def instant(local: ColumnOrName) -> Column:
    return _column(local).cast("timestamp")


def window_end(window: ColumnOrName) -> Column:
    """Exclusive end of a tumbling window: the 10:00 bucket covers 09:00 to 10:00."""
    return local_time(_column(window)["end"])


def hour_of_day(time: ColumnOrName) -> Column:
    return F.hour(time)


def day_of(time: ColumnOrName) -> Column:
    return F.to_date(time)


def hour_start(time: ColumnOrName) -> Column:
    return local_time(F.date_trunc("hour", time))
