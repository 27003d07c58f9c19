"""The driver's ``events`` table seen as sensor readings and as a change feed.

Every event becomes one base-table row and one change. Operations follow ``event_id % 20``:
0 deletes the row of the preceding event, 2 is a snapshot row, 3 updates that snapshot row, the
rest are inserts. Functions take a batch or streaming ``events`` frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import times

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
EPOCH_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00, the first day of the data
SQUEEZE = 60  # the dense binding packs 30 days into 12 hours


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def event_micros(dense: bool) -> Column:
    micros = F.unix_micros(times.instant("ts"))
    if not dense:
        return micros
    return F.lit(EPOCH_MICROS) + F.call_function(
        "div", micros - F.lit(EPOCH_MICROS), F.lit(SQUEEZE)
    )


def _sensor() -> Column:
    return F.concat(F.lit("sensor_"), F.col("user_id") % 5 + 1)


def _level() -> Column:
    return F.lit(380.0) + F.col("value")


def measurements(events: DataFrame, *, dense: bool = False, place: Column | None = None) -> DataFrame:
    return events.select(
        (F.col("event_id") + 1).alias("id"),
        _sensor().alias("sensor_id"),
        _level().alias("co2_level"),
        times.local_time(F.timestamp_micros(event_micros(dense))).alias("measurement_time"),
        (F.col("event_type") if place is None else place).alias("location"),
    )


def _row(id_: Column, dense: bool, place: Column | None) -> Column:
    return F.struct(
        id_.alias("id"),
        _sensor().alias("sensor_id"),
        _level().alias("co2_level"),
        event_micros(dense).alias("measurement_time"),
        (F.col("event_type") if place is None else place).alias("location"),
    )


def changes(
    events: DataFrame, *, dense: bool = False, place: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(seq, value) plus the event columns named in ``keep``."""
    step = F.col("event_id") % 20
    deleted, updated = step == 0, step == 3
    new_row = _row(F.col("event_id") + 1, dense, place)
    same_row = _row(F.col("event_id"), dense, place)
    op = F.when(deleted, "d").when(step == 2, "r").when(updated, "u").otherwise("c")
    payload = F.struct(
        F.when(deleted | updated, same_row).alias("before"),
        F.when(updated, same_row).when(~deleted, new_row).alias("after"),
        op.alias("op"),
        times.whole_millis(event_micros(dense)).alias("ts_ms"),
    )
    envelope = F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})
    return events.select(F.col("event_id").alias("seq"), envelope.alias("value"), *keep)


def dirty_changes(events: DataFrame) -> DataFrame:
    """The same events as a damaged feed: ``event_id % 13`` picks the damage, 0 is intact."""
    row = _row(F.col("event_id") + 1, False, None)

    def doc(after: Column, op: str = "c") -> Column:
        body = F.struct(after.alias("after"), F.lit(op).alias("op"))
        return F.to_json(F.struct(body.alias("payload")))

    def with_field(name: str, value: Column) -> Column:
        return row.withField(name, value)

    quoted = with_field("id", (F.col("event_id") + 1).cast("string")).withField(
        "co2_level", _level().cast("string")
    )
    damage = [
        doc(row),
        doc(F.when(F.lit(False), row), "d"),
        F.lit("{not json"),
        F.lit(None).cast("string"),
        doc(row.dropFields("location")),
        doc(quoted),
        doc(with_field("co2_level", F.lit("abc"))),
        doc(with_field("sensor_id", F.col("user_id"))),
        F.to_json(F.struct(row.alias("after"), F.lit("c").alias("op"))),
        F.lit(""),
        doc(with_field("id", F.struct(F.lit(1).alias("z")))),
        doc(with_field("id", (F.col("event_id") + 1).cast("decimal(20, 1)"))),  # 7.0
        doc(with_field("measurement_time", event_micros(False).cast("double"))),  # 1.7E15
    ]
    value = F.lit(None).cast("string")
    for kind, text in enumerate(damage):
        value = F.when(F.col("event_id") % len(damage) == kind, text).otherwise(value)
    return events.select(F.col("event_id").alias("seq"), value.alias("value"))
