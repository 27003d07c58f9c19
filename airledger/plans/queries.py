"""Named queries. Each takes (spark, directory of the test tables) and returns a DataFrame.

Averages are rounded to 9 digits in the last projection only, so that two engines which add
doubles in a different order can be compared.

Two time bindings of the events are used: ``dense`` packs the 30 days into 12 hours, which fills
the one-minute and hourly windows; the plain one keeps the original times for the trends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..config import DRAIN, StreamSettings
from ..functions import times
from ..operators import alerts as A, changes as C, constraints, latest as L, trends as V, windows as W
from ..session import prepare, work_root
from ..sources import changes as changes_source, sensor_feed as feed
from ..streaming import days, files, pipeline, queries as Q, sinks
from .views import register_stored_views, register_views

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 9
STREAM = StreamSettings(trigger=DRAIN)


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.round(n, DIGITS) for n in names})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.read_events(prepare(spark), sf_dir)


def _changes(spark: SparkSession, sf_dir: str, *, dense: bool) -> DataFrame:
    return feed.changes(_events(spark, sf_dir), dense=dense)


def _readings(spark: SparkSession, sf_dir: str, *, dense: bool) -> DataFrame:
    return C.readings(_changes(spark, sf_dir, dense=dense))


def _measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.measurements(_events(spark, sf_dir))


# --- decode -------------------------------------------------------------------------------------


def cdc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.decode(_changes(spark, sf_dir, dense=True), history=True)


def cdc_decode_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = C.decode(feed.dirty_changes(_events(spark, sf_dir)))
    return decoded.withColumn("kept", F.col("id").isNotNull())


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _readings(spark, sf_dir, dense=True)
    return rows.withColumn("measurement_time", times.local_time("measurement_time"))


def change_op_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.profile_by_op(_changes(spark, sf_dir, dense=True))


def table_state_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table_state(_changes(spark, sf_dir, dense=False))


def time_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.decode(_changes(spark, sf_dir, dense=False)).where("id is not null")
    at = times.event_time("measurement_time")
    minute = F.window(at, "1 minute")
    return (
        rows.select(
            "seq",
            times.whole_millis("measurement_time").alias("millis"),
            times.local_time(at).alias("local_time"),
            minute.alias("minute"),
            at.alias("at"),
        )
        .select("*", F.window("at", "1 hour").alias("hour"))
        .select(
            "seq",
            "millis",
            "local_time",
            times.window_end("minute").alias("minute_end"),
            times.window_end("hour").alias("hour_end"),
            times.hour_of_day("local_time").alias("hour_of_day"),
            times.day_of("local_time").alias("day"),
            times.hour_start("local_time").alias("hour_start"),
            (F.col("local_time") - F.expr("INTERVAL 5 SECONDS")).alias("watermark_bound"),
            (F.col("local_time") - F.expr("INTERVAL '24' HOURS")).alias("day_before"),
        )
    )


# --- rules, windows, latest ---------------------------------------------------------------------


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alerts(_readings(spark, sf_dir, dense=True))


def status_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.status_feed(_readings(spark, sf_dir, dense=True))


def current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.current_status(_readings(spark, sf_dir, dense=True))


def current_status_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.current_status_ranked(_readings(spark, sf_dir, dense=True))


def current_status_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status over the damaged feed: only valid readings count."""
    return L.current_status(C.readings(feed.dirty_changes(_events(spark, sf_dir))))


def avg_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(W.minute_averages(_readings(spark, sf_dir, dense=True)), "avg_co2")


def hourly_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(W.hourly_aggregates(_readings(spark, sf_dir, dense=True)), "avg_co2")


def null_location_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.when(F.col("event_type") != "error", F.col("event_type"))
    changes = feed.changes(_events(spark, sf_dir), dense=True, place=place)
    return _rounded(W.hourly_aggregates(C.readings(changes)), "avg_co2")


def sink_constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base-table limits over the damaged feed; every third place name is too long."""
    rows = C.decode(feed.dirty_changes(_events(spark, sf_dir)))
    long_name = F.when(F.col("seq") % 3 == 0, F.repeat("location", 30)).otherwise(F.col("location"))
    base = rows.withColumns(
        {"measurement_time": times.event_time("measurement_time"), "location": long_name}
    )
    checked = constraints.check(base, schemas.MEASUREMENTS)
    return checked.select("seq", "id", "co2_level", "violations", "is_valid")


# --- trends -------------------------------------------------------------------------------------


def daily_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(V.daily_patterns(_measurements(spark, sf_dir)), "avg_co2")


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(V.daily_summary(_measurements(spark, sf_dir)), "avg_co2")


def daily_summary_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view over the table state rebuilt from the change log."""
    state = C.table_state(_changes(spark, sf_dir, dense=False))
    return _rounded(V.daily_summary(state), "avg_co2")


def alert_summary_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.alert_summary_hourly(A.alerts(_readings(spark, sf_dir, dense=False)))


def sensor_stats_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = W.hourly_aggregates(_readings(spark, sf_dir, dense=False))
    return _rounded(V.sensor_stats_24h(hourly), "hourly_avg", "rolling_24h_avg")


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dashboard query in SQL over the registered views, with the registered functions."""
    events = _events(spark, sf_dir)
    register_views(feed.measurements(events), feed.changes(events, dense=False))
    return spark.sql(
        """
        SELECT s.measurement_date, s.location, s.alerts_count,
               coalesce(a.stream_alerts, 0) AS stream_alerts, round(s.max_co2, 9) AS max_co2,
               co2_status(s.max_co2) AS peak_status, co2_feed_label(s.avg_co2) AS usual_label,
               CASE WHEN is_co2_alert(s.max_co2) THEN co2_alert_message(s.max_co2) END AS peak_message
        FROM daily_summary s
        LEFT JOIN (SELECT CAST(alert_hour AS DATE) AS alert_date, location,
                     sum(alert_count) AS stream_alerts
              FROM alert_summary_hourly GROUP BY 1, 2) a
          ON a.alert_date = s.measurement_date AND a.location <=> s.location
        """
    )


# --- streams ------------------------------------------------------------------------------------
# Each runs over the whole table until the source is drained and returns what the sink holds.


def _change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.changes(feed.stream_events(prepare(spark), sf_dir), dense=True)


def _reading_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.readings(_change_stream(spark, sf_dir))


def cdc_decode_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_root(prepare(spark))
    Q.start_bronze(_change_stream(spark, sf_dir), root, STREAM).awaitTermination()
    rows = Q.read_bronze(spark, root)
    return rows.withColumn("measurement_time", times.local_time("measurement_time"))


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_root(prepare(spark))
    Q.start_alerts(_reading_stream(spark, sf_dir), root, STREAM).awaitTermination()
    return sinks.read_appended(spark, schemas.ALERTS, f"{root}/alerts")


def avg_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_root(prepare(spark))
    Q.start_minute_averages(_reading_stream(spark, sf_dir), root, STREAM).awaitTermination()
    rows = sinks.read_appended(spark, schemas.MINUTE_AVERAGES, f"{root}/minute")
    return _rounded(rows, "avg_co2")


def hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_root(prepare(spark))
    Q.start_hourly(_reading_stream(spark, sf_dir), root, STREAM).awaitTermination()
    rows = sinks.read_appended(spark, schemas.HOURLY_AGGREGATES, f"{root}/hourly")
    return _rounded(rows, "avg_co2")


def _status(spark: SparkSession, changes: DataFrame) -> DataFrame:
    root = work_root(spark)
    Q.start_bronze(changes, root, STREAM).awaitTermination()
    days.start_status(spark, root, STREAM).awaitTermination()
    return days.read_status(spark, root)


def current_status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest status by way of bronze and the newest reading of each sensor and day."""
    return _status(spark, _change_stream(spark, sf_dir))


def current_status_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest status as a stream of upserts with state, applied to nothing but their own log."""
    root = work_root(prepare(spark))
    write = sinks.changed_rows(schemas.CURRENT_STATUS, f"{root}/upserts")
    Q.start_status_upserts(_reading_stream(spark, sf_dir), root, STREAM, write).awaitTermination()
    rows = spark.read.parquet(f"{root}/upserts").drop("batch")
    return L.newest(rows, "sensor_id", L.recency(rows, "last_updated")).select(*schemas.CURRENT_STATUS.names)


LATE_SLICES = 4
LATE_EVERY = 7
LATE_BY_MICROS = 90 * 60 * 1_000_000
SLICE_MICROS = 12 * 60 * 60 * 1_000_000 // LATE_SLICES


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute averages of a feed in which every seventh reading arrives 90 minutes late.

    The changes land in slices of arrival time. After each slice the same query runs from its
    checkpoint, so a late reading is dropped exactly when the slices before it moved the watermark
    past the end of its window.
    """
    root = work_root(prepare(spark))
    landing = f"{root}/landing"
    files.make_dir(spark, landing)
    events = _events(spark, sf_dir)
    delay = F.when(F.col("event_id") % LATE_EVERY == 3, LATE_BY_MICROS).otherwise(0)
    arrival = feed.event_micros(dense=True) + delay - F.lit(feed.EPOCH_MICROS)
    slice_no = F.least(F.call_function("div", arrival, F.lit(SLICE_MICROS)), F.lit(LATE_SLICES - 1))
    staged = f"{root}/staged"
    keyed = feed.changes(events.withColumn("slice", slice_no), dense=True, keep=("slice",))
    keyed.write.partitionBy("slice").parquet(staged)
    for number in range(LATE_SLICES):
        arrived = spark.read.parquet(staged).where(F.col("slice") == number).drop("slice")
        arrived.write.mode("append").parquet(landing)
        stream = spark.readStream.schema("seq bigint, value string").parquet(landing)
        Q.start_minute_averages(C.readings(stream), root, STREAM).awaitTermination()
    rows = sinks.read_appended(spark, schemas.MINUTE_AVERAGES, f"{root}/minute")
    return _rounded(rows, "avg_co2")


def quarantine_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What bronze kept of the damaged feed as it came, by what is wrong with it, and how much the decoder makes of it
    in a second try."""
    root = work_root(prepare(spark))
    changes = feed.dirty_changes(feed.stream_events(spark, sf_dir))
    Q.start_bronze(changes, root, STREAM).awaitTermination()
    kept = C.decode(Q.read_quarantine(spark, root))
    return kept.groupBy("problem").agg(
        F.count(F.lit(1)).alias("documents"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.count("sensor_id").alias("with_sensor"), F.count("id").alias("with_id"),
    )


def current_status_dirty_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(prepare(spark), feed.dirty_changes(feed.stream_events(spark, sf_dir)))


def _land(spark: SparkSession, sf_dir: str, root: str, part: Column, *, dense: bool = True, name: str = "landing") -> None:
    """Append the changes of some of the events to a landing folder."""
    arrived = feed.changes(_events(spark, sf_dir).where(part), dense=dense)
    arrived.write.mode("append").parquet(f"{root}/{name}")


def _landed(spark: SparkSession, root: str, name: str = "landing") -> DataFrame:
    return changes_source.stream_files(spark, f"{root}/{name}")


BEHIND_BY_MICROS = 60 * 60 * 1_000_000


def avg_1m_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute windows of two feeds, of which one stays an hour behind the other.

    Sensors 1 to 3 and 4 to 5 come by different feeds. Twice all that has come is worked off: first the readings of
    the first half of the time, then the rest, in the second feed up to an hour before the end. Under one
    watermark its readings would be late.
    """
    root = work_root(prepare(spark))
    micros = feed.event_micros(dense=True) - F.lit(feed.EPOCH_MICROS)
    second = F.col("user_id") % 5 >= 3
    half, end = 2 * SLICE_MICROS, 4 * SLICE_MICROS
    for low, high in ((0, half), (half, end)):
        for name, own, lag in (("first", ~second, 0), ("second", second, BEHIND_BY_MICROS)):
            from_ = low - lag if low else 0
            _land(spark, sf_dir, root, own & (micros >= from_) & (micros < high - lag), name=name)
        pipeline.drain({name: _landed(spark, root, name) for name in ("first", "second")}, root, STREAM, outputs=["minute"])
    rows = sinks.read_appended(spark, schemas.MINUTE_AVERAGES, f"{root}/minute")
    return _rounded(rows, "avg_co2")


def alert_summary_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The materialized form over the stored alerts, refreshed after each of two batches of changes."""
    root = work_root(prepare(spark))
    early = F.col("event_id") % 3 == 0
    for part in (early, ~early):
        _land(spark, sf_dir, root, part, dense=False)
        readings = C.readings(_landed(spark, root))
        Q.start_alerts(readings, root, STREAM).awaitTermination()
        days.refresh_alert_summary(spark, root)
    return days.read_alert_summary(spark, root)


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend partials after three batches of changes: most of the creates, then updates and deletes of their
    rows with creates of the same days, then what came last."""
    root = work_root(prepare(spark))
    step = F.col("event_id") % 20
    last = F.col("event_id") % 100 == 57
    for part in ((step != 0) & (step != 3) & ~last, (step == 0) | (step == 3), last):
        _land(spark, sf_dir, root, part, dense=False)
        Q.start_bronze(_landed(spark, root), root, STREAM).awaitTermination()
        days.refresh_trends(spark, root)
    return days.TREND_PARTIALS.read(spark, root)


def daily_summary_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(V.summary_of(_partials(spark, sf_dir)), "avg_co2")


def daily_patterns_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(V.patterns_of(_partials(spark, sf_dir)), "avg_co2")


def hourly_with_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows of a root that is drained, fed more data and drained again: the first drain
    writes its history in a batch, the second goes on from the recorded cut."""
    root = work_root(prepare(spark))
    early = feed.event_micros(dense=True) < F.lit(feed.EPOCH_MICROS + 2 * SLICE_MICROS + 900_000_000)
    for part in (early, ~early):
        _land(spark, sf_dir, root, part)
        pipeline.drain(_landed(spark, root), root, STREAM, outputs=["hourly"])
    rows = sinks.read_appended(spark, schemas.HOURLY_AGGREGATES, f"{root}/hourly")
    return _rounded(rows, "avg_co2")


def daily_summary_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view over the table state rebuilt from the changes bronze keeps."""
    root = work_root(prepare(spark))
    stream = feed.changes(feed.stream_events(spark, sf_dir), dense=False)
    Q.start_bronze(stream, root, STREAM).awaitTermination()
    return _rounded(V.daily_summary(C.state_of(Q.read_history(spark, root))), "avg_co2")


def views_over_stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dashboard query in SQL over the tables the pipeline wrote."""
    root = work_root(prepare(spark))
    pipeline.drain(_change_stream(spark, sf_dir), root, STREAM, outputs=["hourly", "alerts", "status"])
    days.refresh_alert_summary(spark, root)
    register_stored_views(spark, root)
    return spark.sql(
        """
        SELECT h.window_end, h.location, h.readings_max, coalesce(a.alert_count, 0) AS alert_count,
               p.rows_of_hour, (SELECT count(*) FROM current_co2_status) AS sensors
        FROM (SELECT window_end, location, max(max_co2) AS readings_max
              FROM co2_hourly_aggregates GROUP BY 1, 2) h
        LEFT JOIN alert_summary_hourly a
          ON a.alert_hour = h.window_end - INTERVAL 1 HOUR AND a.location <=> h.location
        LEFT JOIN (SELECT hour(measurement_time) AS hour_of_day, location, count(*) AS rows_of_hour
                   FROM co2_measurements GROUP BY 1, 2) p
          ON p.hour_of_day = hour(h.window_end - INTERVAL 1 HOUR) AND p.location <=> h.location
        """
    )


def pipeline_all_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job; every row of the four outputs, with the name of its table."""
    root = work_root(prepare(spark))
    pipeline.drain(_change_stream(spark, sf_dir), root, STREAM)

    def tagged(table: schemas.Table, rows: DataFrame, time: str, text: str | None = None) -> DataFrame:
        levels = [
            (F.round(c, DIGITS) if c in rows.columns else F.lit(None).cast("double")).alias(c)
            for c in ("co2_level", "avg_co2", "min_co2", "max_co2")
        ]
        return rows.select(
            F.lit(table.name).alias("output"),
            "sensor_id",
            "location",
            F.col(time).alias("at"),
            *levels,
            (F.col(text) if text else F.lit(None).cast("string")).alias("label"),
        )

    def stored(table: schemas.Table, name: str) -> DataFrame:
        return sinks.read_appended(spark, table, f"{root}/{name}")

    minute, hourly = schemas.MINUTE_AVERAGES, schemas.HOURLY_AGGREGATES
    status = days.read_status(spark, root)
    return (
        tagged(minute, stored(minute, "minute"), "window_end")
        .union(tagged(hourly, stored(hourly, "hourly"), "window_end"))
        .union(tagged(schemas.ALERTS, stored(schemas.ALERTS, "alerts"), "alert_time", "message"))
        .union(tagged(schemas.CURRENT_STATUS, status, "last_updated", "status"))
    )


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        cdc_decode,
        cdc_decode_dirty,
        readings,
        change_op_profile,
        table_state_from_changes,
        time_expressions,
        alerts,
        status_feed,
        current_status,
        current_status_ranked,
        current_status_dirty,
        avg_1m,
        hourly_aggregates,
        null_location_groups,
        sink_constraint_check,
        daily_patterns,
        daily_summary,
        daily_summary_from_changes,
        alert_summary_hourly,
        sensor_stats_24h,
        sql_views,
    )
}
STREAMS: dict[str, Query] = {
    f.__name__: f
    for f in (
        cdc_decode_stream,
        alerts_stream,
        avg_1m_stream,
        hourly_stream,
        current_status_stream,
        current_status_upserts,
        current_status_dirty_stream,
        quarantine_by_kind,
        alert_summary_refresh,
        daily_summary_from_partials,
        daily_patterns_from_partials,
        avg_1m_two_sources,
        hourly_with_backfill,
        daily_summary_from_bronze,
        views_over_stored_tables,
        late_rows,
        pipeline_all_sinks,
    )
}
