"""The streaming outputs, each as (readings stream) -> started query.

Outputs go to Parquet below ``root`` unless a batch writer (database table) is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import Rules, StreamSettings
from ..functions import times
from ..operators import alerts as A, changes as C, constraints, latest as L, windows as W
from ..sources import changes as feeds
from . import files, sinks


#: Several feeds: readings of each, in an order that never changes for a root.
Feeds = DataFrame | Sequence[DataFrame]


def merged(feeds: Feeds) -> DataFrame:
    return feeds if isinstance(feeds, DataFrame) else reduce(DataFrame.unionByName, feeds)


def _since(readings: DataFrame, cut: datetime | None) -> DataFrame:
    if cut is None:
        return readings
    since = F.lit(cut).cast("timestamp")
    readings = readings.where(F.col("measurement_time") >= since)
    if "event_date" in readings.columns:  # bronze: skip the partitions of older days
        readings = readings.where(F.col("event_date") >= F.to_date(since))
    return readings


def watermarked(feeds: Feeds, settings: StreamSettings, idle: frozenset[int] = frozenset()) -> DataFrame:
    """The readings of all feeds under one watermark: that of the feed furthest behind.

    Each feed has a watermark of its own and Spark goes by the least of them (``multipleWatermarkPolicy``), so a
    feed that lags keeps its windows open. A feed in ``idle`` has none; it rides with the feed before it (or the
    first that is not idle), so the order of the sources, which the checkpoint knows them by, stays the same.
    """
    feeds = [feeds] if isinstance(feeds, DataFrame) else list(feeds)
    groups: list[list[DataFrame]] = []
    waiting: list[DataFrame] = []
    for number, readings in enumerate(feeds):
        readings = _since(readings, settings.windows_from)
        if number not in idle:
            groups.append([*waiting, readings])
            waiting = []
        elif groups:
            groups[-1].append(readings)
        else:
            waiting.append(readings)
    if waiting:
        groups.append(waiting)
    return merged([merged(g).withWatermark("measurement_time", settings.watermark) for g in groups])


def _start_append(
    rows: DataFrame,
    table: schemas.Table,
    name: str,
    root: str,
    settings: StreamSettings,
    write: sinks.BatchWriter | None,
) -> StreamingQuery:
    checkpoint = f"{root}/_checkpoints/{name}"
    if write is None:
        return sinks.append(rows, table, f"{root}/{name}", checkpoint, settings)
    return sinks.for_each_batch(rows, write, table.name, checkpoint, settings)


def start_minute_averages(
    readings: Feeds,
    root: str,
    settings: StreamSettings,
    write: sinks.BatchWriter | None = None,
    idle: frozenset[int] = frozenset(),
) -> StreamingQuery:
    rows = W.minute_averages(watermarked(readings, settings, idle))
    return _start_append(rows, schemas.MINUTE_AVERAGES, "minute", root, settings, write)


def start_hourly(
    readings: Feeds,
    root: str,
    settings: StreamSettings,
    write: sinks.BatchWriter | None = None,
    idle: frozenset[int] = frozenset(),
) -> StreamingQuery:
    rows = W.hourly_aggregates(watermarked(readings, settings, idle))
    return _start_append(rows, schemas.HOURLY_AGGREGATES, "hourly", root, settings, write)


def start_alerts(
    readings: DataFrame,
    root: str,
    settings: StreamSettings,
    rules: Rules = Rules(),
    write: sinks.BatchWriter | None = None,
) -> StreamingQuery:
    rows = A.alerts(readings, rules)
    return _start_append(rows, schemas.ALERTS, "alerts", root, settings, write)


def latest_status(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Upsert stream of the latest valid reading per sensor (update mode, state never expires)."""
    return L.newest_status(readings, rules)


def start_status_upserts(
    readings: DataFrame,
    root: str,
    settings: StreamSettings,
    write: sinks.BatchWriter,
    rules: Rules = Rules(),
) -> StreamingQuery:
    """Hand every changed status row to ``write``, which replaces the sensor's row by it."""
    return sinks.for_each_batch(
        latest_status(readings, rules),
        write,
        schemas.CURRENT_STATUS.name,
        f"{root}/_checkpoints/status",
        settings,
        mode="update",
    )


READING_COLUMNS = (
    "id bigint, sensor_id string, co2_level double, measurement_time timestamp, location string, "
    "op string, violations string, event_date date"
)
HISTORY_COLUMNS = "before_id bigint, ts_ms bigint, measurement_micros bigint"
QUARANTINE_COLUMNS = "problem string, raw string"


#: Name of the count of readings older than the windows' cut among a bronze batch.
BEFORE_CUT = "before_cut"


def bronze_path(root: str, feed: str = "") -> str:
    """A root with one unnamed feed has one bronze table, named feeds have one each."""
    return f"{root}/bronze-{feed}" if feed else f"{root}/bronze"


def recorded_feeds(spark: SparkSession, root: str) -> list[str]:
    text = files.read_text(spark, f"{root}/feeds.txt")
    return text.split("\n") if text else [""]


def agree_on_feeds(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    """Record the names of the feeds of a root; other names later are refused, as the checkpoints of the
    outputs know their sources by number."""
    if any(not n.replace("_", "").isalnum() for n in names if names != [""]) or len(set(names)) < len(names):
        raise ValueError("feeds need distinct names of letters, digits and underscores")
    known = files.read_text(spark, f"{root}/feeds.txt")
    begun = known is not None or files.exists(spark, bronze_path(root))
    if begun and recorded_feeds(spark, root) != list(names):
        raise ValueError(f"the feeds of this root are {recorded_feeds(spark, root)}, not {list(names)}")
    if known is None and names != [""]:
        files.write_text(spark, f"{root}/feeds.txt", "\n".join(names))


def start_bronze(
    changes: DataFrame, root: str, settings: StreamSettings, feed: str = "", cut: datetime | None = None
) -> StreamingQuery:
    """Decode the feed once into a Parquet table partitioned by event date.

    All changes that name a row are kept, deletes too; readings that break a base-table constraint
    carry the reason. Deletes lie under the date of the change. Documents that name no row lie, as they came and
    with what is wrong, in the partition without a date (``read_quarantine``). ``files_per_batch`` bounds the files
    a batch leaves per date. Readings older than ``cut``, before which the windows are written and closed, are
    kept here but come too late for them; each batch counts those it brings.
    """
    at = F.col("measurement_time")
    rows = C.history(changes, quarantine=True).withColumns(
        {"measurement_micros": at, "measurement_time": times.event_time("measurement_time")}
    )
    reading = F.col("id").isNotNull()
    dated = F.when(reading, F.to_date("measurement_time")).otherwise(F.to_date(F.timestamp_millis("ts_ms")))
    rows = rows.withColumns(
        {
            "violations": F.when(reading, constraints.violations(schemas.MEASUREMENTS)),
            "event_date": F.when(F.col("problem").isNull(), dated),
        }
    )
    if cut is not None:
        late = reading & (F.col("measurement_time") < F.lit(cut).cast("timestamp"))
        rows = rows.observe(BEFORE_CUT, F.count_if(late).alias("rows"))
    if settings.files_per_batch:
        rows = rows.repartition(settings.files_per_batch)
    path = bronze_path(root, feed)
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path).partitionBy("event_date")
    name = path.rpartition("/")[2]
    return sinks.start(writer, name, f"{root}/_checkpoints/{name}", settings, settings.bronze_trigger)


def bronze_schema(seq_type: str) -> str:
    return f"seq {seq_type}, {READING_COLUMNS}, {HISTORY_COLUMNS}, {QUARANTINE_COLUMNS}"


def stored_seq_type(spark: SparkSession, root: str) -> str:
    """The type of ``seq`` the bronze table of a root was written with."""
    stored = spark.read.parquet(bronze_path(root, recorded_feeds(spark, root)[0]))
    return stored.schema["seq"].dataType.simpleString()


def _readings_of(bronze: DataFrame) -> DataFrame:
    columns = [c.split(" ")[0] for c in READING_COLUMNS.split(", ")]
    return bronze.where("id is not null").select("seq", *columns)


def _bronze(spark: SparkSession, root: str, seq_type: str) -> list[DataFrame]:
    reader = spark.read.schema(bronze_schema(seq_type))
    return [
        reader.parquet(bronze_path(root, feed)).withColumn("feed", F.lit(feed))
        for feed in recorded_feeds(spark, root)
    ]


def read_history(spark: SparkSession, root: str, seq_type: str = "bigint") -> DataFrame:
    """All changes in bronze, as ``operators.changes.history`` returns them, with the name of their feed."""
    return _named(merged(_bronze(spark, root, seq_type))).withColumn("measurement_time", F.col("measurement_micros"))


def _named(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.coalesce("id", "before_id").isNotNull()).drop("problem", "raw")


def read_quarantine(spark: SparkSession, root: str, seq_type: str = "bigint") -> DataFrame:
    """The documents that named no row, with what was wrong. As they have ``seq`` and ``value`` they are a feed: a
    mended decoder reads them as it reads any other, in their old order."""
    rows = merged(_bronze(spark, root, seq_type)).where("event_date IS NULL AND problem IS NOT NULL")
    return rows.select("feed", "seq", F.col("raw").alias("value"), "problem")


def read_bronze(spark: SparkSession, root: str, seq_type: str = "bigint") -> DataFrame:
    """The readings in bronze."""
    return _readings_of(merged(_bronze(spark, root, seq_type)))


def _bronze_streams(
    spark: SparkSession, root: str, seq_type: str, max_files: int | None
) -> list[DataFrame]:
    reader = spark.readStream.schema(bronze_schema(seq_type)).options(**feeds.ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return [reader.parquet(bronze_path(root, feed)).withColumn("feed", F.lit(feed)) for feed in recorded_feeds(spark, root)]


def stream_bronze(
    spark: SparkSession, root: str, seq_type: str = "bigint", max_files: int | None = None
) -> list[DataFrame]:
    """The readings in bronze as streams, one per feed."""
    return [_readings_of(s) for s in _bronze_streams(spark, root, seq_type, max_files)]


def stream_history(spark: SparkSession, root: str, seq_type: str = "bigint") -> DataFrame:
    """All changes as they reach bronze."""
    return _named(merged(_bronze_streams(spark, root, seq_type, None)))


def _passed_hour(spark: SparkSession, root: str, settings: StreamSettings, seq_type: str) -> datetime | None:
    """The last full hour before the watermark of the bronze feed furthest behind; none while one is empty."""
    last = F.max("measurement_time") - F.expr(f"INTERVAL {settings.watermark}")
    hour = times.local_time(F.date_trunc("hour", last))
    passed = [_readings_of(b).agg(hour.alias("hour")).first().hour for b in _bronze(spark, root, seq_type)]
    return None if None in passed else min(passed)


def recorded_cut(spark: SparkSession, root: str) -> datetime | None:
    text = files.read_text(spark, f"{root}/windows_from.txt")
    return datetime.fromisoformat(text) if text else None


def backfill_done(spark: SparkSession, root: str) -> bool:
    return all(
        files.is_finished(spark, sinks.backfill_path(f"{root}/{name}")) for name in ("minute", "hourly")
    )


def finished_cut(spark: SparkSession, root: str) -> datetime | None:
    """The recorded cut, once the windows before it are written."""
    cut = recorded_cut(spark, root)
    return cut if cut and backfill_done(spark, root) else None


def _windows_started(spark: SparkSession, root: str) -> bool:
    return any(files.exists(spark, f"{root}/_checkpoints/{name}") for name in ("minute", "hourly"))


def agree_on_cut(
    spark: SparkSession, root: str, settings: StreamSettings, seq_type: str, *, backfill: bool
) -> StreamSettings:
    """The settings with the time the window streams of this root start from.

    The cut between batch history and stream is chosen once per root and recorded there: with
    ``backfill`` (a drain) and no record yet it is ``windows_from``, or else the last hour bronze has
    passed. A different ``windows_from``, one for windows that already run without, and a cut whose
    history is not written are refused: each would leave out windows without a word.
    """
    recorded, wanted = recorded_cut(spark, root), settings.windows_from
    if recorded is None and _windows_started(spark, root):
        if wanted:
            raise ValueError("the windows of this root run from the start; windows_from comes too late")
        return settings
    if recorded and wanted not in (None, recorded):
        raise ValueError(f"windows_from of this root is {recorded}, it cannot become {wanted}")
    if not backfill:
        if wanted and not recorded:
            raise ValueError("windows_from needs a drain first, which writes the windows before it")
        if recorded and not backfill_done(spark, root):
            raise ValueError("the windows before windows_from are not written; finish the drain first")
        return replace(settings, windows_from=recorded)
    passed = None if recorded else _passed_hour(spark, root, settings, seq_type)
    if wanted and not recorded:
        if wanted.replace(minute=0, second=0, microsecond=0) != wanted:
            raise ValueError("windows_from has to be on the hour, or a window would be cut in two")
        if passed is None or wanted > passed:
            raise ValueError("windows_from is ahead of the watermark; those windows are still open")
    cut = recorded or wanted or passed
    if cut and not recorded:
        files.write_text(spark, f"{root}/windows_from.txt", cut.isoformat())
    return replace(settings, windows_from=cut)


def backfill_windows(
    spark: SparkSession, root: str, settings: StreamSettings, seq_type: str
) -> None:
    """Write the windows before ``windows_from`` in a batch, unless that is done already.

    The batch needs no state and shuffles partial aggregates only. Rows of that time which reach
    bronze later are late, as they would be for the stream.
    """
    cut = F.lit(settings.windows_from).cast("timestamp")
    history = read_bronze(spark, root, seq_type)
    old = history.where((F.col("measurement_time") < cut) & (F.col("event_date") <= F.to_date(cut)))
    for table, name, windows in (
        (schemas.MINUTE_AVERAGES, "minute", W.minute_averages),
        (schemas.HOURLY_AGGREGATES, "hourly", W.hourly_aggregates),
    ):
        path = f"{root}/{name}"
        if not files.is_finished(spark, sinks.backfill_path(path)):
            sinks.write_backfill(windows(old), table, path)
