"""One feed, four outputs.

The feed is decoded once into a bronze table; four queries read that table. Each has its own
checkpoint, so one of them can be restarted without touching the others, and the topic is read once
whatever the number of outputs. To rebuild one output from bronze, call ``reset_output`` and drain
again; a new checkpoint over an existing output is refused, since it would lose rows.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Collection, Mapping
from dataclasses import replace
from types import MappingProxyType

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import DRAIN, Rules, StreamSettings
from . import days, files, queries as Q
from .sinks import BatchWriter

log = logging.getLogger(__name__)

#: Starts a query; those of the windows also take the numbers of the feeds that are idle.
Starter = Callable[..., StreamingQuery]
NONE_IDLE: frozenset[int] = frozenset()
#: One feed, or several by name.
Changes = DataFrame | Mapping[str, DataFrame]
WINDOWS = ("minute", "hourly")
#: Result-table name -> writer that replaces the Parquet sink of that table.
Writers = Mapping[str, BatchWriter]


def output_starters(
    spark: SparkSession,
    root: str,
    settings: StreamSettings,
    rules: Rules,
    seq_type: str,
    writers: Writers,
) -> dict[str, Starter]:
    def whole() -> list[DataFrame]:
        return Q.stream_bronze(spark, root, seq_type)

    def stepwise() -> DataFrame:
        return Q.merged(Q.stream_bronze(spark, root, seq_type, settings.max_files_per_trigger))

    def writer(table: schemas.Table) -> BatchWriter | None:
        return writers.get(table.name)

    def start_status() -> StreamingQuery:
        write = writer(schemas.CURRENT_STATUS)
        if write is None:
            return days.start_status(spark, root, settings, rules, seq_type)
        return Q.start_status_upserts(stepwise(), root, settings, write, rules)

    return {
        "minute": lambda idle=NONE_IDLE: Q.start_minute_averages(
            whole(), root, settings, writer(schemas.MINUTE_AVERAGES), idle
        ),
        "alerts": lambda: Q.start_alerts(stepwise(), root, settings, rules, writer(schemas.ALERTS)),
        "status": start_status,
        "hourly": lambda idle=NONE_IDLE: Q.start_hourly(
            whole(), root, settings, writer(schemas.HOURLY_AGGREGATES), idle
        ),
    }


def _named(changes: Changes) -> dict[str, DataFrame]:
    return {"": changes} if isinstance(changes, DataFrame) else dict(changes)


def _prepare(spark: SparkSession, root: str, settings: StreamSettings, feeds: dict[str, DataFrame]) -> None:
    if settings.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(settings.shuffle_partitions))
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    Q.agree_on_feeds(spark, root, list(feeds))
    for feed in feeds:
        files.make_dir(spark, Q.bronze_path(root, feed))


def _bronze_starters(
    spark: SparkSession, root: str, settings: StreamSettings, feeds: dict[str, DataFrame]
) -> dict[str, Starter]:
    cut = Q.finished_cut(spark, root)

    def starter(feed: str) -> Starter:
        return lambda: Q.start_bronze(feeds[feed], root, settings, feed, cut)

    return {Q.bronze_path(root, feed).rpartition("/")[2]: starter(feed) for feed in feeds}


def seq_type_of(changes: Changes) -> str:
    types = {c.schema["seq"].dataType.simpleString() for c in _named(changes).values()}
    if len(types) > 1:
        raise ValueError(f"the feeds of a root need one type of seq, not {sorted(types)}")
    return types.pop()


def drain(
    changes: Changes,
    root: str,
    settings: StreamSettings = StreamSettings(trigger=DRAIN),
    rules: Rules = Rules(),
    writers: Writers = MappingProxyType({}),
    outputs: Collection[str] | None = None,
) -> None:
    """Process everything the feed holds now, then return. Repeating it picks up what is new.

    ``outputs`` names those to bring up to date (``minute``, ``alerts``, ``status``, ``hourly``); the others wait for a
    drain that asks for them.

    Bronze is complete before the outputs start, so no row is late because of the order in which
    parts of a long topic were read. Start here, then go on with ``run_live`` on the same root.

    Several feeds (by name) each have a watermark, and the windows wait for the one furthest behind; a
    feed that brings nothing in this drain is idle and not waited for, unless ``idle_after_seconds`` is None.
    """
    feeds = _named(changes)
    spark = next(iter(feeds.values())).sparkSession
    windows = {schemas.MINUTE_AVERAGES.name, schemas.HOURLY_AGGREGATES.name}
    if settings.windows_from and windows & set(writers):
        raise ValueError("windows_from writes history to Parquet; load it into the database apart")
    settings = replace(settings, bronze_trigger=None)
    _prepare(spark, root, settings, feeds)
    brought = run_to_end(_bronze_starters(spark, root, settings, feeds), settings)
    silent = {n for n, feed in enumerate(feeds) if not brought[Q.bronze_path(root, feed).rpartition("/")[2]]}
    if settings.idle_after_seconds is None or len(silent) == len(feeds):
        silent = set()
    if not windows & set(writers):
        settings = Q.agree_on_cut(spark, root, settings, seq_type_of(changes), backfill=True)
        if settings.windows_from:
            Q.backfill_windows(spark, root, settings, seq_type_of(changes))
    starters = output_starters(spark, root, settings, rules, seq_type_of(changes), writers)
    wanted = starters if outputs is None else {name: starters[name] for name in outputs}
    run_to_end(wanted, settings, idle=frozenset(silent))


def run_live(
    changes: Changes,
    root: str,
    settings: StreamSettings = StreamSettings(),
    rules: Rules = Rules(),
    writers: Writers = MappingProxyType({}),
) -> None:
    """Run all queries until one of them fails for good.

    On a root that was drained the windows go on from the cut recorded there. Of several feeds, one that brings
    nothing for ``idle_after_seconds`` no longer holds the windows back until it speaks again.
    """
    feeds = _named(changes)
    spark = next(iter(feeds.values())).sparkSession
    _prepare(spark, root, settings, feeds)
    settings = Q.agree_on_cut(spark, root, settings, seq_type_of(changes), backfill=False)
    starters = _bronze_starters(spark, root, settings, feeds)
    starters |= output_starters(spark, root, settings, rules, seq_type_of(changes), writers)
    run_to_end(starters, settings, feeds=len(feeds))


#: Outputs that ``reset_output`` can clear, with the folders each consists of.
OUTPUTS = {
    "minute": ("_checkpoints/minute", "minute", "minute_backfill"),
    "hourly": ("_checkpoints/hourly", "hourly", "hourly_backfill"),
    "alerts": ("_checkpoints/alerts", "alerts"),
    "status": ("_checkpoints/status_days", "status_days"),
    "alert_summary": ("_checkpoints/alert_summary", "alert_summary"),
    "trend_partials": ("_checkpoints/trend_partials", "trend_partials"),
}


def reset_output(spark: SparkSession, root: str, name: str) -> None:
    """Remove an output with its checkpoint, so that the next drain builds it anew from bronze.

    Rows that were late for the stream count in a rebuilt history. Nobody may read or write the
    output meanwhile. The checkpoint goes first: after a reset that broke off, an appended output without a
    checkpoint is refused until the reset is repeated; a table kept by day is built over again anyway.
    """
    for folder in OUTPUTS[name]:
        files.remove(spark, f"{root}/{folder}")


class _Progress:
    """Reads every finished batch once: reports rows that came too late, counts rows read and notes which
    sources are silent."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}
        self.read: dict[str, int] = {}
        self.last: dict[tuple[str, int], float] = {}

    def follow(self, name: str, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            if progress["batchId"] <= self.seen.get(name, -1):
                continue
            self.seen[name] = progress["batchId"]
            self.read[name] = self.read.get(name, 0) + progress["numInputRows"]
            for number, source in enumerate(progress["sources"]):
                if source["numInputRows"] > 0:
                    self.last[name, number] = time.monotonic()
            self._report(name, progress)

    def _report(self, name: str, progress) -> None:
        late = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        if late:
            # Readings of one group and task are counted as one: they are put together before they are dropped.
            log.warning("%s dropped %d late rows (groups of readings) in batch %d", name, late, progress["batchId"])
        before = progress["observedMetrics"].get(Q.BEFORE_CUT)
        if before is not None and before["rows"]:
            log.warning(
                "%s took in %d readings older than the windows' cut in batch %d; no window has them",
                name, before["rows"], progress["batchId"],
            )

    def idle(self, name: str, feeds: int, after: float) -> frozenset[int]:
        """Feeds silent for so long that nobody waits for them; none if all are, for then nothing moves anyway."""
        now = time.monotonic()
        silent = {n for n in range(feeds) if now - self.last.setdefault((name, n), now) > after}
        return frozenset(silent if len(silent) < feeds else ())


def _start(name: str, start: Starter, idle: frozenset[int]) -> StreamingQuery:
    """Start a query in a scheduler pool of its own; under the FAIR mode ``build_session`` sets, a
    large window batch then does not hold up the alerts."""
    context = SparkSession.active().sparkContext
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        return start(idle) if name in WINDOWS and idle else start()
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)


def run_to_end(
    starters: dict[str, Starter],
    settings: StreamSettings,
    *,
    idle: frozenset[int] = NONE_IDLE,
    feeds: int = 1,
) -> dict[str, int]:
    """Start all queries together, wait for them and return how many rows each read.

    A query that fails is started again from its checkpoint after a fixed delay, up to
    ``attempts`` times; after that the others are stopped and the failure is raised. With several ``feeds`` a
    window query starts again, from its checkpoint, when a feed falls silent or speaks again.
    """
    running: dict[str, StreamingQuery] = {}
    failures = dict.fromkeys(starters, 0)
    left_out = dict.fromkeys(starters, idle)
    progress = _Progress()
    try:
        for name, start in starters.items():
            running[name] = _start(name, start, idle)
        while running:
            for name, query in list(running.items()):
                try:
                    ended = query.awaitTermination(1)
                    progress.follow(name, query)
                    if ended:
                        del running[name]
                        continue
                    if name in WINDOWS and feeds > 1 and settings.idle_after_seconds is not None:
                        silent = progress.idle(name, feeds, settings.idle_after_seconds)
                        if silent != left_out[name]:
                            log.info("%s: idle feeds are now %s", name, sorted(silent))
                            query.stop()
                            progress.follow(name, query)
                            left_out[name] = silent
                            running[name] = _start(name, starters[name], silent)
                except StreamingQueryException:
                    failures[name] += 1
                    if failures[name] > settings.attempts:
                        raise
                    log.warning("%s failed, restart %d", name, failures[name], exc_info=True)
                    time.sleep(settings.retry_delay_seconds)
                    running[name] = _start(name, starters[name], left_out[name])
    finally:
        for query in running.values():
            query.stop()
    return {name: progress.read.get(name, 0) for name in starters}
