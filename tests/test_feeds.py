"""Several feeds, each with a watermark of its own, and the account of readings before the cut."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from airledger import __main__ as command, schemas
from airledger.config import DRAIN, StreamSettings
from airledger.operators import changes as C
from airledger.streaming import files, pipeline, queries as Q, sinks
from tests.conftest import change
from tests.test_streams import SETTINGS, Landing, hours, readings_at


def feed_at(spark, root, name):
    return Landing(spark, f"{root}/landing-{name}")


def at(*hours_, sensor, first=0):
    return [change(first + int(h * 100), sensor=sensor, seconds=h * 3600, level=410.0 + h) for h in hours_]


def windows(spark, root):
    found = sinks.read_appended(spark, schemas.HOURLY_AGGREGATES, f"{root}/hourly").collect()
    return sorted((r.sensor_id, r.window_end.hour) for r in found)


def feeds_of(landings):
    return {name: landing.stream() for name, landing in landings.items()}


def test_the_feed_furthest_behind_holds_the_windows(spark, root):
    ahead, behind = feed_at(spark, root, "ahead"), feed_at(spark, root, "behind")
    both = {"ahead": ahead, "behind": behind}
    ahead.add(*at(0.5, 4.5, sensor="a"))
    behind.add(*at(0.5, 1.5, sensor="b"))
    pipeline.drain(feeds_of(both), root, SETTINGS)
    assert Q.recorded_cut(spark, root) == dt.datetime(2024, 1, 1, 1)
    assert windows(spark, root) == [("a", 1), ("b", 1)]
    ahead.add(*at(6.5, sensor="a"))
    behind.add(*at(1.7, 2.5, 3.5, sensor="b"))  # late for the other feed, not for this one
    pipeline.drain(feeds_of(both), root, SETTINGS)
    assert windows(spark, root) == [("a", 1), ("b", 1), ("b", 2), ("b", 3)]
    ahead.add(*at(9.5, sensor="a"))
    behind.add(*at(8.5, sensor="b"))
    pipeline.drain(feeds_of(both), root, SETTINGS)
    assert windows(spark, root) == sorted([("a", 1), ("a", 5), ("a", 7), ("b", 1), ("b", 2), ("b", 3), ("b", 4)])


@pytest.mark.parametrize("after", [60.0, None])
def test_a_silent_feed_is_waited_for_or_not(spark, root, after):
    settings = StreamSettings(trigger=DRAIN, idle_after_seconds=after)
    landings = {n: feed_at(spark, root, n) for n in ("x", "y", "z")}
    for name, landing in landings.items():
        landing.add(*at(0.5, 1.5, sensor=name))
    pipeline.drain(feeds_of(landings), root, settings)
    landings["y"].add(*at(4.5, 6.5, sensor="y"))
    landings["z"].add(*at(3.5, 5.5, sensor="z"))
    pipeline.drain(feeds_of(landings), root, settings)
    closed = windows(spark, root)
    first = [(n, 1) for n in "xyz"]
    assert closed == sorted(first + ([("x", 2), ("y", 2), ("z", 2), ("y", 5), ("z", 4)] if after else []))
    landings["x"].add(*at(1.6, 7.5, sensor="x"))  # 1.6 is late if nobody waited
    landings["y"].add(*at(8.5, sensor="y"))
    landings["z"].add(*at(9.5, sensor="z"))
    pipeline.drain(feeds_of(landings), root, settings)
    rows = sinks.read_appended(spark, schemas.HOURLY_AGGREGATES, f"{root}/hourly")
    ((top,),) = rows.where("sensor_id = 'x' AND hour(window_end) = 2").select("max_co2").collect()
    assert top == (411.5 if after else 411.6)


def test_a_feed_falls_silent_and_speaks_again_in_a_live_run(spark, root):
    a, b = feed_at(spark, root, "a"), feed_at(spark, root, "b")
    settings = StreamSettings(trigger={"processingTime": "0 seconds"}, idle_after_seconds=6.0)
    a.add(*at(0.5, 1.5, sensor="a"))
    b.add(*at(0.5, 1.5, sensor="b"))
    failed = []

    def run():
        try:
            pipeline.run_live({"a": a.stream(), "b": b.stream()}, root, settings)
        except Exception as error:  # stopped below
            failed.append(error)

    thread = threading.Thread(target=run)
    thread.start()

    def wait(want):
        deadline = time.time() + 100
        while time.time() < deadline:
            if files.exists(spark, f"{root}/hourly/_spark_metadata") and windows(spark, root) == want:
                return
            time.sleep(1)
        raise AssertionError((windows(spark, root), want))

    try:
        wait([("a", 1), ("b", 1)])
        deadline = time.time() + 60
        number = 3.5
        while time.time() < deadline and ("b", 2) not in windows(spark, root):  # b is silent
            a.add(*at(number, sensor="a"))
            number += 1
            time.sleep(2)
        assert ("b", 2) in windows(spark, root)
        b.add(*at(40.5, sensor="b"))
        a.add(*at(41.5, sensor="a"))
        wait_for = {("a", 1), ("a", 2), ("b", 1), ("b", 2)}
        assert wait_for <= set(windows(spark, root))
    finally:
        for query in spark.streams.active:
            query.stop()
        thread.join(60)
    assert not thread.is_alive()


def test_feeds_of_a_root_are_fixed(spark, root):
    a, b = feed_at(spark, root, "a"), feed_at(spark, root, "b")
    a.add(*at(0.5, sensor="a"))
    b.add(*at(0.7, sensor="b"))
    with pytest.raises(ValueError, match="names"):
        pipeline.drain({"a/b": a.stream()}, root, SETTINGS)
    pipeline.drain({"a": a.stream(), "b": b.stream()}, root, SETTINGS)
    for other in ({"a": a.stream()}, {"b": b.stream(), "a": a.stream()}, a.stream()):
        with pytest.raises(ValueError, match="feeds of this root"):
            pipeline.drain(other, root, SETTINGS)
    assert Q.recorded_feeds(spark, root) == ["a", "b"]


def test_rows_of_different_feeds_share_no_ids(spark, root):
    a, b = feed_at(spark, root, "a"), feed_at(spark, root, "b")
    a.add(change(1, sensor="a"), change(2, sensor="a"))
    b.add(change(1, sensor="b"), change(2, sensor="b"), change(2, sensor="b", op="d"))
    pipeline.drain({"a": a.stream(), "b": b.stream()}, root, SETTINGS)
    state = C.state_of(Q.read_history(spark, root)).collect()
    assert sorted((r.sensor_id, r.id) for r in state) == [("a", 1), ("a", 2), ("b", 1)]


def test_readings_before_the_cut_are_counted(spark, root, caplog):
    landing = feed_at(spark, root, "one")
    landing.add(*readings_at(0.5, 1.5, 4.5))
    with caplog.at_level("WARNING"):
        pipeline.drain(landing.stream(), root, SETTINGS)
    assert "cut" not in caplog.text
    landing.add(*readings_at(0.6, 3.9, 4.2, 5.5), change(45, op="d"))
    with caplog.at_level("WARNING"):
        pipeline.drain(landing.stream(), root, SETTINGS)
    assert "bronze took in 2 readings older than the windows' cut" in caplog.text
    assert [h for h, _ in hours(spark, root)] == [1, 2, 5]
    caplog.clear()
    landing.add(*readings_at(6.5))
    with caplog.at_level("WARNING"):
        pipeline.drain(landing.stream(), root, SETTINGS)
    assert "cut" not in caplog.text


def test_command_line_takes_several_feeds(spark, root):
    for name, sensor in (("north", "n"), ("south", "s")):
        feed_at(spark, root, name).add(*at(0.5, 2.5, sensor=sensor))
    command.main([
        "--root", f"{root}/out", "--drain", "--idle-after", "5",
        "--feed", f"north={root}/landing-north", "--feed", f"south={root}/landing-south",
    ])
    assert windows(spark, f"{root}/out") == [("n", 1), ("s", 1)]
    with pytest.raises(SystemExit):
        command.main(["--root", "/x", "--feed", "a=b", "--files", "/y"])


def test_a_drain_may_bring_some_outputs_only(spark, root):
    landing = feed_at(spark, root, "one")
    landing.add(*readings_at(0.5, 1.5, 4.5))
    pipeline.drain(landing.stream(), root, SETTINGS, outputs=["hourly"])
    assert hours(spark, root) == [(1, 410.5), (2, 411.5)]
    assert sinks.read_appended(spark, schemas.ALERTS, f"{root}/alerts").count() == 0
    landing.add(*readings_at(5.5, 6.5))
    pipeline.drain(landing.stream(), root, SETTINGS)
    assert hours(spark, root) == [(1, 410.5), (2, 411.5), (5, 414.5), (6, 415.5)]
    assert sinks.read_appended(spark, schemas.ALERTS, f"{root}/alerts").count() == 5
    assert sinks.read_appended(spark, schemas.MINUTE_AVERAGES, f"{root}/minute").count() == 4
    with pytest.raises(KeyError):
        pipeline.drain(landing.stream(), root, SETTINGS, outputs=["nothing"])
