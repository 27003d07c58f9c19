"""Windows, latest status, alerts, trends and constraints on hand-made and random input."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airledger import schemas
from airledger.operators import alerts as A, changes as C, constraints, latest as L, trends as V, windows as W
from tests.conftest import change, rows

DAY = dt.datetime(2024, 1, 1)


def at(hours=0, minutes=0):
    return DAY + dt.timedelta(hours=hours, minutes=minutes)


def test_minute_and_hour_windows(feed):
    readings = C.readings(
        feed([change(1, level=400.0, seconds=0), change(2, level=410.0, seconds=59.999),
              change(3, level=430.0, seconds=60)])
    )
    assert rows(W.minute_averages(readings)) == [
        ("sensor_1", "Downtown", at(minutes=1), 405.0),
        ("sensor_1", "Downtown", at(minutes=2), 430.0),
    ]
    hourly = W.hourly_aggregates(readings)
    assert rows(hourly) == [("sensor_1", "Downtown", at(1), 1240 / 3, 400.0, 430.0)]
    assert dict(hourly.dtypes)["window_end"] == "timestamp_ntz"


def test_null_place_and_null_level_in_windows(feed):
    readings = C.readings(
        feed([change(1, place=None, level=400.0), change(2, place=None, level=402.0),
              change(3, place="Park", level=None)])
    )
    assert rows(W.minute_averages(readings)) == [
        ("sensor_1", "Park", at(minutes=1), None), ("sensor_1", None, at(minutes=1), 401.0)
    ]


def test_latest_and_ranked_agree_on_ties(feed):
    readings = C.readings(
        feed([change(5, seconds=10, level=401.0), change(4, seconds=10, level=421.0),
              change(6, seconds=3, level=399.0), change(7, sensor="sensor_2", level=None),
              change(8, sensor="sensor_3", level=412.5), change(9, sensor="sensor_3", seconds=9, level=None)])
    )
    expected = [("sensor_1", 421.0, "CRITICAL", at() + dt.timedelta(seconds=10), "Downtown"),
                ("sensor_3", 412.5, "WARNING", at(), "Downtown")]  # the valid one, as in the stream
    assert rows(L.current_status(readings)) == expected
    assert rows(L.current_status_ranked(readings)) == expected
    without_seq = readings.drop("seq")
    assert rows(L.current_status(without_seq))[0][1] == 401.0  # then the higher id decides


def test_alerts_and_feed(feed):
    readings = C.readings(
        feed([change(1, level=400.0), change(2, level=400.01), change(3, level=420.01),
              change(4, level=None), change(5, level=430.0, op="x")])
    )
    assert [(r.co2_level, r.message) for r in A.alerts(readings).orderBy("co2_level").collect()] == [
        (400.01, "Elevated CO2 Level Detected"),
        (420.01, "High CO2 Level Detected"),
        (430.0, "High CO2 Level Detected"),
    ]
    assert sorted(r.status for r in A.status_feed(readings).collect()) == [
        "High Warning", "Normal", "Normal", "Warning"
    ]


def hourly_frame(spark, data):
    return spark.createDataFrame(
        data, "sensor_id string, location string, window_end timestamp_ntz, avg_co2 double"
    )


def test_rolling_range_includes_both_ends(spark):
    hourly = hourly_frame(
        spark,
        [("s", "a", at(1), 400.0), ("s", "a", at(25), 410.0), ("s", "b", at(25), 420.0),
         ("s", "a", at(50), 500.0), (None, "a", at(1), 1.0)],
    )
    got = {(r.sensor_id, r.location, r.time_bucket): r.rolling_24h_avg
           for r in V.sensor_stats_24h(hourly).collect()}
    assert got == {
        ("s", "a", at(1)): 400.0,
        ("s", "a", at(25)): 410.0,
        ("s", "b", at(25)): 410.0,
        ("s", "a", at(50)): 500.0,
        (None, "a", at(1)): 1.0,
    }


def test_rolling_ignores_missing_averages(spark):
    hourly = hourly_frame(spark, [("s", "a", at(1), None), ("s", "b", at(2), 410.0)])
    assert sorted(rows(V.sensor_stats_24h(hourly)), key=str) == [
        ("s", "a", at(1), None, None), ("s", "b", at(2), 410.0, 410.0)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_rolling_equals_brute_force_with_a_hot_sensor(spark, seed):
    """One sensor owns a third of the rows and many places per hour; times before 1970 too."""
    rng = random.Random(seed)
    start = DAY if seed else dt.datetime(1969, 12, 30)
    data = set()
    while len(data) < 600:
        hot = rng.random() < 0.35
        sensor = "hot" if hot else f"s{rng.randrange(8)}"
        place = f"p{rng.randrange(30 if hot else 2)}"
        data.add((sensor, place, start + dt.timedelta(hours=rng.randrange(100))))
    data = [(*key, round(rng.uniform(380, 450), 3)) for key in sorted(data)]
    by_sensor = defaultdict(list)
    for sensor, _, end, level in data:
        by_sensor[sensor].append((end, level))
    expected = {}
    for sensor, place, end, _ in data:
        inside = [v for t, v in by_sensor[sensor] if end - dt.timedelta(hours=24) <= t <= end]
        expected[sensor, place, end] = sum(inside) / len(inside)
    got = V.sensor_stats_24h(hourly_frame(spark, data).repartition(6)).collect()
    assert len(got) == len(expected)
    for r in got:
        assert r.rolling_24h_avg == pytest.approx(
            expected[r.sensor_id, r.location, r.time_bucket], abs=1e-9
        )


def test_latest_with_a_hot_sensor_equals_brute_force(feed):
    rng = random.Random(7)
    log, best = [], {}
    for seq in range(900):
        sensor = "hot" if rng.random() < 0.35 else f"s{rng.randrange(200)}"
        second = rng.randrange(50)
        log.append(change(seq, sensor=sensor, seconds=second, level=float(seq)))
        best[sensor] = max(best.get(sensor, (-1, -1)), (second, seq))
    status = L.current_status(C.readings(feed(log).repartition(6)))
    assert {r.sensor_id: r.co2_level for r in status.collect()} == {
        s: float(seq) for s, (_, seq) in best.items()
    }


def test_trends_over_the_base_table(spark):
    base = spark.createDataFrame(
        [(1, "s", 400.0, at(9, 59), "a"), (2, "s", 402.0, at(9), "a"), (3, "s", 500.0, at(33), "a"),
         (4, "s", 390.0, at(9), None)],
        "id bigint, sensor_id string, co2_level double, measurement_time timestamp_ntz, location string",
    )
    assert rows(V.daily_patterns(base)) == [(9, "a", 434.0), (9, None, 390.0)]
    day = DAY.date()
    assert rows(V.daily_summary(base)) == [
        (day, "a", 401.0, 402.0, 1),
        (day, None, 390.0, 390.0, 0),
        (day + dt.timedelta(days=1), "a", 500.0, 500.0, 1),
    ]


def test_alert_summary_counts_by_hour_and_place(feed):
    found = A.alerts(C.readings(feed([change(1, seconds=0), change(2, seconds=3599.999),
                                      change(3, seconds=3600), change(4, place=None)])))
    assert rows(V.alert_summary_hourly(found)) == [
        (at(0), "Downtown", 2), (at(0), None, 1), (at(1), "Downtown", 1)
    ]


def test_constraints_name_every_broken_rule(spark):
    frame = spark.createDataFrame(
        [("s" * 50, "p" * 100, at(), 400.0), ("s" * 51, "p", at(), None), (None, "p" * 101, None, 1.0),
         ("é" * 50, None, at(), 1.0)],
        "sensor_id string, location string, window_end timestamp_ntz, avg_co2 double",
    )
    accepted, rejected = constraints.split(frame, schemas.MINUTE_AVERAGES)
    assert accepted.columns == schemas.MINUTE_AVERAGES.names
    assert accepted.count() == 2
    assert sorted(r.violations for r in rejected.collect()) == [
        "sensor_id is null; location over 100 chars; window_end is null",
        "sensor_id over 50 chars; avg_co2 is null",
    ]


def test_nan_counts_as_above_every_threshold(spark):
    frame = spark.range(1).select(F.lit(float("nan")).alias("co2_level"), F.lit("s").alias("sensor_id"),
                                  F.lit("p").alias("location"),
                                  F.lit(DAY).cast("timestamp").alias("measurement_time"))
    assert A.alerts(frame).first().message == "High CO2 Level Detected"
