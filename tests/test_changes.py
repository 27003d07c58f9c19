import datetime as dt
import json
import random

import pytest

from airledger.operators import changes as C
from tests.conftest import change, micros, rows

AT = dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
EXACT = 0.123456


def envelope(**after):
    base = {
        "id": 1, "sensor_id": "sensor_1", "co2_level": 412.5,
        "measurement_time": micros(EXACT), "location": "Downtown",
    }
    return json.dumps({"payload": {"after": {**base, **after}, "op": "c"}})


def without(name):
    doc = json.loads(envelope())
    del doc["payload"]["after"][name]
    return json.dumps(doc)


LOST = (None, None, None, None)
CORPUS = [
    ("ok", envelope(), (1, "sensor_1", 412.5, "Downtown")),
    ("delete", json.dumps({"payload": {"after": None, "op": "d"}}), LOST),
    ("not json", "{not json", LOST),
    ("tombstone", None, LOST),
    ("missing location", without("location"), (1, "sensor_1", 412.5, None)),
    ("quoted numbers", envelope(id="7", co2_level="413.5"), (7, "sensor_1", 413.5, "Downtown")),
    ("text level", envelope(co2_level="abc"), (1, "sensor_1", None, "Downtown")),
    ("numeric sensor", envelope(sensor_id=99), (1, "99", 412.5, "Downtown")),
    ("no payload", json.dumps({"after": {"id": 1}, "op": "c"}), LOST),
    ("empty", "", LOST),
    ("object as id", envelope(id={"z": 1}), (None, "sensor_1", 412.5, "Downtown")),
    ("truncated", envelope()[:-1], LOST),
    ("null payload", '{"payload": null}', LOST),
    ("id out of range", envelope(id=10**20), (None, "sensor_1", 412.5, "Downtown")),
    ("whole level", envelope(co2_level=412), (1, "sensor_1", 412.0, "Downtown")),
    ("empty level", envelope(co2_level=""), (1, "sensor_1", None, "Downtown")),
    ("boolean sensor", envelope(sensor_id=True), (1, "true", 412.5, "Downtown")),
    ("extra keys", envelope(unit="ppm"), (1, "sensor_1", 412.5, "Downtown")),
    ("after is a number", '{"payload": {"after": 5, "op": "c"}}', LOST),
    ("array", f"[{envelope()}]", LOST),
    ("text after the document", envelope() + " x", (1, "sensor_1", 412.5, "Downtown")),
    ("two bad leaves", envelope(id="9", co2_level=[1], location=None), (9, "sensor_1", None, None)),
    ("padded number", envelope(id=" 8 "), (8, "sensor_1", 412.5, "Downtown")),
]


def test_damaged_records(spark, feed):
    decoded = C.decode(feed([value for _, value, _ in CORPUS])).orderBy("seq").collect()
    for (name, _, expected), row in zip(CORPUS, decoded, strict=True):
        assert (row.id, row.sensor_id, row.co2_level, row.location) == expected, name


def test_damaged_records_without_partial_results(spark, feed):
    key = "spark.sql.json.enablePartialResults"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        test_damaged_records(spark, feed)
    finally:
        spark.conf.set(key, before)


def test_damaged_history(spark, feed):
    broken = json.dumps({"payload": {"before": {"id": "5"}, "after": None, "op": "d", "ts_ms": "12"}})
    row = C.decode(feed([broken]), history=True).first()
    assert (row.before_id, row.ts_ms, row.op, row.id) == (5, 12, "d", None)


def test_readings_keep_only_identified_rows(spark, feed):
    kept = C.readings(feed([value for _, value, _ in CORPUS]))
    expected = [name for name, _, (id_, *_) in CORPUS if id_ is not None]
    assert [CORPUS[r.seq][0] for r in kept.orderBy("seq").collect()] == expected
    assert kept.columns == [
        "seq", "id", "sensor_id", "co2_level", "measurement_time", "location", "op"
    ]
    assert kept.first().measurement_time == AT


def test_update_is_one_more_reading(feed):
    kept = C.readings(feed([change(1), change(1, level=430.0, op="u"), change(1, op="d")]))
    assert [(r.id, r.op) for r in kept.collect()] == [(1, "c"), (1, "u")]


def test_snapshot_and_changes_share_the_feed(feed):
    profile = C.profile_by_op(feed([change(op="r"), change(2), change(3), change(2, op="d"), "x"]))
    assert rows(profile) == [("c", 2), ("d", 1), ("r", 1), (None, 1)]


def test_state_follows_update_delete_and_reinsert(feed):
    state = C.table_state(
        feed(
            [
                change(1, level=401.0, seconds=1, op="r"),
                change(2, seconds=2),
                change(3, seconds=3),
                change(1, level=402.0, seconds=4, op="u"),
                change(2, seconds=5, op="d"),
                None,
                change(3, seconds=6, op="d"),
                change(3, level=403.0, seconds=7),
                change(9, seconds=8, op="d"),
            ]
        )
    )
    assert [(r.id, r.co2_level) for r in state.orderBy("id").collect()] == [(1, 402.0), (3, 403.0)]


def test_state_keeps_micros(feed):
    state = C.table_state(feed([change(1, seconds=EXACT)]))
    assert state.first().measurement_time == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_same_millisecond_is_decided_by_arrival(feed):
    state = C.table_state(
        feed([change(1, level=1.0, ts_ms=5), change(1, op="d", ts_ms=5), change(1, level=3.0, ts_ms=5)])
    )
    assert [r.co2_level for r in state.collect()] == [3.0]


@pytest.mark.parametrize("seed", range(3))
def test_state_equals_replay_with_one_hot_id(feed, seed):
    rng = random.Random(seed)
    log, live = [], {}
    for step in range(600):
        id_ = 1 if rng.random() < 0.35 else rng.randrange(2, 60)
        level = round(rng.uniform(380, 440), 2)
        if id_ in live and rng.random() < 0.3:
            log.append(change(id_, op="d", seconds=step))
            del live[id_]
        else:
            log.append(change(id_, level=level, op="u" if id_ in live else "c", seconds=step))
            live[id_] = level
    state = C.table_state(feed(log).repartition(5))
    assert {r.id: r.co2_level for r in state.collect()} == live


def test_arrival_decides_where_the_clock_steps_back(feed):
    log = feed([
        change(1, level=430.0, ts_ms=2000), change(1, level=401.0, op="u", ts_ms=1000),
        change(2, level=430.0, ts_ms=2000), change(2, op="d", ts_ms=1000),
    ])
    assert [(r.id, r.co2_level) for r in C.table_state(log).collect()] == [(1, 401.0)]


def test_whole_numbers_in_other_forms(feed):
    def doc(id_, at):
        return (
            '{"payload": {"op": "c", "after": {"id": %s, "sensor_id": "s", "co2_level": 400, '
            '"measurement_time": %s, "location": "p"}}}' % (id_, at)
        )

    log = feed([
        doc("7.0", "1704067200123456.0"), doc("8", "1.704067200123456E15"), doc("7.5", "1704067200123456"),
        doc('"9"', '"1.704067200123456e15"'), doc("1e2", "1704067200123456.25"), doc("1e400", "1"),
    ])
    got = {(r.seq, r.id, r.measurement_time) for r in C.decode(log).collect()}
    at = 1_704_067_200_123_456
    assert got == {(0, 7, at), (1, 8, at), (2, None, at), (3, 9, at), (4, 100, None), (5, None, 1)}
