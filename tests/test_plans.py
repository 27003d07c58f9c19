"""The physical plans are the ones meant: one scan, one parse, pruned columns, no Python rows."""

import re

import pytest

from airledger import schemas
from airledger.config import DRAIN, StreamSettings
from airledger.operators import alerts as A, changes as C, latest as L, trends as V, windows as W
from airledger.plans import queries as named
from airledger.sources import changes as feeds, sensor_feed
from airledger.streaming import queries as Q, sinks
from tests.conftest import DATA

SMALL = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("changes"))
    events = sensor_feed.read_events(spark, SMALL)
    sensor_feed.changes(events, dense=False).write.mode("overwrite").parquet(path)
    return feeds.read_files(spark, path)


def plan(frame, run=False):
    if run:
        frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize(
    "build",
    [
        lambda c: A.alerts(C.readings(c)),
        lambda c: W.hourly_aggregates(C.readings(c)),
        lambda c: L.current_status(C.readings(c)),
        lambda c: C.table_state(c),
    ],
)
def test_each_document_is_parsed_once(stored, build):
    text = plan(build(stored))
    parsed = [line for line in text.splitlines() if "from_json" in line]
    assert text.count("from_json") == 2 and text.count("FileScan") == 1
    again, first = parsed  # only the documents set aside are read again, as text
    assert re.search(r"Generate inline\(array\(from_json\(.* value#", first)
    assert re.search(r"CASE WHEN isnotnull\(_corrupt_record#\d+\) THEN from_json", again)


def test_windows_read_one_column_and_shuffle_once(stored):
    text = plan(W.hourly_aggregates(C.readings(stored)))
    assert "ReadSchema: struct<value:string>" in text
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_alerts_do_not_shuffle(stored):
    assert "Exchange" not in plan(A.alerts(C.readings(stored)))


def test_latest_reduces_before_the_shuffle(stored):
    text = plan(L.current_status(C.readings(stored)))
    assert text.index("SortAggregate") < text.index("Exchange") < text.rindex("partial_max")
    ranked = plan(L.current_status_ranked(C.readings(stored)))
    assert len(re.findall(r"WindowGroupLimit .*(Partial|Final)", ranked)) == 2


def test_rolling_average_scans_and_aggregates_once(stored):
    text = plan(V.sensor_stats_24h(W.hourly_aggregates(C.readings(stored))), run=True)
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_thresholds_and_columns_reach_the_bronze_scan(spark, root):
    events = sensor_feed.read_events(spark, SMALL)
    schema = Q.bronze_schema("bigint")
    spark.createDataFrame([], schema).write.partitionBy("event_date").parquet(f"{root}/bronze")
    C.readings(sensor_feed.changes(events)).selectExpr(
        "*", "CAST(NULL AS STRING) AS violations", "to_date(measurement_time) AS event_date"
    ).write.mode("append").partitionBy("event_date").parquet(f"{root}/bronze")
    text = plan(A.alerts(Q.read_bronze(spark, root)))
    assert "GreaterThan(co2_level,400.0)" in text
    assert "ReadSchema: struct<id:bigint,sensor_id:string,co2_level:double,measurement_time:timestamp,location:string>" in text


@pytest.mark.parametrize("name", sorted(named.BATCH) + ["views_over_stored_tables", "quarantine_by_kind"])
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan({**named.BATCH, **named.STREAMS}[name](spark, SMALL))
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", text)


def test_streams_reduce_before_the_shuffle(spark, root, stored, capsys):
    path = stored.inputFiles()[0].rsplit("/", 1)[0]
    settings = StreamSettings(trigger=DRAIN)
    log = sinks.changed_rows(schemas.CURRENT_STATUS, f"{root}/log")
    upserts = lambda readings, *rest: Q.start_status_upserts(readings, *rest, log)
    for start, partial in ((Q.start_hourly, "partial_avg"), (upserts, "partial_max")):
        query = start(C.readings(feeds.stream_files(spark, path)), root, settings)
        query.awaitTermination()
        query.explain()
        text = capsys.readouterr().out
        assert text.count("Exchange") == 1 and "StateStoreSave" in text
        assert text.index("Exchange") < text.rindex(partial)  # the partial step feeds the exchange
