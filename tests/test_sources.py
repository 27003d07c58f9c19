import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from airledger import schemas, session
from airledger.__main__ import database_writers, main
from airledger.operators import changes as C
from airledger.sources import changes as feeds, tables
from airledger.plans import views
from airledger.streaming import days, queries as Q, sinks
from airledger.config import DRAIN, Rules, StreamSettings
from airledger.functions import rules as R
from tests.conftest import change


def test_text_files_feed_batch_and_stream(spark, root):
    os.mkdir(f"{root}/in")
    with open(f"{root}/in/a.json", "w") as out:
        out.write("\n".join([change(1), "{broken", change(2, level=450.0)]))
    batch = C.readings(feeds.read_files(spark, f"{root}/in", "text"))
    assert sorted(r.id for r in batch.collect()) == [1, 2]
    settings = StreamSettings(trigger=DRAIN)
    stream = C.readings(feeds.stream_files(spark, f"{root}/in", "text"))
    Q.start_alerts(stream, root, settings).awaitTermination()
    assert sinks.read_appended(spark, schemas.ALERTS, f"{root}/alerts").count() == 2


def test_topic_rows_keep_partition_and_offset_as_order(spark):
    frame = spark.createDataFrame(
        [(bytearray(change(7).encode()), 3, 42)], "value binary, partition int, offset bigint"
    )
    feed = feeds._from_topic(frame)
    row = C.readings(feed).first()
    assert (row.id, tuple(row.seq)) == (7, (3, 42))


def test_topic_options_start_at_the_earliest_offset():
    options = feeds._topic_options("broker:9092", "readings", {"maxOffsetsPerTrigger": "10"})
    assert options["startingOffsets"] == "earliest"
    assert options["subscribe"] == "readings" and options["maxOffsetsPerTrigger"] == "10"


def test_topic_source_names_the_missing_package(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        feeds.stream_topic(spark, "broker:9092", "readings")


def test_base_table_scan_reads_only_its_columns(spark, root):
    spark.sql(
        "SELECT 1L AS id, 's' AS sensor_id, 400D AS co2_level, "
        "timestamp_ntz'2024-01-01' AS measurement_time, 'p' AS location, 'x' AS other"
    ).write.parquet(f"{root}/m")
    frame = tables.read_parquet(spark, f"{root}/m", schemas.MEASUREMENTS)
    assert frame.columns == schemas.MEASUREMENTS.names
    plan = frame.select("location")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<location:string>" in plan


def test_upsert_statement_guards_against_older_rows():
    text = sinks.upsert_statement(schemas.CURRENT_STATUS, "last_updated")
    assert text == (
        "INSERT INTO current_co2_status (sensor_id, co2_level, status, last_updated, location) "
        "VALUES (%s, %s, %s, %s, %s) ON CONFLICT (sensor_id) DO UPDATE SET "
        "co2_level = EXCLUDED.co2_level, status = EXCLUDED.status, "
        "last_updated = EXCLUDED.last_updated, location = EXCLUDED.location "
        "WHERE EXCLUDED.last_updated >= current_co2_status.last_updated"
    )


class Recorder:
    """Stands in for a DB-API connection; each task appends what it executed to its own file."""

    def __init__(self, folder):
        self.path = f"{folder}/{os.getpid()}-{id(self)}.jsonl"
        self.pending, self.statements = [], []

    def cursor(self):
        return self

    def execute(self, statement, values):
        width = len(schemas.CURRENT_STATUS.names)
        assert statement.count("%s") == len(values)
        self.pending += [[str(v) for v in values[i : i + width]] for i in range(0, len(values), width)]
        self.statements.append(statement)

    def commit(self):
        with open(self.path, "a") as out:
            out.writelines(json.dumps(row) + "\n" for row in self.pending)
        assert len(self.statements) == 1  # one statement and one transaction per chunk
        self.pending, self.statements = [], []

    def close(self):
        pass


def test_database_upsert_sends_accepted_rows_from_the_tasks(spark, root):
    frame = spark.sql(
        "SELECT concat('s', id) AS sensor_id, if(id = 3, NULL, 400D) AS co2_level, 'NORMAL' AS status, "
        "timestamp_ntz'2024-01-01' AS last_updated, 'p' AS location, id AS seq FROM range(0, 25, 1, 4)"
    )
    sent_to = f"{root}/sent"
    os.mkdir(sent_to)
    write = sinks.database_upsert(
        lambda: Recorder(sent_to), schemas.CURRENT_STATUS, "last_updated", f"{root}/rejected",
        connections=3, chunk=4,
    )
    write(frame, 0)
    sent = [json.loads(line) for name in os.listdir(sent_to) for line in open(f"{sent_to}/{name}")]
    refused = spark.read.parquet(f"{root}/rejected/batch=0").collect()
    assert [(r.sensor_id, r.violations) for r in refused] == [("s3", "co2_level is null")]
    assert sorted(row[0] for row in sent) == sorted(f"s{i}" for i in range(25) if i != 3)
    assert all(len(row) == 5 for row in sent)


def test_work_root_follows_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.work_root(spark), session.work_root(spark)
    assert first.startswith(f"{base}/run-") and first != second


def test_command_line_drains_files(spark, root):
    os.mkdir(f"{root}/in")
    with open(f"{root}/in/a.json", "w") as out:
        out.write("\n".join([change(1, level=15.0), change(2, level=5.0)]))
    main(["--root", f"{root}/out", "--files", f"{root}/in", "--format", "text", "--drain",
          "--warning", "10", "--critical", "20"])
    assert [r.co2_level for r in sinks.read_appended(
        spark, schemas.ALERTS, f"{root}/out/alerts").collect()] == [15.0]


def test_database_writers_cover_the_result_tables():
    writers = database_writers("/r", "jdbc:postgresql://h/d", "dbname=d", {"user": "u"})
    assert set(writers) == {
        "co2_aggregated", "co2_hourly_aggregates", "co2_alerts", "current_co2_status"
    }
    assert "current_co2_status" not in database_writers("/r", "jdbc:postgresql://h/d", None, {})


def test_command_line_wants_one_source_and_one_database():
    for wrong in ([], ["--files", "x", "--dsn", "dbname=d"], ["--files", "x", "--jdbc-url", "jdbc:x"]):
        with pytest.raises(SystemExit):
            main(["--root", "x", *wrong])


def test_command_line_refreshes_the_alert_summary(spark, root):
    os.mkdir(f"{root}/in")
    with open(f"{root}/in/a.json", "w") as out:
        out.write("\n".join([change(1, level=430.0), change(2, level=431.0, seconds=4000)]))
    main(["--root", f"{root}/out", "--files", f"{root}/in", "--format", "text", "--drain"])
    main(["--root", f"{root}/out", "--refresh-alert-summary"])
    got = days.read_alert_summary(spark, f"{root}/out").collect()
    assert sorted((r.alert_hour.hour, r.alert_count) for r in got) == [(0, 1), (1, 1)]


def test_command_line_refreshes_the_trends(spark, root):
    spark.createDataFrame(
        [(1, change(1, level=430.0)), (2, change(2, level=410.0)), (3, change(2, level=390.0, op="u"))], feeds.FEED_SCHEMA
    ).write.parquet(f"{root}/in")
    main(["--root", f"{root}/out", "--files", f"{root}/in", "--drain"])
    main(["--root", f"{root}/out", "--refresh-trends", "--refresh-alert-summary"])
    views.register_stored_views(spark, f"{root}/out")
    assert [tuple(r) for r in spark.table("daily_patterns").collect()] == [(0, "Downtown", 410.0)]
    assert [r.alerts_count for r in spark.table("daily_summary").collect()] == [1]


def test_several_rows_go_in_one_statement():
    text = sinks.upsert_statement(schemas.CURRENT_STATUS, "last_updated", rows=3)
    assert text.count("(%s, %s, %s, %s, %s)") == 3 and text.count("ON CONFLICT") == 1


def test_table_state_wants_an_order(spark, root):
    os.mkdir(f"{root}/in")
    with open(f"{root}/in/a.json", "w") as out:
        out.write("\n".join([change(1, level=430.0), change(1, level=401.0, op="u")]))
    with pytest.raises(ValueError, match="seq"):
        C.table_state(feeds.read_files(spark, f"{root}/in", "text"))
    with pytest.raises(ValueError, match="seq"):
        C.table_state(spark.createDataFrame([(change(1),)], "value string"))


def test_ordered_text_gives_changes_of_one_file_an_order(spark, root):
    os.mkdir(f"{root}/in")
    with open(f"{root}/in/a.json", "w") as out:
        out.write("\r\n".join([change(1, level=430.0), change(2), "", change(1, level=401.0, op="u"), change(2, op="d")]) + "\r\n")
    open(f"{root}/in/empty.json", "w").close()
    batch = feeds.read_files(spark, f"{root}/in", "ordered-text")
    assert [r.seq.line for r in batch.orderBy("seq").collect()] == [0, 1, 2, 3, 4]
    assert [(r.id, r.co2_level) for r in C.table_state(batch).collect()] == [(1, 401.0)]
    with open(f"{root}/in/b.json", "w") as out:
        out.write(change(1, level=402.0, op="u"))
    os.utime(f"{root}/in/b.json", (4_000_000_000, 4_000_000_000))
    main(["--root", f"{root}/out", "--files", f"{root}/in", "--format", "ordered-text", "--drain"])
    seq = Q.stored_seq_type(spark, f"{root}/out")
    state = C.state_of(Q.read_history(spark, f"{root}/out", seq)).collect()
    assert [(r.id, r.co2_level) for r in state] == [(1, 402.0)]
    main(["--root", f"{root}/out", "--refresh-trends"])
    assert [r.total for r in days.TREND_PARTIALS.read(spark, f"{root}/out").collect()] == [402.0]


def test_rules_as_sql_functions(spark):
    try:
        assert views.register_functions(spark, Rules(warning=10.0, critical=20.0))
        got = spark.sql("SELECT co2_status(x), co2_feed_label(x), is_co2_alert(x), co2_alert_message(x) FROM VALUES (10D), (20D), (20.5D), (NULL) AS t(x)")
        want = spark.createDataFrame([(10.0,), (20.0,), (20.5,), (None,)], "x double").select(
            *[f(F.col("x"), Rules(10.0, 20.0)) for f in (R.status, R.feed_label, R.is_alert, R.alert_message)])
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    finally:
        views.register_functions(spark)
