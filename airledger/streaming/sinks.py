"""Sinks: append to Parquet, keyed upsert, console, and a database over JDBC or DB-API."""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..config import StreamSettings
from ..operators import constraints
from ..schemas import Table
from . import files

BatchWriter = Callable[[DataFrame, int], None]


def start(
    writer: DataStreamWriter,
    name: str,
    checkpoint: str,
    settings: StreamSettings,
    trigger: dict | None = None,
) -> StreamingQuery:
    return (
        writer.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or settings.trigger))
        .start()
    )


def refuse_orphan(spark: SparkSession, output: str, checkpoint: str) -> None:
    """A new checkpoint over an old output would skip batch numbers the output already knows and
    lose their rows. ``pipeline.reset_output`` clears both for a rebuild."""
    if files.exists(spark, output) and not files.exists(spark, checkpoint):
        raise ValueError(f"{output} exists without its checkpoint; reset the output to rebuild it")


def append(
    rows: DataFrame, table: Table, path: str, checkpoint: str, settings: StreamSettings
) -> StreamingQuery:
    """Append result rows to a Parquet directory, exactly once.

    Rows that break a constraint of the table go to the ``is_valid=false`` partition with the
    reason, in the same pass.
    """
    refuse_orphan(rows.sparkSession, path, checkpoint)
    checked = constraints.check(rows, table).select(*table.names, "violations", "is_valid")
    if settings.files_per_batch:
        checked = checked.repartition(settings.files_per_batch)
    writer = checked.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer.partitionBy("is_valid"), table.name, checkpoint, settings)


def sink_schema(table: Table) -> str:
    columns = ", ".join(f"{c.name} {c.type}" for c in table.columns)
    return f"{columns}, violations string, is_valid boolean"


def write_backfill(rows: DataFrame, table: Table, path: str) -> None:
    """History computed in a batch, beside the directory the stream appends to (a streaming sink
    directory hides files its own log does not list)."""
    constraints.check(rows, table).write.mode("overwrite").partitionBy("is_valid").parquet(
        backfill_path(path)
    )


def backfill_path(path: str) -> str:
    return f"{path}_backfill"


def _appended(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """What the stream and a backfill wrote; nothing before either did."""
    reader = spark.read.schema(sink_schema(table))
    rows = reader.parquet(path) if files.exists(spark, path) else spark.createDataFrame([], sink_schema(table))
    if files.is_finished(spark, backfill_path(path)):
        rows = rows.unionByName(reader.parquet(backfill_path(path)))
    return rows


def read_appended(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """Accepted rows; the partition filter skips the rejected files."""
    return _appended(spark, table, path).where("is_valid").select(*table.names)


def read_rejected(spark: SparkSession, table: Table, path: str) -> DataFrame:
    return _appended(spark, table, path).where("not is_valid").drop("is_valid")


def console(rows: DataFrame, name: str, checkpoint: str, settings: StreamSettings) -> StreamingQuery:
    """Print rows as they come; for watching, not for keeping."""
    writer = rows.writeStream.outputMode("append").format("console").option("truncate", "false")
    return start(writer, name, checkpoint, settings)


def for_each_batch(
    rows: DataFrame,
    write: BatchWriter,
    name: str,
    checkpoint: str,
    settings: StreamSettings,
    mode: str = "append",
) -> StreamingQuery:
    return start(
        rows.writeStream.outputMode(mode).foreachBatch(write), name, checkpoint, settings
    )


def changed_rows(table: Table, path: str) -> BatchWriter:
    """Write the accepted rows each batch changed to a folder of its own, which a repeated batch writes again:
    the log of an upsert stream, for those who apply it elsewhere."""

    def write(rows: DataFrame, batch_id: int) -> None:
        accepted = constraints.check(rows, table).where("is_valid").drop("violations", "is_valid")
        accepted.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def jdbc_append(
    table: Table, url: str, rejected_path: str, connections: int = 8, **properties: str
) -> BatchWriter:
    """Insert accepted rows into a database table over at most ``connections`` connections. A
    repeated batch inserts them again (at least once), as the table has no key to recognise them by."""

    def write(rows: DataFrame, batch_id: int) -> None:
        kept = rows.persist()
        try:
            accepted, rejected = constraints.split(kept, table)
            rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
            accepted.write.mode("append").format("jdbc").options(
                **{"numPartitions": str(connections), **properties}, url=url, dbtable=table.name
            ).save()
        finally:
            kept.unpersist()

    return write


def upsert_statement(table: Table, newer: str, mark: str = "%s", rows: int = 1) -> str:
    """INSERT of several rows that updates existing keys unless the stored row is newer. The rows
    of one statement have to differ in their key."""
    names = table.names
    sets = ", ".join(f"{n} = EXCLUDED.{n}" for n in names if n != table.key)
    values = ", ".join([f"({', '.join([mark] * len(names))})"] * rows)
    return (
        f"INSERT INTO {table.name} ({', '.join(names)}) VALUES {values} "
        f"ON CONFLICT ({table.key}) DO UPDATE SET {sets} "
        f"WHERE EXCLUDED.{newer} >= {table.name}.{newer}"
    )


def postgres_connection(dsn: str):
    """Open a connection with psycopg2, which the executors need to have installed."""
    try:
        import psycopg2
    except ImportError as error:
        raise RuntimeError("writing to PostgreSQL needs psycopg2 on the executors") from error
    return psycopg2.connect(dsn)


def database_upsert(
    connect: Callable[[], object],
    table: Table,
    newer: str,
    rejected_path: str | None = None,
    connections: int = 8,
    chunk: int = 500,
    mark: str = "%s",
) -> BatchWriter:
    """Keyed upsert through a DB-API connection opened by each of ``connections`` tasks; safe to
    repeat. ``chunk`` rows go in one statement and one transaction. ``connect`` is called on the
    executors, so it has to be picklable. Refused rows go to ``rejected_path``.
    """
    names = table.names

    def write_partition(rows) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            source = iter(rows)
            while pending := list(islice(source, chunk)):
                statement = upsert_statement(table, newer, mark, len(pending))
                cursor.execute(statement, [row[n] for row in pending for n in names])
                connection.commit()
        finally:
            connection.close()

    def write(rows: DataFrame, batch_id: int) -> None:
        kept = rows.persist()
        try:
            accepted, rejected = constraints.split(kept, table)
            if rejected_path:
                rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
            accepted.repartition(connections).foreachPartition(write_partition)
        finally:
            kept.unpersist()

    return write
