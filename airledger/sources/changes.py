"""Change feeds. Every reader returns ``value`` (one JSON envelope) and the orderable ``seq``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

FEED_SCHEMA = "seq bigint, value string"

#: A file stream otherwise skips, without a word, files a week older than the newest it has seen.
ANY_AGE = {"maxFileAge": "36500d"}
RATE_LIMITS = {"maxoffsetspertrigger", "maxfilespertrigger", "maxbytespertrigger", "maxtriggerdelay"}


def _check_limits(options: dict[str, str], drain: bool) -> None:
    """Parts of a feed that are read a batch apart turn late for the windows. Only a drain, which
    completes bronze first, may read in limited batches."""
    limits = [o for o in options if o.lower() in RATE_LIMITS]
    if limits and not drain:
        raise ValueError(f"{', '.join(limits)} would lose window rows; use it with a drain only")


def _from_topic(frame: DataFrame) -> DataFrame:
    # Changes of one row share a message key and so a partition: offsets order them.
    return frame.select(
        F.struct("partition", "offset").alias("seq"), F.col("value").cast("string").alias("value")
    )


def _topic_options(servers: str, topic: str, extra: dict[str, str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **extra,
    }


def stream_topic(
    spark: SparkSession, servers: str, topic: str, *, drain: bool = False, **extra: str
) -> DataFrame:
    """Unbounded topic source, from the earliest offset unless a checkpoint says otherwise.

    Needs the spark-sql-kafka package on the classpath. ``minPartitions`` reads a busy partition
    with several tasks. With ``drain`` (for ``pipeline.drain``) ``maxOffsetsPerTrigger`` may bound
    the batches of a first start on a long topic.
    """
    _check_limits(extra, drain)
    reader = spark.readStream.format("kafka").options(**_topic_options(servers, topic, extra))
    return _from_topic(reader.load())


def read_topic(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """The topic as it stands, as a batch."""
    reader = spark.read.format("kafka").options(**_topic_options(servers, topic, extra))
    return _from_topic(reader.load())


def _with_file_order(lines: DataFrame) -> DataFrame:
    # Text has no sequence column; files are ordered by age, lines inside one file stay unordered.
    return lines.select(
        F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("seq"), "value"
    )


def _with_line_order(files: DataFrame) -> DataFrame:
    """Lines of whole files: ordered by age of the file and line, so changes of a row may share a file.

    A file is one record here, so it has to fit a task's memory; plain text has no such bound and no such order.
    """
    whole = files.where("value <> ''").select(
        F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file_path"),
        F.posexplode(F.split(F.regexp_replace("value", "(\\r\\n|\\r|\\n)$", ""), "\\r\\n|\\r|\\n")).alias("line", "value"),
    )
    return whole.select(F.struct("file_time", "file_path", "line").alias("seq"), "value")


def stream_files(
    spark: SparkSession, path: str, fmt: str = "parquet", *, drain: bool = False, **options: str
) -> DataFrame:
    """A directory that grows: Parquet with (seq, value), or text with one envelope per line (``ordered-text`` keeps
    the order of the lines, see ``_with_line_order``).

    Files count whatever their age. ``drain`` is as for the topic.
    """
    _check_limits(options, drain)
    reader = spark.readStream.options(**{**ANY_AGE, **options})
    if fmt == "text":
        return _with_file_order(reader.text(path))
    if fmt == "ordered-text":
        return _with_line_order(reader.text(path, wholetext=True))
    return reader.schema(FEED_SCHEMA).parquet(path)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    reader = spark.read.options(**options)
    if fmt == "text":
        return _with_file_order(reader.text(path))
    if fmt == "ordered-text":
        return _with_line_order(reader.text(path, wholetext=True))
    return reader.schema(FEED_SCHEMA).parquet(path)
