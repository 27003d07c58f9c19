"""Base-table scans: Parquet, or a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import Table


def read_parquet(spark: SparkSession, path: str, table: Table) -> DataFrame:
    return spark.read.parquet(path).select(*table.names)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: Table,
    *,
    split_on: str = "id",
    lower: int,
    upper: int,
    partitions: int,
    **properties: str,
) -> DataFrame:
    """Parallel scan: ``partitions`` range queries on ``split_on``. The bounds only shape the
    ranges; rows outside them are still read."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table.name,
        partitionColumn=split_on,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
        **properties,
    )
    return reader.load().select(*table.names)
