"""NOT NULL and length limits of the result tables, checked before rows are written.

A broken row is kept with the reason instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import Table


def violations(table: Table) -> Column:
    """All broken constraints of a row, joined by '; ', or NULL for a good row."""
    found = []
    for column in table.columns:
        value = F.col(column.name)
        if column.required:
            found.append(F.when(value.isNull(), F.lit(f"{column.name} is null")))
        if column.max_chars is not None:
            too_long = F.char_length(value) > column.max_chars
            found.append(F.when(too_long, F.lit(f"{column.name} over {column.max_chars} chars")))
    joined = F.concat_ws("; ", *found)
    return F.when(joined != "", joined)


def check(rows: DataFrame, table: Table) -> DataFrame:
    """Rows plus ``violations`` and ``is_valid``."""
    return rows.withColumn("violations", violations(table)).withColumn(
        "is_valid", F.col("violations").isNull()
    )


def split(rows: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """(accepted rows in table column order, rejected rows with ``violations``)."""
    checked = check(rows, table)
    accepted = checked.where("is_valid").select(*table.names)
    rejected = checked.where("not is_valid").drop("is_valid")
    return accepted, rejected
