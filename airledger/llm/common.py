"""Helpers the operators share: table access, stored intermediate results, character tables."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


ROW_GROUP_BYTES = 16 << 20


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back: a cut that outlives executors.

    Row groups are small: a writer holds one in memory.
    """
    spark = frame.sparkSession
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    frame.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application.

    Workers can then import it however the driver found it; with ``--py-files`` it is there already.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(PACKAGE)
    name = os.path.join(tempfile.mkdtemp(prefix="airledger-source-"), "airledger-source.zip")
    with zipfile.ZipFile(name, "w") as out:
        for folder, _, files in os.walk(PACKAGE):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def mapped(frame: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the workers."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def where_text(docs: DataFrame, text_col: str, keep: Callable[[pa.Array], np.ndarray], max_bytes: int) -> DataFrame:
    """The rows whose text ``keep`` accepts, columns unchanged. Only texts go to Python and only booleans come back;
    the rows stay with Spark. ``keep`` gets texts of about ``max_bytes`` at a time, null ones as empty."""
    ship_package(docs.sparkSession)

    def kept(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            parts = [keep(part.column(0)) for part in slices([batch], max_bytes, 0)]
            yield pa.array(np.concatenate([np.empty(0, bool), *parts]), pa.bool_())

    kept.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.where(F.arrow_udf(kept, "boolean")(text_of(text_col)))


def slices(batches: Iterable[pa.RecordBatch], max_bytes: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one piece holds about ``max_bytes`` of text, or a single row."""
    for batch in batches:
        sizes = binary_lengths(batch.column(column))
        start = held = 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > max_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def binary_lengths(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for everything else."""
    table_ = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table_[point] = ord(low) if len(low) == 1 else point
    return table_


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def held_out(column: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls into the fold that no model learns from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold, F.lit(False))


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Code point -> the same with letters lowered and every kind of white space as a blank."""
    table_ = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    low = letters()
    table_[low != 0] = low[low != 0]
    for point in range(0x3001):
        if chr(point).isspace():
            table_[point] = 0x20
    return table_
