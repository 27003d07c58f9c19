"""Training-order materialisation: token shards in the order of a keyed Feistel permutation.

A sequence is the tokens of one document and an end mark. Documents are numbered 0 to N - 1 by place in the
table's files; a balanced Feistel network over the next power of four, walked on while it leaves the range,
permutes the numbers to global slots. Shard s holds the slots from s * ``shard_rows`` on. A task takes a range
of slots, one shard or some in a row (never more than ``MOST_TASKS`` tasks), tokenises its documents in order of slot
and writes them end to end as rows of ``stride`` ids, so any row is at a fixed offset and reading can go on from a
(shard, row) pair. The last row of a shard is filled with end marks.

Files are written under another name and renamed when whole; a repeated task writes the same bytes again.
The order is fixed by the key and N alone. The text is shuffled once, the tokens never.

Defined cases: a null or empty text is a sequence of its end mark only; null ids and repeated rows are
sequences like others; an empty table writes no shard; other columns are not read. The numbering needs a
table whose files do not change between the two passes; a mismatch raises.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from .common import mapped, ship_package, stored, text_of

VOCABULARY = "byte_bpe_50k.tiktoken"
END = 50_256  # the id this file leaves free
KEY = 20_240_501
ROUNDS = 6
STRIDE = 2048
SHARD_ROWS = 8192
KIND = np.dtype("<u2")
MOST_TASKS = 20_000
ROW_BITS = 33  # monotonically_increasing_id keeps the row below the partition number


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def slots(numbers: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """The permuted place of each number below ``total``."""
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _mixed(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = numbers.astype(np.uint64)
    walking = np.arange(out.size)
    while walking.size:
        left, right = out[walking] >> half, out[walking] & mask
        for round_key in keys:
            left, right = right, left ^ (_mixed(right + round_key) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


@lru_cache(maxsize=1)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


#: A run of blanks so long that the library's splitter would overflow its stack on it.
LONG_RUN = 10_000
_BLANKS = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN
)


def token_ids(encoder, text: str) -> list[int]:
    """The ids of a text, whatever it holds.

    Of a run of blanks all but the last make one piece, or all at the end of a text; so a long run is cut
    out there and encoded as the piece it is, and the splitter sees the text around it.
    """
    out, at = [], 0
    for run in _BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += encoder.encode_ordinary(text[at : run.start()])
        out += encoder._encode_single_piece(text[run.start() : end].encode())
        at = end
    return out + encoder.encode_ordinary(text[at:]) if at else encoder.encode_ordinary(text)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


class _Shard:
    """Writes one shard; nothing is visible under its name before it is whole."""

    def __init__(self, root: str, shard: int, stride: int):
        self.files, base = pafs.FileSystem.from_uri(root)
        self.final = f"{base}/{shard_name(shard)}"
        self.draft = f"{base}/.{shard_name(shard)}-{uuid.uuid4().hex}"
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(self.draft)
        self.stride, self.tokens = stride, 0

    def add(self, ids: np.ndarray) -> int:
        first = self.tokens
        self.out.write(ids.tobytes())
        self.tokens += ids.size
        return first

    def close(self) -> None:
        self.add(np.full(-self.tokens % self.stride, END, dtype=KIND))
        self.out.close()
        self.files.move(self.draft, self.final)


def materialise(
    docs: DataFrame, root: str, *, id_col: str = "doc_id", text_col: str = "text", key: int = KEY,
    stride: int = STRIDE, shard_rows: int = SHARD_ROWS, path: str | None = None,
) -> DataFrame:
    """Write the shards below ``root`` (a URI or path all executors reach) and return their index.

    Index: (id, slot, shard, first_token, n_tokens, tokens_crc32); first_token counts from the shard's start
    and n_tokens leaves out the end mark. The index is stored beside the shards.
    """
    spark = docs.sparkSession
    ship_package(spark)
    file = path or public_tokenizers.path(VOCABULARY)
    counts = (
        docs.select(F.spark_partition_id().alias("part")).groupBy("part").count().orderBy("part").collect()
    )  # a row per input partition
    total = sum(r["count"] for r in counts)
    begins = np.cumsum([0, *(r["count"] for r in counts)])[:-1]
    starts = spark.sparkContext.broadcast(dict(zip((r["part"] for r in counts), begins.tolist())))

    @F.pandas_udf("long")
    def slot_of(place: pd.Series) -> pd.Series:
        places = place.to_numpy()
        begin = pd.Series(places >> ROW_BITS).map(starts.value).to_numpy()
        return pd.Series(slots(begin + (places & ((1 << ROW_BITS) - 1)), total, key))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, current = _encoder(file), None, None
        for batch in batches:
            rows = []
            for number, slot, text in zip(*(c for c in batch.columns[1:])):
                if number.as_py() != current:
                    if shard is not None:
                        shard.close()
                    current = number.as_py()
                    shard = _Shard(root, current, stride)
                ids = np.array([*token_ids(encoder, text.as_py()), END], dtype=KIND)
                rows.append((current, slot.as_py(), shard.add(ids), ids.size - 1, crc32(ids[:-1].tobytes())))
            shard_no, slot_no, first, size, check = zip(*rows) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(slot_no, pa.int64()), pa.array(shard_no, pa.int64()),
                    pa.array(first, pa.int64()), pa.array(size, pa.int64()), pa.array(check, pa.int64()),
                ],
                names=[id_col, "slot", "shard", "first_token", "n_tokens", "tokens_crc32"],
            )
        if shard is not None:
            shard.close()

    # The slots are known to be 0 to total - 1, so their ranges need no sample: consecutive shards go to a task.
    shards = max(1, -(-total // shard_rows))
    tasks = min(shards, MOST_TASKS)
    numbered = docs.select(
        F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("slot", slot_of("place"))
    in_order = (
        numbered.withColumn("shard", F.floor(F.col("slot") / shard_rows))
        .repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int"))
        .sortWithinPartitions("shard", "slot")
        .select("id", "shard", "slot", "text")
    )
    schema = f"`{id_col}` long, slot long, shard long, first_token long, n_tokens long, tokens_crc32 long"
    index = stored(mapped(in_order, write, schema), "training-index")
    # Equal to all numbers below the total, in any order: their count, last, sum and a checksum of their hashes.
    marks = [F.count("*"), F.max("slot"), F.sum(F.col("slot").cast("decimal(38, 0)")), F.bit_xor(F.xxhash64("slot"))]
    seen, want = (f.agg(*marks).first() for f in (index, spark.range(total).withColumnRenamed("id", "slot")))
    if seen != want:
        raise RuntimeError("the table changed between the two passes; write it to files first")
    return index


def read_rows(root: str, shard: int, row: int = 0, count: int | None = None, *, stride: int = STRIDE) -> np.ndarray:
    """Rows of a shard from the given one on, as an array of ``stride`` columns."""
    files, base = pafs.FileSystem.from_uri(root)
    with files.open_input_file(f"{base}/{shard_name(shard)}") as file:
        width = stride * KIND.itemsize
        rows = file.size() // width - row
        rows = rows if count is None else min(rows, count)
        file.seek(row * width)
        return np.frombuffer(file.read(max(rows, 0) * width), dtype=KIND).reshape(-1, stride)
