"""Spelling variants by permuterm rotations.

A word is closed by a mark and rotated to every place. The rotation that ends in a character, without that
character, is what the word shares with every word that has another character there (a replacement), and
it is a whole rotation of the word that has none there (an insertion or deletion). So the sorted rotations
fall into groups of equal text around one skipped character, and a scan of a group finds all its
neighbours: those sorted before and after a row. A group holds at most one word per letter of the alphabet and
one without, whatever the number of words; no pair is written out, each row leaves with the number and the best of its
neighbours.

A character repeated in a run ("aab") can be inserted at several places of the same word; only the first of
the run counts, so a pair of words meets once.

Rotations of more than ``LONGEST_TEXT`` characters are replaced by four 31-bit prefix polynomials of the
same text, so a word of a million letters costs a million short rows and not their square.

Words are numbered in code-point order once; rotations carry numbers, not texts.

Defined cases: a null text has no words; a null id is written as nothing before the colon; equal rows count as often
as they stand there; an empty table gives an empty result; ties go to the smaller word in code-point order; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import mapped, stored, text_of
from .polynomials import FIELDS, Prefixes

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGED_EVERY = 199
LEAST_CHARS = 6
LEAST_TIMES = 5
FORM_FACTOR = 5

MARK = "$"
LONGEST_TEXT = 256
ROWS_AT_ONCE = 1 << 16


def words(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", damaged_every: int = DAMAGED_EVERY,
    least_chars: int = LEAST_CHARS, least_times: int = LEAST_TIMES,
) -> DataFrame:
    """(word, n): the words of all texts, some of them damaged by rule, that occur often enough."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key")
    runs = docs.select(key, F.explode(F.regexp_extract_all(text_of(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    low = runs.where(F.length("run") >= least_chars).select("key", F.translate("run", CAPITALS, SMALL).alias("run"))
    draw = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    place = (draw % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(draw % damaged_every == 0, shorter).otherwise(F.col("run")).alias("word")
    counted = low.select(word).where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_times)


def _digests(word: str) -> tuple[np.ndarray, np.ndarray]:
    """The polynomials of the word's rotations, as (rotations without their last character, whole rotations),
    one row of a number per field each."""
    codes = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)
    size = len(codes)
    skipped, whole = np.empty((size, len(FIELDS)), np.uint64), np.empty((size + 1, len(FIELDS)), np.uint64)
    at = np.arange(size + 1)
    for field, (prime, base) in enumerate(FIELDS):
        p, text = np.uint64(prime), Prefixes(codes, field)

        def joined(end: np.ndarray, start: np.ndarray) -> np.ndarray:
            """The text from ``start`` on, the mark, the text before ``end``."""
            tail = text.up[size - start]
            rest = tail * np.uint64(ord(MARK)) % p + tail * np.uint64(base) % p * text.before[end] % p
            return (text.between(start, np.full_like(start, size)) + rest) % p

        skipped[:, field] = joined(at[:-1], at[1:])
        whole[:, field] = joined(at, at)
    return skipped, whole


def rotations(word: str) -> Iterator[tuple[list[str], list[str], list[bool]]]:
    """Blocks of (text around a skipped place, character there, whether the place opens a run of it).

    A place between two characters is skipped as well, with no character; there the rotation is whole.
    """
    size, ring = len(word), word + MARK + word
    opens = [i == 0 or word[i - 1] != word[i] for i in range(size)]
    if size < LONGEST_TEXT:
        around = [ring[i + 1 : i + 1 + size] for i in range(size)] + [ring[i : i + size + 1] for i in range(size + 1)]
        yield around, [*word, *[""] * (size + 1)], opens + [False] * (size + 1)
        return
    skipped, whole = _digests(word)
    for start in range(0, size, ROWS_AT_ONCE):
        part = range(start, min(size, start + ROWS_AT_ONCE))
        if size <= LONGEST_TEXT:
            around = [ring[i + 1 : i + 1 + size] for i in part]
        else:
            around = [f"{size}:{a:x}.{b:x}.{c:x}.{d:x}" for a, b, c, d in skipped[part.start : part.stop].tolist()]
        yield around, list(word[part.start : part.stop]), opens[part.start : part.stop]
    for start in range(0, size + 1, ROWS_AT_ONCE):
        rows = whole[start : start + ROWS_AT_ONCE].tolist()
        around = [f"{size + 1}:{a:x}.{b:x}.{c:x}.{d:x}" for a, b, c, d in rows]
        yield around, [""] * len(rows), [False] * len(rows)


def _rotate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    around, skipped, opens, numbers, counts = [], [], [], [], []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(around, pa.string()), pa.array(skipped, pa.string()), pa.array(opens, pa.bool_()),
             pa.array(numbers, pa.int64()), pa.array(counts, pa.int64())],
            names=["around", "skipped", "opens", "no", "n"],
        )
        for column in (around, skipped, opens, numbers, counts):
            column.clear()
        return batch

    for batch in batches:
        for no, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for texts, chars, first in rotations(word):
                around += texts
                skipped += chars
                opens += first
                numbers += [no] * len(texts)
                counts += [n] * len(texts)
                if len(around) >= ROWS_AT_ONCE:
                    yield flush()
    if around:
        yield flush()


def neighbours(numbered: DataFrame) -> DataFrame:
    """(no, n_near, best) per word that has a near one, from (no, word, n); ``best`` is (-n, no) of the most frequent."""
    rows = mapped(
        numbered.select("no", "word", "n"), _rotate, "around string, skipped string, opens boolean, no long, n long"
    )
    group = Window.partitionBy("around")
    scan = group.orderBy("skipped")
    me = F.struct((-F.col("n")).alias("less"), "no")
    lettered = F.col("skipped") != ""
    behind = F.min(F.when(lettered, me)).over(scan.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(lettered, me)).over(scan.rowsBetween(1, Window.unboundedFollowing))

    def of_group(kept: Column) -> tuple[Column, Column]:
        return F.count(F.when(kept, 1)).over(group), F.min(F.when(kept, me)).over(group)

    letters, _ = of_group(lettered)
    openers, best_opener = of_group(F.col("opens"))
    shorter, best_shorter = of_group(~lettered)
    replaced = F.struct((letters - 1).alias("near"), F.least(behind, ahead).alias("best"))
    both = F.struct((letters - 1 + shorter).alias("near"), F.least(behind, ahead, best_shorter).alias("best"))
    inserted = F.struct(openers.alias("near"), best_opener.alias("best"))
    found = F.when(~lettered, inserted).when(F.col("opens"), both).otherwise(replaced)
    scanned = rows.select("no", found.alias("found")).where("found.near > 0")
    return scanned.groupBy("no").agg(F.sum("found.near").alias("n_near"), F.min("found.best").alias("best"))


def _roots(links: DataFrame, most: int, factor: int) -> DataFrame:
    """(no, root_no) from (no, up): the end of each chain.

    A form is at least ``factor`` times as frequent as its word, so no chain is longer than a logarithm of the
    largest count, and a round doubles the steps made.
    """
    longest = math.log(max(most, 2)) / math.log(factor)
    for _ in range(math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        onward = links.select(F.col("no").alias("up"), F.col("up").alias("further"))
        links = stored(
            links.join(onward, "up", "left").select("no", F.coalesce("further", "up").alias("up")), "roots"
        )
    return links.withColumnRenamed("up", "root_no")


def variants(counted: DataFrame, *, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of (word, n); words are distinct."""
    if factor < 2:
        raise ValueError("a form has to be at least twice as frequent, or chains have no end")
    numbered = stored(
        counted.orderBy("word").select(F.monotonically_increasing_id().alias("no"), "word", "n"), "words"
    )
    near = stored(
        numbered.join(neighbours(numbered), "no", "left").select(
            "no", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.no")).alias("up"),
        ),
        "near-words",
    )
    most = numbered.agg(F.max("n")).first()[0] or 0
    roots = _roots(near.where("up IS NOT NULL").select("no", "up"), most, factor)
    names = numbered.select("no", "word", "n")
    form = names.select(F.col("no").alias("up"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = names.select(F.col("no").alias("root_no"), F.col("word").alias("root"))
    return (
        near.join(roots, "no", "left").join(form, "up", "left").join(root, "root_no", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The variants of the words of all texts."""
    return variants(words(docs, id_col=id_col, text_col=text_col))
