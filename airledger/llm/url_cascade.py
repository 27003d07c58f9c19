"""URL rules decided by a cascade of Bloom filters.

A rule names a host and the start of a path. A url fits a rule if one of its keys, the last labels of its host with
a start of its path, is the rule's; only the shapes (number of labels, length of path) that occur among the rules
are tried, longest first. Whether a key is listed is told by a cascade: the first filter holds the listed keys, the second
those keys of the corpus that the first takes for listed, the third the listed keys that the second takes for
unlisted, and so on until no key of the corpus or the list is mistaken. So the answer is exact for every key of the
corpus, and urls are judged in a map over the scan: the corpus is neither joined nor shuffled.

Only keys that pass the first filter leave the scan while the cascade is built. That filter gets enough bits that about as
many unlisted keys pass as there are listed ones, so a cascade is as large as its list, not as the corpus.
A list too long for one cascade is split by hash into several, applied one after another.

Defined cases: host and path as the contract of ``judged`` says; null urls have empty ones; a key that is listed to be
blocked and allowed is blocked; of equally long rules the one with the longer host wins; repeated rules count once,
null rules and verdicts other than these two not at all; ids are passed on as they are; a url no rule fits gets the default verdict; empty tables of pages or rules give no rows
or the default; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bloom
from .common import mapped, stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = "block", "allow"
#: The rules of the query, (verdict, host and path).
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))
LATER_BITS = 4
LEVELS = 64
#: Listed keys a cascade takes at most, and keys from which on the remaining levels are built on the driver.
KEYS_PER_CASCADE = 1 << 22
FEW_KEYS = 1 << 16


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hash(name: str, key: Column) -> Column:
    return F.xxhash64(F.lit(name), key)


def _hashes(key: str) -> list[Column]:
    return [_hash(name, F.col(key)).alias(name) for name in "ab"]


def _listed(rules: DataFrame) -> DataFrame:
    """(key, a, b, verdict, labels, chars, at_host) of the distinct rules of a frame (verdict, rule)."""
    host = F.translate(F.regexp_extract("rule", "(?s)^([^/]*)", 1), CAPITALS, SMALL)
    path = F.regexp_extract("rule", "(?s)^[^/]*(.*)$", 1)
    keys = rules.where(F.col("rule").isNotNull() & F.col("verdict").isin(BLOCK, ALLOW)).select(
        F.concat(host, path).alias("key"), F.size(F.split(host, "\\.")).alias("labels"), F.length(path).alias("chars"),
        F.col("verdict"),
    )
    one = keys.groupBy("key", "labels", "chars").agg(F.max("verdict").alias("verdict"))  # "block" is above "allow"
    return one.select("key", "labels", "chars", "verdict", *_hashes("key"))


def _candidates(shapes: list[tuple[int, int]]) -> Column:
    """The keys of a url with ``host``, ``path`` and ``parts``, longest first."""
    tried = F.expr(f"array({', '.join(f'struct({n} AS labels, {c} AS chars)' for n, c in shapes)})")
    fitting = F.filter(
        tried, lambda s: (s["labels"] <= F.size("parts")) & (s["chars"] <= F.length("path"))
    )

    def made(shape: Column) -> Column:
        host = F.array_join(F.slice("parts", -shape["labels"], shape["labels"]), ".")
        key = F.concat(host, F.substring("path", F.lit(1), shape["chars"]))
        return F.struct((-F.length(key)).alias("less"), (-F.length(host)).alias("less_host"), key.alias("key"))

    return F.transform(F.array_sort(F.transform(fitting, made)), lambda k: k["key"])


class Cascade:
    """Exact membership of the listed keys, for all keys the cascade was built over."""

    def __init__(self, levels: list[bloom.Bloom]):
        self.levels = levels

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        listed = np.zeros(len(a), dtype=bool)
        open_ = np.arange(len(a))
        for number, level in enumerate(self.levels):
            passed = level.holds(a[open_], b[open_])
            listed[open_[~passed]] = number % 2 == 1
            open_ = open_[passed]
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _passing(keys: DataFrame, level: bloom.Bloom) -> DataFrame:
    """The rows (key, a, b) that a filter takes for its own."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            yield batch.filter(pa.array(shared.value.holds(a, b)))

    return mapped(keys.select("key", "a", "b"), run, "key string, a long, b long")


def _last_levels(levels: list[bloom.Bloom], encoded: np.ndarray, others: np.ndarray) -> None:
    """Add levels until none is mistaken: the next one encodes ``encoded``, and ``others`` may pass it."""
    while len(encoded):
        if len(levels) >= LEVELS:
            raise ValueError("a listed and an unlisted key have equal 128-bit hashes")
        level = bloom.Bloom(len(encoded), LATER_BITS, len(levels))
        level.set(*encoded.T)
        levels.append(level)
        encoded, others = others[level.holds(*others.T)], encoded


def build(listed: DataFrame, keys: DataFrame, universe: int, *, few: int = FEW_KEYS) -> Cascade:
    """The cascade of the listed keys (key, a, b) over all ``keys`` (repeats allowed, ``universe`` of them at most)."""
    count = listed.count()
    if not count:
        return Cascade([bloom.Bloom(0, 1, 0)])
    bits = min(40, max(LATER_BITS, ceil(1.44 * log2(max(2, universe / count))) + 2))
    levels = [bloom.of(listed.select("a", "b"), count, bits)]
    mistaken = (
        _passing(keys, levels[0]).withColumn("own", F.lit(0))
        .unionByName(listed.select("key", "a", "b", F.lit(1).alias("own")))
        .groupBy("key").agg(F.max("own").alias("own"), F.max("a").alias("a"), F.max("b").alias("b"))
    )
    encoded = stored(mistaken.where("own = 0").select("key", "a", "b"), "mistaken")
    others = listed.select("key", "a", "b")
    left, rest = encoded.count(), count
    while left and left + rest > few:
        level = bloom.of(encoded.select("a", "b"), left, LATER_BITS, len(levels))
        levels.append(level)
        encoded, others = stored(_passing(others, level), "mistaken"), encoded
        left, rest = encoded.count(), left
        if len(levels) >= LEVELS:
            raise ValueError("a listed and an unlisted key have equal 128-bit hashes")
    if left:
        own, other = (
            np.stack([t["a"].to_numpy(), t["b"].to_numpy()], axis=1)
            for t in (f.select("a", "b").toArrow() for f in (encoded, others))
        )
        _last_levels(levels, own, other)
    return Cascade(levels)


def _probe(frame: DataFrame, cascades: dict[str, Cascade], parts: int, number: int) -> DataFrame:
    """Lower ``at`` to the place of a url's first listed key, and set the verdict with it.

    Only the keys of this part of the list are asked for; of others its cascades know nothing.
    """
    shared = frame.sparkSession.sparkContext.broadcast(cascades)
    hashes = [F.transform("keys", partial(_hash, name)).alias(f"{name}s") for name in "ab"]
    schema = frame.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(f"{n}s").flatten().to_numpy(zero_copy_only=False) for n in "ab")
            sizes = batch.column("as").value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            rows = np.repeat(np.arange(len(sizes)), sizes)
            at = batch.column("at").to_numpy(zero_copy_only=False).copy()
            verdicts = np.array(batch.column("verdict").to_pylist(), dtype=object)
            own = np.flatnonzero(a % parts == number)
            for verdict, cascade in shared.value.items():
                found = own[cascade.holds(a[own], b[own])]
                hit, first = np.unique(rows[found], return_index=True)
                place = (found[first] - starts[hit]).astype(at.dtype)
                earlier = place < at[hit]
                at[hit[earlier]], verdicts[hit[earlier]] = place[earlier], verdict
            columns = {n: batch.column(n) for n in schema.names}
            columns |= {"at": pa.array(at, pa.int32()), "verdict": pa.array(verdicts.tolist(), pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return mapped(frame.select("*", *hashes), run, schema)


def judged(
    pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW,
    keys_per_cascade: int = KEYS_PER_CASCADE, few: int = FEW_KEYS,
) -> DataFrame:
    """(id, host, path, rule, verdict) per page, from rules (verdict, rule).

    The host follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path goes on up to
    ``?``, ``#`` or the end; without ``://`` both are empty. A rule fits its host and the subdomains, if the path
    starts with the rule's; the longest wins. ``rule`` is null where none fits.
    """
    url = F.col(url_col).cast("string")
    seen = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    listed = stored(_listed(rules), "url-rules")
    shapes = sorted((r.labels, r.chars) for r in listed.select("labels", "chars").distinct().collect())
    none = F.lit(None).cast("string")
    if not shapes:
        return seen.select(F.col(id_col), "host", "path", none.alias("rule"), F.lit(default).alias("verdict"))
    keyed = seen.withColumn("parts", F.split("host", "\\.")).withColumn("keys", _candidates(shapes)).drop("parts")
    every = keyed.select(F.explode("keys").alias("key")).select("key", *_hashes("key"))
    universe = keyed.agg(F.sum(F.size("keys"))).first()[0] or 0
    parts = max(1, ceil(listed.count() / keys_per_cascade))

    def part_of(frame: DataFrame, number: int) -> DataFrame:
        return frame.where(F.pmod("a", F.lit(parts)) == number) if parts > 1 else frame

    found = keyed.withColumns({"at": F.size("keys"), "verdict": none})
    for number in range(parts):
        cascades = {
            verdict: build(
                part_of(listed, number).where(F.col("verdict") == verdict), part_of(every, number), universe, few=few
            )
            for verdict in (BLOCK, ALLOW)
        }
        found = _probe(found, cascades, parts, number)
        if parts > 1:
            found = stored(found, "url-verdicts")
    rule = F.get("keys", F.col("at"))
    return found.select(F.col(id_col), "host", "path", rule.alias("rule"), F.coalesce("verdict", F.lit(default)).alias("verdict"))
