"""Change events: decode, readings, profile by operation, table state.

A change feed has a ``value`` column (one JSON envelope per row) and, where the source knows the
arrival order, an orderable ``seq`` column. Other columns pass through ``decode`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import times
from ..schemas import CORRUPT, ROW_FIELDS, envelope, text_envelope
from .latest import newest

READING_COLUMNS = ("id", "sensor_id", "co2_level", "measurement_time", "location", "op")


def _from_text(path: str, to_type: str) -> Column:
    text = F.col(f"again.{path}")
    if to_type != "bigint":
        return text.try_cast(to_type)
    # 7.0 and 1.7E15 are whole numbers in other clothes; 7.5 is not one.
    number = text.try_cast("decimal(38, 9)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def _leaf(path: str, to_type: str) -> Column:
    """The typed leaf, or the lenient cast of its text where the document was read again."""
    again = _from_text(path, to_type)
    return F.when(F.col("again").isNull(), F.col(f"payload.{path}")).otherwise(again)


#: Why a document names no row. A tombstone (null) is not one: it follows a delete and says nothing.
EMPTY, UNREADABLE, NO_PAYLOAD, NO_ROW = "empty", "unreadable", "no payload", "no row"


def _problem() -> Column:
    read = F.col("payload").isNotNull() | F.col("again").isNotNull()
    named = F.coalesce(_leaf("after.id", "bigint"), _leaf("before.id", "bigint")).isNotNull()
    return (
        F.when(F.col("value").isNull() | (read & named), None)
        .when(F.trim("value") == "", EMPTY)
        .when(~read & F.col(CORRUPT).isNotNull(), UNREADABLE)
        .when(~read, NO_PAYLOAD)
        .otherwise(NO_ROW)
    )


def decode(changes: DataFrame, *, history: bool = False, keep_raw: bool = False) -> DataFrame:
    """Flatten the envelope; a document or leaf that cannot be read becomes NULL.

    Documents are read with their proper types. Only those with something unreadable (a quoted
    number, say) are read once more as text and cast leaf by leaf, so one bad leaf does not cost
    the others. ``measurement_time`` stays in epoch microseconds. ``history`` adds ``before_id``
    and ``ts_ms``, and with it ``keep_raw`` the ``problem`` of a document that names no row and its text, ``raw``.
    """
    carried = [c for c in changes.columns if c != "value" or keep_raw]
    # Parsing sits inside generators because filters are not pushed through one. In a plain
    # projection the optimizer copies from_json into each later filter and parses rows twice.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    typed = F.from_json("value", envelope(history=history), options)
    first = changes.select(*carried, F.inline(F.array(typed)))
    lenient = F.from_json(CORRUPT, text_envelope(history=history))["payload"]
    again = F.when(F.col(CORRUPT).isNotNull(), lenient)
    parsed = first.select(*carried, "payload", CORRUPT, F.explode(F.array(again)).alias("again"))
    columns = [_leaf(f"after.{name}", type_).alias(name) for name, type_ in ROW_FIELDS.items()]
    columns.append(_leaf("op", "string").alias("op"))
    if history:
        columns += [
            _leaf("before.id", "bigint").alias("before_id"),
            _leaf("ts_ms", "bigint").alias("ts_ms"),
        ]
    if keep_raw:
        columns += [_problem().alias("problem"), F.when(_problem().isNotNull(), F.col("value")).alias("raw")]
    return parsed.select(*[c for c in carried if c != "value"], *columns)


def readings(changes: DataFrame) -> DataFrame:
    """One row per create, snapshot or update; deletes, tombstones and unreadable rows fall out.

    The feed is append-only: an update is one more reading and retracts nothing.
    """
    rows = decode(changes)
    carried = [c for c in rows.columns if c not in READING_COLUMNS]
    return rows.where(F.col("id").isNotNull()).select(
        *carried,
        "id",
        "sensor_id",
        "co2_level",
        times.event_time("measurement_time").alias("measurement_time"),
        "location",
        "op",
    )


def profile_by_op(changes: DataFrame) -> DataFrame:
    """How many changes of each operation the feed holds, unreadable ones under NULL."""
    return decode(changes).groupBy("op").agg(F.count(F.lit(1)).alias("changes"))


def history(changes: DataFrame, *, quarantine: bool = False) -> DataFrame:
    """Every change that names a row, decoded: readings and deletes, with ``before_id`` and ``ts_ms``.

    With ``quarantine`` also the documents that name none, as they came (``raw``), with what is wrong (``problem``).
    """
    rows = decode(changes, history=True, keep_raw=quarantine)
    named = F.coalesce("id", "before_id").isNotNull()
    return rows.where(named | F.col("problem").isNotNull() if quarantine else named)


def _check_order(changes: DataFrame) -> None:
    """Changes of one row need an order of arrival; lines of a plain text file have none."""
    found = changes.schema["seq"].dataType if "seq" in changes.columns else None
    names = getattr(found, "names", [])
    if found is None or "file_path" in names and "line" not in names:
        raise ValueError("the table state needs a feed whose seq orders the changes of a row")


def table_state(changes: DataFrame) -> DataFrame:
    """Current rows of the captured table, from a feed with ``value`` and an ordering ``seq``."""
    _check_order(changes)
    return state_of(history(changes))


def state_of(rows: DataFrame) -> DataFrame:
    """Current rows from decoded ``history``: the last change of each id, unless it was a delete.

    The last is the one that arrived last (``seq``): all changes of a row come through one partition
    of the topic, while the connector's clock (``ts_ms``) may step back. The aggregate keeps one
    candidate per id and input partition, so an id that is updated endlessly shuffles one row per
    partition and never gathers in a task. Ids of different feeds (``feed``, where there is one) are
    different rows.
    """
    _check_order(rows)
    row_id = F.coalesce("id", "before_id")
    if "feed" in rows.columns:
        row_id = F.when(row_id.isNotNull(), F.struct("feed", row_id.alias("id")))
    rows = rows.withColumns({"row_id": row_id, "gone": F.col("op").eqNullSafe("d")})
    order = ["seq", "ts_ms"]
    image = ["id", "gone", "sensor_id", "co2_level", "measurement_time", "location"]
    identified = rows.where(F.col("row_id").isNotNull()).select("row_id", *order, *image)
    last = newest(identified, "row_id", order)
    return last.where(F.col("id").isNotNull() & ~F.col("gone")).select(
        "id",
        "sensor_id",
        "co2_level",
        times.local_time(F.timestamp_micros("measurement_time")).alias("measurement_time"),
        "location",
    )
