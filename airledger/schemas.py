"""Shapes of the change envelope and of the result tables."""

from __future__ import annotations

from dataclasses import dataclass

# Leaves of the row image inside the envelope, as the connector writes them.
ROW_FIELDS = {
    "id": "bigint",
    "sensor_id": "string",
    "co2_level": "double",
    "measurement_time": "bigint",
    "location": "string",
}
CORRUPT = "_corrupt_record"


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"{name}: {type_}" for name, type_ in fields.items()) + ">"


def _payload(row: dict[str, str], before: dict[str, str], ts_ms: str, history: bool) -> str:
    fields = {"after": _struct(row), "op": "string"}
    if history:
        fields |= {"before": _struct(before), "ts_ms": ts_ms}
    return _struct(fields)


def envelope(*, history: bool) -> str:
    """Typed envelope; ``before`` and ``ts_ms`` are parsed only where the history is needed. The
    text of a document with anything unreadable in it comes back in ``_corrupt_record``."""
    payload = _payload(ROW_FIELDS, {"id": "bigint"}, "bigint", history)
    return f"payload {payload}, {CORRUPT} string"


def text_envelope(*, history: bool) -> str:
    """The same envelope with every leaf as text, for a second, lenient reading."""
    row = dict.fromkeys(ROW_FIELDS, "string")
    return f"payload {_payload(row, {'id': 'string'}, 'string', history)}"


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    max_chars: int | None = None


@dataclass(frozen=True)
class Table:
    """A result table: columns in insert order, with the constraints its rows must meet."""

    name: str
    columns: tuple[Column, ...]
    key: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


# Table and column names, lengths and NOT NULLs of the tables dashboards read.
_SENSOR = Column("sensor_id", "string", required=True, max_chars=50)
_PLACE = Column("location", "string", max_chars=100)
_LEVEL = Column("co2_level", "double", required=True)
_WINDOW_END = Column("window_end", "timestamp_ntz", required=True)
_AVERAGE = Column("avg_co2", "double", required=True)

MEASUREMENTS = Table(
    "co2_measurements",
    (
        Column("id", "bigint", required=True),
        _SENSOR,
        _LEVEL,
        Column("measurement_time", "timestamp_ntz", required=True),
        _PLACE,
    ),
    key="id",
)
MINUTE_AVERAGES = Table("co2_aggregated", (_SENSOR, _PLACE, _WINDOW_END, _AVERAGE))
HOURLY_AGGREGATES = Table(
    "co2_hourly_aggregates",
    (
        _SENSOR,
        _PLACE,
        _WINDOW_END,
        _AVERAGE,
        Column("min_co2", "double"),
        Column("max_co2", "double"),
    ),
)
ALERTS = Table(
    "co2_alerts",
    (
        _SENSOR,
        _PLACE,
        _LEVEL,
        Column("alert_time", "timestamp_ntz", required=True),
        Column("message", "string", max_chars=255),
    ),
)
CURRENT_STATUS = Table(
    "current_co2_status",
    (
        _SENSOR,
        _LEVEL,
        Column("status", "string", required=True, max_chars=20),
        Column("last_updated", "timestamp_ntz", required=True),
        _PLACE,
    ),
    key="sensor_id",
)
