"""Settings shared by the batch and streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# The alert thresholds (ppm, both strict), labels and messages users already see.
WARNING_LEVEL = 400.0
CRITICAL_LEVEL = 420.0
STATUS_CRITICAL = "CRITICAL"
STATUS_WARNING = "WARNING"
STATUS_NORMAL = "NORMAL"
FEED_CRITICAL = "High Warning"
FEED_WARNING = "Warning"
FEED_NORMAL = "Normal"
MESSAGE_CRITICAL = "High CO2 Level Detected"
MESSAGE_WARNING = "Elevated CO2 Level Detected"


@dataclass(frozen=True)
class Rules:
    """Alert thresholds; a level has to exceed one to trigger it."""

    warning: float = WARNING_LEVEL
    critical: float = CRITICAL_LEVEL


@dataclass(frozen=True)
class StreamSettings:
    """How the streaming queries run.

    ``shuffle_partitions`` is written into each checkpoint at the first start and cannot change
    afterwards, so size it for the expected peak, not for the first day. ``files_per_batch`` gathers
    the rows of a batch into that many files: with thousands of shuffle partitions and a short
    trigger, the few rows of each closed window would otherwise end in a file per partition.
    ``max_files_per_trigger`` bounds what the alerts and the status take from bronze at once; the
    windows always take whole bronze batches, as a batch cut in two could turn on-time rows into
    late ones. ``bronze_trigger`` lets bronze write fewer, larger batches than the outputs read; a
    drain ignores it. ``windows_from`` (zone-less UTC, on the hour) leaves windows before that time to
    a batch backfill, so a first start on a long history builds no state for them; a first drain
    chooses it itself if it is not given, and the root keeps it. ``idle_after_seconds`` is how long one of
    several feeds may be silent before the windows no longer wait for it (None: always wait); as the
    window queries start again then, it should span several triggers.
    """

    watermark: str = "5 seconds"
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    shuffle_partitions: int | None = None
    files_per_batch: int | None = None
    max_files_per_trigger: int | None = None
    bronze_trigger: dict | None = None
    windows_from: datetime | None = None
    idle_after_seconds: float | None = 60.0
    attempts: int = 3
    retry_delay_seconds: float = 10.0


#: Work through everything that is there, then stop.
DRAIN = {"availableNow": True}
