"""Streaming twin of the speed layer (STM-05/06): now-playing transitions →
plays, incrementally, with the open segment kept in the state store.

Same rules as the batch ``operators.segments.dwell_segments``: a segment
starts when the track differs from the previous event's track (empty ids
never start one, but they do count as the previous track); it ends at the
next segment's start, clamped to start + duration/1000 + 15 s when the
duration is known, else to start + ``unknown_s``; plays shorter than the dwell
threshold are dropped. Rows are put in order before they are judged
(``streaming.ordered``), and the open tail is closed by an event-time timer at
its clamp. On segments that the watermark has passed the stream equals the
batch twin, in whatever order and batches the rows come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.streaming.ordered import Plays, ordered

OUT = "device_id string, track_id string, started_at timestamp, played_at timestamp"
COLUMNS = ["device_id", "captured_at", "track_id", "track_duration_ms"]
#: A segment of unknown duration is closed after six hours without a change.
UNKNOWN_S = 6 * 3600


def plays_stream(captures: DataFrame, watermark: str = "10 minutes", dwell_s: int = 30,
                 slack_s: int = 15, unknown_s: int = UNKNOWN_S) -> DataFrame:
    """Streaming plays from a stream of landed captures (``device_id``,
    ``captured_at``, ``track_id``, ``track_duration_ms``). State per device
    is one open segment and the rows of one watermark delay."""
    rows = captures.select("device_id", "captured_at", "track_id", F.col("track_duration_ms").cast("long").alias("track_duration_ms"))
    machine = Plays(COLUMNS.index("track_id"), COLUMNS.index("captured_at"), COLUMNS.index("track_duration_ms"),
                    dwell_s, slack_s, unknown_s)
    return ordered(rows, "device_id", "captured_at", ["track_id"], machine, OUT, watermark)
