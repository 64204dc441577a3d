"""Repeated rows dropped within a stream (W1, U3).

The first row of a key goes through at once; the key is remembered until the
watermark is past its time, so rows that come again within the delay are
dropped, in whatever batch, and the state never grows beyond that span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatt.streaming.rollup import event_time, wall_clock


def drop_repeats(stream: DataFrame, keys: Sequence[str], delay: str = "1 hour", ts: str = "timestamp") -> DataFrame:
    """``stream`` with one row per key among rows whose times are at most ``delay``
    apart. Rows that are late by more than that are dropped, as are rows without
    a time. With ``ts`` among the keys this is an exact DISTINCT of what arrives
    in time. NULL keys are equal."""
    df, was_ntz = event_time(stream, ts)
    out = df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return out.withColumn(ts, wall_clock(stream, F.col(ts), was_ntz)).select(*stream.columns)
