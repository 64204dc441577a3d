"""Drift against a baseline that learns (§2.13).

Each site's state holds the number, sum and sum of squares of the days seen so
far, as exact integers; a day is judged by the days before it and then joins
them. A site that is silent for longer than ``expiry_days`` starts anew, and its
state is removed once the watermark is past that time, so the state is bounded
by the sites that are active.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kilowatt import constants as K
from kilowatt.functions.expressions import alert_level, exact, round_double

#: Sums are kept in units of the last of these decimals.
_UNIT = 10_000


def _judged(x: int | None, n: int, s: int, ss: int) -> tuple[float | None, float | None]:
    """Mean of the days before in MWh, and the z-score of ``x``: NULL below two days
    or without any deviation."""
    mean = s / n / _UNIT if n else None
    spread = n * ss - s * s
    if x is None or n < 2 or not spread:
        return mean, None
    return mean, (x - s / n) / math.sqrt(spread / (n * (n - 1)))


def learned_drift(daily: DataFrame, site_keys: Sequence[str] = ("site_id", "technology"), value: str = "total_production_mwh",
                  expiry_days: int = 30, late_days: int = 1) -> DataFrame:
    """A stream of daily rows (``date``, ``site_keys``, ``value``) → the same with
    ``baseline_days``, ``baseline_mean``, ``z_score`` and ``alert_level``. Days should
    arrive in order from batch to batch; within one they are put in order. A NULL
    value is judged (NULL) but not learned. Values count to four decimals."""
    keys = list(site_keys)
    kinds = dict(daily.dtypes)
    out = ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", date date, value double, baseline_days long, baseline_mean double, z double"

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, s, ss, last = state.get if state.exists else (0, "0", "0", None)
        s, ss = int(s), int(ss)
        rows = pd.concat(list(frames)).sort_values(["date", "value"])  # one site's days of one batch
        found = []
        for day, v in zip(rows["date"], rows["value"]):
            if last is not None and (day - last).days > expiry_days:
                n = s = ss = 0
            x = None if pd.isna(v) else round(v * _UNIT)
            found.append((*key, day, None if x is None else v, n, *_judged(x, n, s, ss)))
            if x is not None:
                n, s, ss = n + 1, s + x, ss + x * x
            last = day if last is None else max(last, day)
        state.update((n, str(s), str(ss), last))
        until = pd.Timestamp(last) + pd.Timedelta(days=expiry_days + 1)
        state.setTimeoutTimestamp(max(int(until.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(found, columns=[*keys, "date", "value", "baseline_days", "baseline_mean", "z"])

    rows = daily.select(*keys, "date", F.col(value).alias("value"), F.col("date").cast("timestamp").alias("_time")).withWatermark("_time", f"{late_days} days")
    judged = rows.groupBy(*keys).applyInPandasWithState(
        update, out, "n long, s string, ss string, last date", "append", GroupStateTimeout.EventTimeTimeout)
    z = round_double(exact("z"), 2)
    return judged.select("date", *keys, F.col("value").alias(value), "baseline_days", round_double(exact("baseline_mean"), 4).alias("baseline_mean"),
                         z.alias("z_score"), F.when(F.col("baseline_days") < 2, K.NO_BASELINE).otherwise(alert_level(z)).alias("alert_level"))
