"""Dimension joins: a plain join, whose strategy Spark chooses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(facts: DataFrame, dim: DataFrame, on, how: str = "left", broadcast: bool = False) -> DataFrame:
    """``facts ⋈ dim``. Spark broadcasts the dimension when its statistics are
    under ``spark.sql.autoBroadcastJoinThreshold``, or at run time once AQE has
    measured its shuffle; otherwise both sides are shuffled and AQE splits a
    skewed site. ``broadcast=True`` is for a caller who knows the size."""
    return facts.join(F.broadcast(dim) if broadcast else dim, on, how)
