"""Upsert (MERGE) as a Spark job on plain parquet tables.

Semantics kept from the SQL MERGE:

* NULL keys never match (inserted from the source / kept or deleted in the target);
* matched rows are updated only when ``source.c != target.c`` is TRUE for a
  compared column (NULL-unaware, like SQL; ``null_safe=True`` also updates
  NULL ↔ value changes);
* unmatched source rows are inserted;
* unmatched target rows are deleted only when recent
  (``date >= as_of - recent_days``), otherwise kept; ``recent_days=None``
  never deletes (incremental batches that carry only new data).

Rows with a NULL key go around the join: they match nothing, and as one key
they would meet in one task. The technology is part of the reading key: a
hybrid site has a solar and a wind reading for the same hour.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READING_KEYS = ("timestamp", "site_id", "technology")


class DuplicateSourceKeys(ValueError):
    pass


def known(keys: Sequence[str]) -> Column:
    """No key is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def check_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a non-NULL key occurs twice in the source (MERGE would be ambiguous)."""
    dup = source.filter(known(keys)).groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise DuplicateSourceKeys(f"source has duplicate keys, e.g. {dup[0].asDict()}")


def as_date(v) -> Column:
    if v is None:
        return F.current_date()
    if isinstance(v, Column):
        return v
    if isinstance(v, (dt.date, dt.datetime)):
        return F.lit(v).cast("date")
    return F.to_date(F.lit(str(v)))


def recent(date_col: str, as_of, recent_days: int | None) -> Column:
    """Inside the delete window (a NULL date never is)."""
    if recent_days is None:
        return F.lit(False)
    return F.coalesce(F.col(date_col) >= F.date_sub(as_date(as_of), recent_days), F.lit(False))


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str] = READING_KEYS,
                  compare: Sequence[str] = ("production_kwh",), as_of=None,
                  recent_days: int | None = 7, date_col: str = "date", null_safe: bool = False,
                  check_duplicates: bool = True) -> DataFrame:
    """Target columns, values after the merge, and ``_action`` in {insert,
    update, delete, keep}.

    With ``check_duplicates`` a non-NULL key occurring twice in the source
    fails the job when the merge runs (as SQL MERGE does). The count is a
    window over the merge keys, whose hash partitioning the join then reuses,
    so the check adds no shuffle and no separate job."""
    cols, keyed = target.columns, known(keys)
    gone = F.when(recent(date_col, as_of, recent_days), "delete").otherwise("keep")
    around = (target.filter(~keyed).withColumn("_action", gone)
              .unionByName(source.filter(~keyed).select(*cols).withColumn("_action", F.lit("insert"))))

    src = source.filter(keyed).withColumn("_s", F.lit(True))
    if check_duplicates:
        src = src.withColumn("_dupn", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    t = target.filter(keyed).withColumns({"_t": F.lit(True), "_gone": gone}).alias("t")
    s = src.alias("s")
    j = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")
    if null_safe:
        changed = [~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in compare]
    else:
        changed = [F.coalesce(F.col(f"s.{c}") != F.col(f"t.{c}"), F.lit(False)) for c in compare]
    action = F.when(F.col("s._s").isNull(), F.col("t._gone"))
    if check_duplicates:
        action = F.when(F.col("s._dupn") > 1,
                        F.raise_error(F.lit(f"MERGE source has duplicate keys {list(keys)}")).cast("string")
                        ).when(F.col("s._s").isNull(), F.col("t._gone"))
    action = (action.when(F.col("t._t").isNull(), "insert")
              .when(reduce(lambda a, b: a | b, changed), "update").otherwise("keep"))
    j = j.withColumn("_action", action)
    take_s = F.col("_action").isin("insert", "update")
    met = j.select(*[F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols], "_action")
    return met.unionByName(around)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] = READING_KEYS,
                 compare: Sequence[str] = ("production_kwh",), as_of=None, recent_days: int | None = 7,
                 date_col: str = "date", null_safe: bool = False, check_duplicates: bool = True,
                 keep_deleted: bool = False, touched: Sequence | None = None) -> DataFrame:
    """The target table after the merge, with ``_action`` per row (deleted rows
    are dropped unless ``keep_deleted``). Duplicate source keys fail the job
    when it runs (``check_duplicates``); :func:`check_unique_keys` checks
    eagerly instead.

    ``touched``: the dates of the source (None for NULL), where the caller
    knows them and the date follows from the keys. Then only target rows of these dates, or
    inside the delete window, are joined; on a date-partitioned target they
    are partition filters. All others pass through without a shuffle."""
    untouched = None
    if touched is not None:
        hit = F.col(date_col).isin([v for v in touched if v is not None]) | recent(date_col, as_of, recent_days)
        hit = F.coalesce(hit, F.lit(any(v is None for v in touched)))
        untouched = target.filter(~hit).withColumn("_action", F.lit("keep"))
        target = target.filter(hit)
    out = merge_actions(target, source, keys, compare, as_of, recent_days, date_col, null_safe, check_duplicates)
    if untouched is not None:
        out = out.unionByName(untouched)
    return out if keep_deleted else out.filter(F.col("_action") != "delete")
