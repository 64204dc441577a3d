"""Tables of the session catalog (K1, K2, K4, S6, T6).

Parquet tables with a comment, properties, partitions and buckets, known by
name. Any catalog that Spark is configured with serves, the in-memory one of a
plain session included. Each table written here has a folder of its own below
``location`` (default: the database's), so that taking another's name moves no
files; :func:`drop_table` removes it with the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilowatt.operators.layout import layer_inventory
from kilowatt.operators.merge import READING_KEYS, merge_upsert, recent
from kilowatt.session import remove_folder, stored
from kilowatt.sinks.partitioned import in_values
from kilowatt.sinks.versioned import touched_values


def quoted(name: str) -> str:
    """``db.table`` as SQL identifiers."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _text(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _folder(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def create_or_replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), comment: str | None = None,
                            properties: dict[str, str] | None = None, column_comments: dict[str, str] | None = None,
                            buckets: tuple[int, Sequence[str]] | None = None, location: str | None = None) -> None:
    """CREATE OR REPLACE TABLE … AS SELECT, with COMMENT, TBLPROPERTIES, partitions
    and ``buckets`` (their number and columns; rows are sorted by these within a
    bucket). Columns, partitions and properties may differ from the table before.

    The new table is written completely under another name first, so a failed job
    leaves the old one as it was; then it takes the name. (In between, for the
    time of two catalog calls, no table has it.)"""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:12]
    view, new = f"rows_{mark}", f"{name}__{mark}"
    df.createOrReplaceTempView(view)
    clauses = ["USING parquet"]
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})")
    if buckets:
        cols = ", ".join(map(quoted, buckets[1]))
        clauses.append(f"CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {int(buckets[0])} BUCKETS")
    base = location or spark.catalog.getDatabase(name.split(".")[0] if "." in name else spark.catalog.currentDatabase()).locationUri
    clauses.append(f"LOCATION {_text(base.rstrip('/') + '/' + new.split('.')[-1])}")
    if comment is not None:
        clauses.append(f"COMMENT {_text(comment)}")
    if properties:
        clauses.append(f"TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in properties.items())})")
    try:
        spark.sql(f"CREATE TABLE {quoted(new)} {' '.join(clauses)} AS SELECT * FROM {view}")
        for column, text in (column_comments or {}).items():
            spark.sql(f"ALTER TABLE {quoted(new)} ALTER COLUMN {quoted(column)} COMMENT {_text(text)}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(new)}")
        raise
    finally:
        spark.catalog.dropTempView(view)
    old = _folder(spark, name) if spark.catalog.tableExists(name) else None
    if old:
        spark.sql(f"DROP TABLE {quoted(name)}")
    spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(name)}")
    if old:
        remove_folder(spark, old)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drops a table and its files."""
    folder = _folder(spark, name)
    spark.sql(f"DROP TABLE {quoted(name)}")
    remove_folder(spark, folder)


def table_details(spark: SparkSession, name: str) -> dict:
    """``comment``, ``properties``, ``columns``, ``partition_by``, ``buckets`` (column
    names) and ``column_comments`` of a table, from the catalog."""
    columns = spark.catalog.listColumns(name)
    shown = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return {"comment": spark.catalog.getTable(name).description,
            "properties": {r["key"]: r["value"] for r in shown},
            "columns": [c.name for c in columns],
            "partition_by": [c.name for c in columns if c.isPartition],
            "buckets": [c.name for c in columns if c.isBucket],
            "column_comments": {c.name: c.description for c in columns if c.description}}


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the partitions it has rows for, no others."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _evolved(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the table's column order; columns that the table lacks are added
    to it (older rows read NULL), those that ``df`` lacks are NULL."""
    spark = df.sparkSession
    known = spark.table(name)
    new = [f for f in df.schema if f.name.lower() not in {c.lower() for c in known.columns}]
    if new:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({', '.join(f'{quoted(f.name)} {f.dataType.simpleString()}' for f in new)})")
        known = spark.table(name)
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in known.schema])


def append_table(df: DataFrame, name: str) -> None:
    """Adds rows, by column name; new columns are added to the table."""
    _evolved(df, name).write.insertInto(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replaces the partitions that ``df`` has rows for, by column name."""
    rows = _evolved(df, name)
    with _dynamic(df.sparkSession):
        rows.write.insertInto(name, overwrite=True)


def stream_to_table(df: DataFrame, name: str, checkpoint: str, partition_by: Sequence[str] = (), location: str | None = None) -> StreamingQuery:
    """Drains a stream (availableNow) into a table, which is created where it
    doesn't exist; one checkpoint per table."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location:
        w = w.option("path", location)
    q = w.toTable(name)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def merge_table(name: str, source: DataFrame, keys: Sequence[str] = READING_KEYS, compare: Sequence[str] = ("production_kwh",),
                as_of=None, recent_days: int | None = 7, partition_col: str = "date", null_safe: bool = False) -> None:
    """MERGE INTO a table partitioned by its date column: the partitions of the
    source's dates and of the delete window are merged, stored, and put in the
    place of the old ones; partitions left without rows are dropped."""
    spark = source.sparkSession
    target = spark.table(name)
    touched = touched_values(source, partition_col)
    before = target.filter(in_values(partition_col, touched) | recent(partition_col, as_of, recent_days))
    old = touched_values(before, partition_col)
    rows = stored(merge_upsert(before, source, keys, compare, as_of, recent_days, partition_col, null_safe).drop("_action"), "merged")
    new = set(touched_values(rows, partition_col))
    overwrite_partitions(rows.hint("rebalance", partition_col), name)
    for value in old:
        if value not in new:
            shown = "null" if value is None else _text(str(value))
            spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION ({quoted(partition_col)} = {shown})")


def bucketed_merge(name: str, source: DataFrame, keys: Sequence[str] = READING_KEYS, **options) -> DataFrame:
    """The merge plan over a table bucketed by ``keys``: the source alone is
    shuffled, into as many parts as the table has buckets; the table's rows are
    joined as they lie. ``options``: those of :func:`merge_upsert`."""
    spark = source.sparkSession
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").filter("col_name = 'Num Buckets'").collect()
    if not rows or table_details(spark, name)["buckets"] != [c for c in spark.table(name).columns if c in keys]:
        raise ValueError(f"{name} is not bucketed by {list(keys)}")
    return merge_upsert(spark.table(name), source.repartition(int(rows[0]["data_type"]), *keys), keys, **options)


def catalog_inventory(spark: SparkSession, database: str) -> DataFrame:
    """One row per table of ``database``, as :func:`layer_inventory` counts them,
    with the comment the catalog has."""
    tables = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    counts = layer_inventory(spark, {t.name: f"{database}.{t.name}" for t in tables}, layer_of=lambda _: database)
    comments = spark.createDataFrame([(t.name, t.description) for t in tables], "table_name string, comment string")
    return counts.join(comments, "table_name")
