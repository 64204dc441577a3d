"""The medallion jobs end to end: landing CSV → bronze → silver → gold.

Every layer table is a versioned table: a rebuild is a new version that
becomes visible only at its commit (an atomic overwrite with time travel and
history, where a plain parquet overwrite would delete the old files before
writing). Each job reads the previous layer from storage and writes its own,
so a lost executor only recomputes from the last written layer; writes of
partitioned tables are rebalanced by their partition columns (AQE sizes the
tasks and splits a hot partition value), which avoids one small file per
task × partition value."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatt import schemas
from kilowatt.operators import bronze, gold, quality, silver
from kilowatt.session import path_exists, stored
from kilowatt.sinks import versioned
from kilowatt.sinks.layers import read_layer
from kilowatt.sources.files import read_csv


@dataclass(frozen=True)
class Lake:
    """Table locations of one lake root (a shared folder on a cluster)."""
    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def tables(self) -> dict[str, str]:
        names = {"bronze": ["sites_raw", "solar_raw", "wind_raw"], "silver": ["production"],
                 "gold": ["daily_kpis", "daily_kpis_enriched", "site_efficiency_report"]}
        return {f"{layer}.{n}": self.table(layer, n) for layer, ns in names.items() for n in ns}


def _rebalanced(df: DataFrame, cols) -> DataFrame:
    return df.hint("rebalance", *cols)


def bronze_job(spark: SparkSession, landing: str, lake: Lake, batch_id: str | None = None
               ) -> dict[str, dict]:
    """Landing CSVs (``sites*.csv``, ``solar*.csv``, ``wind*.csv``) → bronze:
    data untouched, audit columns added; readings partitioned by year/month.
    Returns each readings table's quality metrics, observed during its write
    (measure, don't reject)."""
    bid = batch_id or bronze.batch_id_for()
    sites = read_csv(spark, landing, glob="sites*.csv")  # all strings, as landed
    versioned.write_version(bronze.with_audit(sites, source="sites.csv", batch_id=bid),
                            lake.table("bronze", "sites_raw"))
    metrics = {}
    for name, schema in (("solar", schemas.SOLAR_SCHEMA), ("wind", schemas.WIND_SCHEMA)):
        raw = read_csv(spark, landing, schema=schema, glob=f"{name}*.csv")
        df, obs = bronze.observe_quality(bronze.with_audit(raw, partition_from="timestamp", batch_id=bid),
                                         f"{name}_raw_quality_{bid}_{uuid.uuid4().hex[:8]}")
        versioned.write_version(_rebalanced(df, ["_year", "_month"]), lake.table("bronze", f"{name}_raw"),
                                partition_col=["_year", "_month"])
        metrics[f"{name}_raw"] = obs.get
    return metrics


def silver_frame(spark: SparkSession, lake: Lake, tiebreak=()) -> DataFrame:
    solar = read_layer(spark, lake.table("bronze", "solar_raw"))
    wind = read_layer(spark, lake.table("bronze", "wind_raw"))
    sites = read_layer(spark, lake.table("bronze", "sites_raw"))
    prod = silver.silver_production({"solar": solar, "wind": wind}, tiebreak=tiebreak)
    return silver.enrich_sites(prod, sites)


def silver_job(spark: SparkSession, lake: Lake, tiebreak=()) -> int:
    """Bronze → unified, cleaned, deduplicated, enriched silver facts as a new
    version of the versioned silver table (partitioned by date), which later
    MERGEs update in place. The constraints are enforced inside the write's
    own pass; a violation fails the job before the commit, so the previous
    version stays the readable one. Returns the version."""
    df = quality.expect(silver_frame(spark, lake, tiebreak), quality.silver_rules(), "enforce")
    # rows clustered by (site_id, timestamp) inside each date partition: the
    # parquet row-group min/max then skip row groups for site / time filters
    out = _rebalanced(df, ["date"]).sortWithinPartitions("date", "site_id", "timestamp")
    return versioned.write_version(out, lake.table("silver", "production"), "WRITE", partition_col="date")


def gold_job(spark: SparkSession, lake: Lake, computed_at=None, dates=None, source: str = "production") -> None:
    """Silver → daily KPIs (by date), enriched daily KPIs (by technology) and
    the monthly efficiency report (written in report order), each a new version
    of its table (readers keep the previous one until the commit). With
    ``dates`` only those days (None: the NULL day) of the daily table are
    aggregated anew, from a partition-pruned read of silver; the other days are
    copied, and the two small derived tables are rebuilt. ``source``: the silver
    table (``production_live`` after :func:`live_silver_job`)."""
    now = computed_at if computed_at is not None else F.current_timestamp()
    prod = read_layer(spark, lake.table("silver", source))
    daily_path = lake.table("gold", "daily_kpis")
    if dates is not None and versioned.latest_version(spark, daily_path) is not None:
        days = [dt.date.fromisoformat(str(d)) for d in dates if d is not None]
        hit = F.coalesce(F.col("date").isin(days), F.lit(None in dates))
        part = gold.daily_kpis(prod.filter(hit), computed_at=now)
        rest = versioned.read_version(spark, daily_path).filter(~hit)
        versioned.write_version(_rebalanced(rest.select(*part.columns).unionByName(part), ["date"]), daily_path, "UPDATE",
                                partition_col="date", touched=dates)
    else:
        versioned.write_version(gold.daily_kpis(prod, computed_at=now), daily_path, partition_col="date")
    daily = read_layer(spark, daily_path)
    enriched = _rebalanced(gold.enrich_daily(daily), ["technology"]).sortWithinPartitions(
        "technology", "date", "site_id")
    versioned.write_version(enriched, lake.table("gold", "daily_kpis_enriched"), partition_col="technology")
    report = gold.site_efficiency_report(daily.drop("computed_at"), computed_at=now)
    order = gold.report_order(report)
    versioned.write_version(report.repartitionByRange(*order).sortWithinPartitions(*order),
                            lake.table("gold", "site_efficiency_report"))


def touched_since(spark: SparkSession, path: str, after_version: int | None) -> list[str | None] | None:
    """Partition values that the versions after ``after_version`` have changed:
    an empty list when there is none, None when any value may have changed."""
    log = versioned.commits(spark, path)
    if after_version is not None:
        log = log.filter(F.col("version") > after_version)
    if log.filter("touched is null").limit(1).count():
        return None
    values = log.select(F.explode("touched").alias("v")).distinct().collect()  # dates
    return sorted((r["v"] for r in values), key=lambda v: (v is None, v))


def run_all(spark: SparkSession, landing: str, lake: Lake) -> dict[str, str]:
    bronze_job(spark, landing, lake)
    silver_job(spark, lake)
    gold_job(spark, lake)
    return lake.tables()


def incremental_silver_job(spark: SparkSession, landing: str, lake: Lake,
                           checkpoint_root: str | None = None, timeout_s: float | None = None) -> int | None:
    """New landing files → silver, incrementally: one availableNow stream per
    technology (``solar*.csv``, ``wind*.csv``, each with its own checkpoint),
    whose micro-batches are cleaned, deduplicated, enriched from the bronze
    site table and merged into the versioned silver table by the batch job's
    keep-best rule (no deletes: a batch carries only new data). The streams run one after the other, so the table
    has one writer at a time. Returns the latest silver version."""
    from kilowatt.streaming.ingest import stream_csv
    from kilowatt.streaming.upsert import version_stream

    ckpt = (checkpoint_root or f"{lake.root.rstrip('/')}/_checkpoints").rstrip("/")
    sites = read_layer(spark, lake.table("bronze", "sites_raw"))
    target = lake.table("silver", "production")
    for tech, schema in (("solar", schemas.SOLAR_SCHEMA), ("wind", schemas.WIND_SCHEMA)):
        spec = silver.SPECS[tech]

        def to_silver(batch, spec=spec):
            return silver.enrich_sites(silver.silver_technology(batch, spec), sites)

        version_stream(stream_csv(spark, landing, schema, glob=f"{tech}*.csv"), target,
                       f"{ckpt}/silver_{tech}", to_silver, timeout_s=timeout_s)
    return versioned.latest_version(spark, target)


LIVE = "production_live"


def live_silver_job(spark: SparkSession, landing: str, lake: Lake, checkpoint_root: str | None = None,
                    timeout_s: float | None = None) -> list:
    """As :func:`incremental_silver_job`, but in place: the table
    ``silver/production_live`` (partitioned by date, no history) gets new landing
    files at the cost of the dates they touch. At its first run it starts from
    the latest version of the silver table, if there is one. Returns the
    touched dates (None: rows without a date), for :func:`gold_job`."""
    from kilowatt.sinks import partitioned
    from kilowatt.streaming.ingest import stream_csv
    from kilowatt.streaming.upsert import upsert_stream

    ckpt = (checkpoint_root or f"{lake.root.rstrip('/')}/_checkpoints").rstrip("/")
    sites = read_layer(spark, lake.table("bronze", "sites_raw"))
    live, batch = lake.table("silver", LIVE), lake.table("silver", "production")
    if not path_exists(spark, f"{live}/_SUCCESS") and versioned.latest_version(spark, batch) is not None:
        partitioned.write_partitions(versioned.read_version(spark, batch), live)
    touched: set = set()
    for tech, schema in (("solar", schemas.SOLAR_SCHEMA), ("wind", schemas.WIND_SCHEMA)):
        spec = silver.SPECS[tech]

        def to_silver(batch, spec=spec):
            return silver.enrich_sites(silver.silver_technology(batch, spec), sites)

        touched.update(upsert_stream(stream_csv(spark, landing, schema, glob=f"{tech}*.csv"), live, f"{ckpt}/live_{tech}", to_silver,
                                     timeout_s=timeout_s, announce=lambda dates: _announce(lake, dates)))
    return sorted(touched, key=lambda v: (v is None, str(v)))


def _todo(lake: Lake) -> str:
    return lake.table("gold", "_todo")


def _announce(lake: Lake, dates: DataFrame) -> None:
    """Notes the dates that gold has to look at, before silver changes."""
    dates.coalesce(1).write.parquet(f"{_todo(lake)}/{uuid.uuid4().hex[:12]}")


LIVE_GOLD = {"daily": "daily_kpis_live", "enriched": "daily_kpis_enriched_live", "state": "report_state_live", "report": "site_efficiency_report_live"}


def live_gold_job(spark: SparkSession, lake: Lake) -> list:
    """Gold after :func:`live_silver_job`, in place and in proportion to the change:
    the noted days of the daily table are aggregated anew, the windows of the
    enriched table over the rows these reach, the report from the state of their
    months. The first run builds all four tables. Returns the days it looked at.

    Every step recomputes what it writes from silver and the daily table as it
    was, the daily table is replaced last, and the notes go after that: a job
    lost anywhere is done again by the next one, with the same result."""
    from kilowatt.operators import incremental
    from kilowatt.session import list_folder, remove_folder
    from kilowatt.sinks.partitioned import finish_pending, in_values, read_partitions, replace_partitions, write_partitions

    path = {k: lake.table("gold", t) for k, t in LIVE_GOLD.items()}
    notes = list_folder(spark, _todo(lake)) if path_exists(spark, _todo(lake)) else []
    closed = [n for n in notes if path_exists(spark, f"{n}/_SUCCESS")]
    silver_rows = spark.read.parquet(lake.table("silver", LIVE))
    if not path_exists(spark, f"{path['daily']}/_SUCCESS"):
        full = stored(gold.daily_kpis(silver_rows), "daily")
        write_partitions(gold.enrich_daily(full), path["enriched"])
        state = stored(incremental.report_state(full), "state")
        write_partitions(state, path["state"], "month_label")
        write_partitions(incremental.report_from_state(state), path["report"], "month_label")
        write_partitions(full, path["daily"])
        dates = versioned.touched_values(full, "date")
    else:
        dates = versioned.touched_values(spark.read.schema("date date").parquet(*closed), "date") if closed else []
        if dates:
            for k in path:
                finish_pending(spark, path[k], "date" if k in ("daily", "enriched") else "month_label")
            after = stored(gold.daily_kpis(silver_rows.filter(in_values("date", dates))), "daily_after")
            daily_rows = read_partitions(spark, path["daily"], after.schema)
            before = daily_rows.filter(in_values("date", dates))
            now = daily_rows.filter(~in_values("date", dates)).unionByName(after)
            changed = stored(incremental.changed_days(before, after), "changed")

            enriched = spark.read.schema(gold.enrich_daily(after).schema).parquet(path["enriched"])
            rows, days = incremental.refreshed_enriched(enriched, now, changed, dates)
            days = versioned.touched_values(days, "date")
            replace_partitions(rows, path["enriched"], enriched.filter(in_values("date", days)))

            months = versioned.touched_values(before.unionByName(after).select(F.date_format("date", "yyyy-MM").alias("m")), "m")
            state = incremental.report_state(now.filter(F.coalesce(F.date_format("date", "yyyy-MM").isin([m for m in months if m]), F.lit(None in months))))
            for k, new in (("state", state), ("report", incremental.report_from_state(state))):
                old = spark.read.schema(new.schema).parquet(path[k]).filter(in_values("month_label", months))
                replace_partitions(new, path[k], old, "month_label")
            replace_partitions(after, path["daily"], before)
    for n in closed:
        remove_folder(spark, n)
    return dates
