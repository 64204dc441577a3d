"""Registered queries: each takes ``(spark, sf_dir)``, reads the test tables
(through :mod:`kilowatt.fixtures`) and returns a lazy DataFrame."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatt import fixtures as fx
from kilowatt import schemas
from kilowatt.functions.expressions import exact
from kilowatt.operators import anomaly, bronze, gold, incremental, layout, merge, quality, ranking, silver, timescale
from kilowatt.operators.bronze import with_audit
from kilowatt.plans import medallion
from kilowatt.session import scratch_path, stored
from kilowatt.sinks import catalog, layers, partitioned, versioned
from kilowatt.sources import checked, files
from kilowatt.sources.files import read_table
from kilowatt.streaming import dedup, drift, evolve, ingest, profile
from kilowatt.streaming import rollup as srollup
from kilowatt.streaming import upsert as supsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- silver

def production(spark: SparkSession, sf: str) -> DataFrame:
    """Unified silver facts from the two bronze-shaped fixture tables."""
    return silver.silver_production(fx.raw_sources(spark, sf), tiebreak=["event_id"])


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_kpis(production(spark, sf), fx.sites(spark, sf))


@register("clean_readings")
def q_clean_readings(spark, sf):
    r = silver.clean_readings(fx.readings(spark, sf), ["production_kwh", "sensor_2"])
    return r.withColumn("is_production", F.col("production_kwh") > 0)


@register("dedup_keep_best")
def q_dedup_keep_best(spark, sf):
    r = silver.clean_readings(fx.readings(spark, sf), ["production_kwh"])
    r = r.select("event_id", "timestamp", "site_id", "technology", "production_kwh", "status")
    return silver.dedup_keep_best(r, ["technology", "timestamp", "site_id"], "production_kwh",
                                  ["event_id"])


@register("dedup_distinct")
def q_dedup_distinct(spark, sf):
    r = fx.readings(spark, sf).select("site_id", "timestamp", "technology", "status")
    return silver.drop_exact_duplicates(r)


@register("unify_production")
def q_unify_production(spark, sf):
    return production(spark, sf)


@register("enrich_sites")
def q_enrich_sites(spark, sf):
    return silver.enrich_sites(production(spark, sf), fx.sites(spark, sf))


@register("validation_profile")
def q_validation_profile(spark, sf):
    return silver.validation_profile(production(spark, sf)).orderBy("technology")


@register("bronze_profile")
def q_bronze_profile(spark, sf):
    return bronze.quality_profile({f"{k}_raw": df for k, df in fx.raw_sources(spark, sf).items()})


# ---------------------------------------------------------------- gold

@register("daily_kpis")
def q_daily_kpis(spark, sf):
    return daily(spark, sf)


@register("daily_kpis_top20")
def q_daily_kpis_top20(spark, sf):
    return gold.top_days(daily(spark, sf), 20)


@register("daily_kpis_enriched")
def q_daily_kpis_enriched(spark, sf):
    return gold.enrich_daily(daily(spark, sf))


@register("daily_kpis_calendar")
def q_daily_kpis_calendar(spark, sf):
    """Day-over-day and 7-day average on calendar days (gaps respected)."""
    return gold.enrich_daily(daily(spark, sf), calendar=True)


@register("daily_rank_bucketed")
def q_daily_rank_bucketed(spark, sf):
    """Daily KPIs enriched with the skew-safe (range-bucketed) daily rank."""
    return gold.enrich_daily(daily(spark, sf), rank_strategy="bucketed")


@register("site_efficiency_report")
def q_site_efficiency_report(spark, sf):
    return gold.site_efficiency_report(daily(spark, sf))


def _before_change(days: DataFrame) -> DataFrame:
    """The daily table before a change that leads to ``days``: on two days every
    third site lacks its row, others have other figures, and sites that have no
    row there have one too many."""
    hit = F.col("date").isin([_dt.date(2024, 1, 9), _dt.date(2024, 1, 24)])
    other = days.filter(hit & (F.col("site_id") % 3 != 0)).withColumns({
        "total_production_mwh": F.when(F.col("site_id") % 3 == 1, F.col("total_production_mwh") + F.lit(2.5)).otherwise(F.col("total_production_mwh")),
        "hours_offline": F.when(F.col("site_id") % 3 == 1, F.col("hours_offline") + 3).otherwise(F.col("hours_offline")),
        "availability_pct": F.when(F.col("site_id") % 3 == 1, F.lit(12.5)).otherwise(F.col("availability_pct"))})
    surplus = days.filter((F.col("date") == _dt.date(2024, 1, 8)) & (F.col("site_id") % 2 == 0)).withColumn("date", F.date_add("date", 1))
    surplus = surplus.join(days.filter(hit).select("date", "site_id", "technology"), ["date", "site_id", "technology"], "left_anti").select(*days.columns)
    return days.filter(~hit).unionByName(other).unionByName(surplus)


CHANGED_DATES = (_dt.date(2024, 1, 9), _dt.date(2024, 1, 24))


@register("enriched_incremental")
def q_enriched_incremental(spark, sf):
    """The enriched daily table after inserts, updates and deletes on two days:
    windows are recomputed over the rows these reach, ranks on these days."""
    after = stored(daily(spark, sf), "daily")
    before = stored(_before_change(after), "daily_before")
    table = stored(gold.enrich_daily(before), "enriched_before")
    on = F.col("date").isin(list(CHANGED_DATES))
    changed = incremental.changed_days(before.filter(on), after.filter(on))
    return incremental.enriched_incremental(table, after, changed, CHANGED_DATES)


@register("report_incremental")
def q_report_incremental(spark, sf):
    """The monthly report from a state of sums and counts, refreshed from the
    rows that the same change took away and added."""
    after = stored(daily(spark, sf), "daily")
    before = stored(_before_change(after), "daily_before")
    state = stored(incremental.report_state(before), "state")
    on = F.col("date").isin(list(CHANGED_DATES))
    change = incremental.changed_state(before.filter(on), after.filter(on))
    return incremental.report_from_state(incremental.merged_state(state, change))


def anomaly_input(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series with odd sites flipped (500 − MWh) so both tails occur."""
    d = gold.daily_production(production(spark, sf))
    flipped = (F.lit(500).cast("decimal(18,4)") - F.col("total_production_mwh").cast("decimal(18,4)")).cast("double")
    return d.select("date", "site_id", "technology",
                    F.when(F.col("site_id") % 2 == 1, flipped)
                    .otherwise(F.col("total_production_mwh")).alias("total_production_mwh"))


@register("detect_anomalies")
def q_detect_anomalies(spark, sf):
    return anomaly.detect_anomalies(anomaly_input(spark, sf))


# ---------------------------------------------------------------- quality


def reading_rules():
    return {**quality.silver_rules(),
            "chk_irradiance_positive": F.col("sensor_2").isNull() | (F.col("sensor_2") >= 0)}


@register("expect_quarantine")
def q_expect_quarantine(spark, sf):
    _, bad = quality.expect(fx.readings(spark, sf), reading_rules(), "quarantine")
    return bad


@register("expect_report")
def q_expect_report(spark, sf):
    return quality.expect(fx.readings(spark, sf), reading_rules(), "report")


@register("not_null_report")
def q_not_null_report(spark, sf):
    """NOT NULL rules over silver: the cleaning turns negative productions and
    irradiances into NULLs, and wind has no efficiency."""
    rules = {f"nn_{c}": F.col(c).isNotNull() for c in ("site_id", "production_kwh", "sensor_metric_2", "efficiency_pct")}
    return quality.expect(production(spark, sf), rules, "report")


# ---------------------------------------------------------------- merge / versions


MERGE_AS_OF = _dt.date(2024, 1, 30)
MERGE_COLUMNS = ["timestamp", "site_id", "technology", "production_kwh", "status", "date", "hour"]


def merge_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(target, source): target before 2024-01-27; source from 2024-01-20 with
    +1 kWh on every 7th site and some keys missing."""
    base = production(spark, sf).select(*MERGE_COLUMNS)
    target = base.filter(F.col("date") < F.lit("2024-01-27").cast("date"))
    source = (base.filter(F.col("date") >= F.lit("2024-01-20").cast("date"))
              .filter((F.col("site_id") + F.col("hour")) % 11 != 0)
              .withColumn("production_kwh",
                          F.when(F.col("site_id") % 7 == 0, F.col("production_kwh") + 1)
                          .otherwise(F.col("production_kwh"))))
    return target, source


@register("merge_upsert")
def q_merge_upsert(spark, sf):
    target, source = merge_pair(spark, sf)
    return merge.merge_upsert(target, source, as_of=MERGE_AS_OF)


@register("merge_upsert_pruned")
def q_merge_upsert_pruned(spark, sf):
    """Only target rows of the source's dates (which the caller names) and of
    the delete window go through the full outer join."""
    target, source = merge_pair(spark, sf)
    return merge.merge_upsert(target, source, as_of=MERGE_AS_OF, touched=versioned.touched_values(source, "date"))


@register("merge_null_keys")
def q_merge_null_keys(spark, sf):
    """MERGE into a versioned table where sites and dates are NULL on both
    sides: no such row is lost or matched."""
    base = production(spark, sf).select(*MERGE_COLUMNS).withColumns({
        "site_id": F.when(F.col("hour") != 3, F.col("site_id")), "date": F.when(F.col("hour") != 5, F.col("date"))})
    target = base.filter("date is null or date < date'2024-01-27'")
    source = base.filter("date is null or date >= date'2024-01-20'").withColumn(
        "production_kwh", F.when(F.col("hour") % 2 == 0, F.col("production_kwh") + 1).otherwise(F.col("production_kwh")))
    path = scratch_path(spark, "versioned")
    versioned.write_version(target, path, partition_col="date")
    versioned.merge_into(path, source, as_of=MERGE_AS_OF)
    return versioned.read_version(spark, path).select(*MERGE_COLUMNS)


@register("merge_partitions")
def q_merge_partitions(spark, sf):
    """MERGE in place: only the partitions of the source's dates and of the
    delete window are written again."""
    path = scratch_path(spark, "partitioned")
    target, source = merge_pair(spark, sf)
    partitioned.write_partitions(target, path)
    partitioned.merge_partitions(path, source, as_of=MERGE_AS_OF)
    return partitioned.read_partitions(spark, path, target.schema).select(*MERGE_COLUMNS)


@register("merge_partitions_report")
def q_merge_partitions_report(spark, sf):
    """The rows per action in the partitions that the same merge wrote, and the
    partitions it left alone, told by their files' names."""
    path = scratch_path(spark, "partitioned")
    target, source = merge_pair(spark, sf)
    partitioned.write_partitions(target, path)
    before = spark.read.parquet(path).select("date", F.col("_metadata.file_name").alias("file")).distinct()
    names = stored(before, "names")
    counts = partitioned.merge_partitions(path, source, as_of=MERGE_AS_OF)
    kept = spark.read.parquet(path).select("date", F.col("_metadata.file_name").alias("file")).distinct().join(names, ["date", "file"], "left_semi")
    return kept.agg(F.countDistinct("date").alias("partitions_untouched")).select(
        "partitions_untouched", *[F.lit(counts[a]).cast("bigint").alias(f"num_{a}") for a in versioned.ACTIONS])


def _versioned_merge(spark: SparkSession, sf: str) -> str:
    """Write the target as version 0, MERGE the source into it as version 1."""
    path = scratch_path(spark, "versioned")
    target, source = merge_pair(spark, sf)
    versioned.write_version(target, path, "WRITE", partition_col="date")
    versioned.merge_into(path, source, as_of=MERGE_AS_OF)
    return path


@register("version_read")
def q_version_read(spark, sf):
    """Version 0 read back after version 1 was committed (time travel)."""
    return versioned.read_version(spark, _versioned_merge(spark, sf), 0).select(*MERGE_COLUMNS)


@register("version_latest")
def q_version_latest(spark, sf):
    """Latest version: version 0 with the merged partitions of version 1."""
    return versioned.read_version(spark, _versioned_merge(spark, sf)).select(*MERGE_COLUMNS)


@register("history")
def q_history(spark, sf):
    h = versioned.history(spark, _versioned_merge(spark, sf))
    return h.drop("committed_at").orderBy(F.col("version").desc()).limit(3)


# ---------------------------------------------------------------- ranking


def order_values(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderpriority",
                    F.round(F.col("o_totalprice") * 100).cast("bigint").alias("value"))


@register("rank_trio")
def q_rank_trio(spark, sf):
    """dense_rank / rank / row_number side by side within each priority. Five
    priorities share all orders, so each group is ranked in value ranges
    rather than by one task per priority."""
    return ranking.bucketed_rank(order_values(spark, sf), ["o_orderpriority"], "value", tiebreak=["o_orderkey"])


@register("global_rank")
def q_global_rank(spark, sf):
    """The same three ranks over the whole table, without a single task that
    sorts it."""
    return ranking.global_rank(order_values(spark, sf), "value", tiebreak=["o_orderkey"])


@register("daily_next_day")
def q_daily_next_day(spark, sf):
    return gold.next_day(daily(spark, sf)).select(
        "date", "site_id", "technology", "total_production_mwh", "next_day_total_production_mwh")


# ---------------------------------------------------------------- layout

@register("compact_layout")
def q_compact_layout(spark, sf):
    path = scratch_path(spark, "compact")
    layout.compact(read_table(spark, sf, "lineitem"), path, partition_cols=["l_returnflag"])
    return spark.read.parquet(path)


@register("zorder_layout")
def q_zorder_layout(spark, sf):
    path = scratch_path(spark, "zorder")
    layout.zorder_layout(read_table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"], path, files=8)
    return spark.read.parquet(path)


@register("sorted_write")
def q_sorted_write(spark, sf):
    path = scratch_path(spark, "sorted")
    layout.sorted_write(read_table(spark, sf, "lineitem"),
                        ["l_shipdate", "l_orderkey", "l_linenumber"], path, files=8)
    return spark.read.parquet(path)


@register("partition_profile")
def q_partition_profile(spark, sf):
    path = scratch_path(spark, "silver")
    production(spark, sf).write.partitionBy("technology", "date").parquet(path)
    return layout.partition_profile(spark.read.parquet(path), ["technology", "date"], ts="timestamp")


# ---------------------------------------------------------------- time scales, losses, scalars

def raw_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings at their original (sub-hour) event time."""
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("ts").alias("timestamp"), F.col("user_id").alias("site_id"),
                     F.when(F.col("user_id") % 2 == 0, "solar").otherwise("wind").alias("technology"),
                     (F.col("value") - 10).alias("production_kwh"))


@register("timescale_rollup")
def q_timescale_rollup(spark, sf):
    return timescale.multi_scale_rollup(raw_readings(spark, sf))


@register("energy_losses")
def q_energy_losses(spark, sf):
    return timescale.energy_losses(daily(spark, sf))


@register("rows_per_technology")
def q_rows_per_technology(spark, sf):
    return production(spark, sf).groupBy("technology").agg(F.count(F.lit(1)).alias("count"))


@register("predicates_scalars")
def q_predicates_scalars(spark, sf):
    """Filters (=, IN, IS NULL, comparisons, AND/OR) and the scalar functions
    of the reference over solar readings."""
    r = fx.readings(spark, sf)
    kwh = F.col("production_kwh")
    return (r.filter((F.col("technology") == "solar")
                     & (F.col("status").isin("OK", "OFFLINE") | kwh.isNull() | (kwh < 0)))
            .select("event_id", "site_id",
                    F.year("timestamp").alias("year"), F.month("timestamp").alias("month"),
                    F.hour("timestamp").alias("hour"), F.to_date("timestamp").alias("date"),
                    F.date_format("timestamp", "yyyy-MM").alias("month_label"),
                    F.abs(kwh).alias("abs_kwh"),
                    F.round(exact("production_kwh"), 1).cast("double").alias("kwh_1"),
                    F.nullif(F.col("sensor_2"), F.lit(0.0)).alias("sensor_2_nz"),
                    (kwh != 0).alias("nonzero"),
                    F.when(kwh >= 50, "high").when(kwh >= 0, "low").otherwise("negative").alias("band"),
                    F.date_sub(F.to_date("timestamp"), 7).alias("week_before")))


# ---------------------------------------------------------------- files, CSV and streams


KINDS = {"solar": (fx.solar_raw, schemas.SOLAR_SCHEMA, "panel_temp_c", "irradiance_w_m2"),
         "wind": (fx.wind_raw, schemas.WIND_SCHEMA, "wind_speed_ms", "wind_direction_deg")}


def _land(spark: SparkSession, sf: str, kind: str, root: str, keep=None, parts: int | None = None) -> str:
    """Readings of one kind as CSV landing files (declared columns, string site
    ids) below ``root``/kind; ``keep``: a condition on the rows of this drop;
    ``parts``: in so many files."""
    raw, schema, *_ = KINDS[kind]
    df = raw(spark, sf) if keep is None else raw(spark, sf).filter(keep)
    df = df.select(*[F.col(f.name).cast("string") if f.name == "site_id" else F.col(f.name) for f in schema.fields])
    return layers.write_csv(df.repartition(parts) if parts else df, f"{root}/{kind}", mode="append")


def _common(df: DataFrame, kind: str) -> DataFrame:
    """Both kinds in one shape, for comparing them together."""
    _, _, one, two = KINDS[kind]
    return df.select(F.lit(kind).alias("kind"), F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "site_id",
                     F.col(one).cast("double").alias("sensor_1"), F.col(two).cast("double").alias("sensor_2"),
                     F.col("production_kwh").cast("double").alias("production_kwh"), "status")


def _both(of_kind: Callable[[str], DataFrame]) -> DataFrame:
    return of_kind("solar").unionByName(of_kind("wind"))


def _bronze(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Landing CSV → declared-schema read → audit + partition columns →
    partitioned bronze write → read."""
    root = scratch_path(spark, "csv")
    raw = files.read_csv(spark, _land(spark, sf, kind, root), schema=KINDS[kind][1])
    bronze_df = with_audit(raw, partition_from="timestamp", batch_id="fixture")
    layers.write_layer(bronze_df, f"{root}/bronze", partition_by=["_year", "_month"])
    return spark.read.parquet(f"{root}/bronze")


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    """Landing CSV → bronze → read, the audit columns dropped."""
    return _both(lambda kind: _common(silver.drop_audit(_bronze(spark, sf, kind)), kind))


@register("bronze_audit")
def q_bronze_audit(spark, sf):
    """The audit columns by value: injected batch id, year and month of the
    reading, a source path below the landing folder, an ingest time."""
    def of_kind(kind):
        return _bronze(spark, sf, kind).groupBy(
            F.lit(kind).alias("kind"), F.col("_batch_id").alias("batch_id"), F.col("_year").alias("year"), F.col("_month").alias("month"),
            F.col("_source_file").rlike(f"/{kind}/part-[^/]*[.]csv$").alias("source_named"),
            F.col("_ingested_at").isNotNull().alias("ingested")).agg(F.count(F.lit(1)).alias("num_rows"))
    return _both(of_kind)


@register("csv_all_strings")
def q_csv_all_strings(spark, sf):
    """Header-only CSV read (no schema, no inference): every column a string,
    whose text casts back to the value that was written."""
    root = scratch_path(spark, "csv")

    def of_kind(kind):
        df = files.read_csv(spark, _land(spark, sf, kind, root))
        return _common(df, kind).withColumn("all_strings", F.lit(all(t == "string" for _, t in df.dtypes)))
    return _both(of_kind)


@register("csv_inferred")
def q_csv_inferred(spark, sf):
    """CSV read with type inference (an extra pass over the input)."""
    root = scratch_path(spark, "csv")
    return _both(lambda kind: _common(files.read_csv(spark, _land(spark, sf, kind, root), infer=True), kind))


def _land_lines(spark: SparkSession, sf: str, kind: str, root: str) -> str:
    """Readings of one kind as headerless text lines, some of them broken: no
    number, no time, too few or too many fields, no site, no whole direction."""
    raw, schema, one, two = KINDS[kind]
    e = F.col("event_id")
    text = {f.name: F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields}
    text["production_kwh"] = F.when(e % 17 == 0, "n/a").otherwise(text["production_kwh"])
    text["timestamp"] = F.when(e % 19 == 0, "some day").otherwise(text["timestamp"])
    text["site_id"] = F.when(e % 31 == 0, "").otherwise(text["site_id"])
    text[two] = F.when(e % 37 == 0, "1e").otherwise(text[two])
    fields = list(text.values())
    line = F.when(e % 23 == 0, F.concat_ws(",", *fields[:-2])).when(e % 29 == 0, F.concat_ws(",", *fields, F.lit("more"))).otherwise(F.concat_ws(",", *fields))
    raw(spark, sf).select(line.alias("value")).write.text(f"{root}/{kind}")
    return f"{root}/{kind}"


@register("csv_bad_records")
def q_csv_bad_records(spark, sf):
    """Solar lines read as a batch, wind lines as a stream; good and bad records
    are written in one pass and read apart: rows per reason (NULL: accepted),
    the accepted production, and whether each bad record kept its line."""
    root = scratch_path(spark, "checked")

    def of_kind(kind):
        schema, required = KINDS[kind][1], ["timestamp", "site_id"]
        folder, target = _land_lines(spark, sf, kind, root), f"{root}/{kind}_bronze"
        if kind == "solar":
            checked.write_checked(checked.read_checked(spark, folder, schema, required, header=False), target)
        else:
            stream = checked.stream_checked(spark, folder, schema, required, glob="*.txt", header=False)
            ingest.run_incremental(stream, target, f"{root}/{kind}_checkpoint", partition_by=[checked.REJECTED])
        good, bad = checked.accepted(spark, target, schema), checked.rejected(spark, target, schema)
        kwh = F.round(F.sum(exact("production_kwh")), 2).cast("double")
        return good.select(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("reason"), "production_kwh", F.lit(None).cast("string").alias("raw")).unionByName(
            bad.select(F.lit(kind).alias("kind"), F.col(checked.REASON).alias("reason"), F.lit(None).cast("double").alias("production_kwh"),
                       F.col(checked.RAW).alias("raw"))).groupBy("kind", "reason").agg(
            F.count(F.lit(1)).alias("num_rows"), kwh.alias("accepted_kwh"), F.count("raw").alias("num_raw"))
    return _both(of_kind)


@register("stream_schema_change")
def q_stream_schema_change(spark, sf):
    """Three drops of solar files into one table: the declared columns; the same
    in another order with a new one; one column less and some productions that
    are no numbers. Every record is there once, bad ones with their reason."""
    root = scratch_path(spark, "changing")
    landing, target, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint"
    rows = fx.solar_raw(spark, sf).withColumns({"site_id": F.col("site_id").cast("string"), "kwh": F.col("production_kwh").cast("string")})
    names = [f.name for f in schemas.SOLAR_SCHEMA]
    third = F.col("event_id") % 3
    drops = [rows.filter(third == 0).select(*names),
             rows.filter(third == 1).withColumn("firmware", F.concat(F.lit("v"), F.col("event_id") % 4)).select("firmware", *reversed(names)),
             rows.filter(third == 2).withColumn("production_kwh", F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("kwh"))).select(
                 *[c for c in names if c != "panel_temp_c"])]
    for drop in drops:
        layers.write_csv(drop, landing, mode="append")
        evolve.ingest_changing(spark, landing, schemas.SOLAR_SCHEMA, target, ckpt, required=["timestamp", "site_id"])
    evolve.ingest_changing(spark, landing, schemas.SOLAR_SCHEMA, target, ckpt, required=["timestamp", "site_id"])  # nothing new
    return evolve.read_changing(spark, target, ckpt).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "site_id", "panel_temp_c", "irradiance_w_m2", "production_kwh", "status", "firmware",
        F.col(checked.REJECTED).alias("rejected"), F.col(checked.REASON).alias("reason"))


def _ingested(spark: SparkSession, sf: str, kind: str) -> tuple[DataFrame, dict[str, int]]:
    """Two arrivals of landing files drained by three incremental runs; the
    bronze table and the quality counts summed over the runs."""
    root = scratch_path(spark, "stream")
    landing, target, ckpt = f"{root}/{kind}", f"{root}/bronze", f"{root}/_checkpoint"
    late = F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz")
    totals: dict[str, int] = {}
    for keep in (~late, late, None):
        if keep is not None:
            _land(spark, sf, kind, root, keep)
        for k, v in ingest.ingest_stream(spark, landing, KINDS[kind][1], target, ckpt).items():
            totals[k] = totals.get(k, 0) + v
    return spark.read.parquet(target), totals


@register("stream_ingest")
def q_stream_ingest(spark, sf):
    """Every row lands exactly once (the third run finds nothing new)."""
    return _both(lambda kind: _common(silver.drop_audit(_ingested(spark, sf, kind)[0]), kind))


@register("stream_quality")
def q_stream_quality(spark, sf):
    """All seven figures of the bronze profile, kept per micro-batch over three
    drops that share sites (their distinct number from bitmaps)."""
    def of_kind(kind):
        root = scratch_path(spark, "profiled")
        late, odd = F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"), F.col("event_id") % 2 == 1
        for keep in (~late, late & odd, late & ~odd, None):
            if keep is not None:
                _land(spark, sf, kind, root, keep)
            found = profile.ingest_profiled(spark, f"{root}/{kind}", KINDS[kind][1], f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_profile")
        return found.withColumn("kind", F.lit(kind))
    return _both(of_kind)


@register("stream_observed")
def q_stream_observed(spark, sf):
    """The quality counts that the ingest's own pass observes, over all batches."""
    rows = [(kind, *(_ingested(spark, sf, kind)[1][m] for m in ingest.QUALITY_METRICS)) for kind in KINDS]
    return spark.createDataFrame(rows, "kind string, " + ", ".join(f"{m} long" for m in ingest.QUALITY_METRICS))


@register("file_inventory")
def q_file_inventory(spark, sf):
    """What the inventory says about eight landing files per kind: their sizes
    add up to the bytes of their lines, and their rows (without the headers) to
    the rows that were landed."""
    root = scratch_path(spark, "csv")

    def of_kind(kind):
        folder = _land(spark, sf, kind, root, parts=8)
        found = files.file_inventory(spark, folder, glob="*.csv").agg(
            F.count(F.lit(1)).alias("num_files"), F.sum("size_bytes").alias("bytes"),
            F.every(F.col("name").rlike("^part-.*[.]csv$")).alias("names_match"), F.every(F.col("size_bytes") > 0).alias("sizes_positive"))
        lines = spark.read.text(folder).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value") + 1).alias("line_bytes"))
        return found.join(lines).select(  # one row each
            F.lit(kind).alias("kind"), "num_files", (F.col("lines") - F.col("num_files")).alias("num_rows"),
            (F.col("bytes") == F.col("line_bytes")).alias("sizes_add_up"), "names_match", "sizes_positive")
    return _both(of_kind)


@register("view_sql")
def q_view_sql(spark, sf):
    """CREATE OR REPLACE twice (the second has other columns), a view over the
    table, and SQL over the view."""
    path = scratch_path(spark, "ctas")
    layers.create_or_replace(production(spark, sf).select("timestamp", "site_id"), path)
    layers.create_or_replace(production(spark, sf).select("technology", "status", "production_kwh"), path, ["technology"])
    layers.register_view(layers.read_layer(spark, path), "kilowatt_readings")
    return spark.sql("""
        SELECT technology, COUNT(*) AS num_rows, CAST(ROUND(SUM(TRY_CAST(production_kwh AS DECIMAL(38,12))), 2) AS DOUBLE) AS total_kwh
        FROM kilowatt_readings WHERE status = 'OK' GROUP BY technology""")


def _database(spark: SparkSession) -> str:
    """A database of the session's catalog with its files in the scratch folder."""
    where = scratch_path(spark, "database")
    name = f"kilowatt_{where.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{where}'")
    return name


@register("catalog_tables")
def q_catalog_tables(spark, sf):
    """Silver and gold as catalog tables: created with comment, properties and
    partitions (gold in the place of a table with other columns), read by name
    and listed from the catalog."""
    db = _database(spark)
    catalog.create_or_replace_table(production(spark, sf), f"{db}.production", ["date"], "Unified readings of solar and wind sites",
                                    {"quality": "silver", "team": "energy"})
    catalog.create_or_replace_table(production(spark, sf).select("site_id"), f"{db}.daily_kpis", comment="a first draft")
    daily_table = gold.daily_kpis(spark.table(f"{db}.production"), fx.sites(spark, sf))
    catalog.create_or_replace_table(daily_table, f"{db}.daily_kpis", ["technology"], "Daily production KPIs per site",
                                    {"quality": "gold", "delta.tuned": "no"}, {"total_production_mwh": "MWh"})
    listed = catalog.catalog_inventory(spark, db).select("table_name", "comment", "num_rows", "num_columns")
    rows = []
    for t in ("production", "daily_kpis"):
        d = catalog.table_details(spark, f"{db}.{t}")
        rows.append((t, d["properties"]["quality"], ",".join(d["partition_by"]), len(d["column_comments"])))
    details = spark.createDataFrame(rows, "table_name string, quality string, partitions string, commented_columns bigint")
    totals = spark.table(f"{db}.production").agg(F.lit("production").alias("table_name"), F.sum(exact("production_kwh")).alias("total")).unionByName(
        spark.table(f"{db}.daily_kpis").agg(F.lit("daily_kpis").alias("table_name"), F.sum(exact("total_production_mwh")).alias("total")))
    return listed.join(details, "table_name").join(totals, "table_name").withColumn("total", F.round("total", 2).cast("double"))


@register("merge_catalog")
def q_merge_catalog(spark, sf):
    """MERGE in place into a catalog table partitioned by date."""
    name = f"{_database(spark)}.readings"
    target, source = merge_pair(spark, sf)
    catalog.create_or_replace_table(target, name, ["date"])
    catalog.merge_table(name, source, as_of=MERGE_AS_OF)
    return spark.table(name).select(*MERGE_COLUMNS)


@register("merge_bucketed")
def q_merge_bucketed(spark, sf):
    """MERGE over a catalog table bucketed by the reading key: only the source
    is shuffled."""
    name = f"{_database(spark)}.readings"
    target, source = merge_pair(spark, sf)
    catalog.create_or_replace_table(target, name, buckets=(8, merge.READING_KEYS))
    return catalog.bucketed_merge(name, source, as_of=MERGE_AS_OF)


@register("daily_kpis_stamped")
def q_daily_kpis_stamped(spark, sf):
    """Daily KPIs with an injected ``computed_at``."""
    at = F.lit("2024-02-01 06:00:00").cast("timestamp_ntz")
    return gold.daily_kpis(production(spark, sf), fx.sites(spark, sf), computed_at=at)


@register("report_ordered_whole")
def q_report_ordered_whole(spark, sf):
    """The whole monthly report in its presentation order, all columns."""
    report = gold.site_efficiency_report(daily(spark, sf))
    return report.orderBy(*gold.report_order(report))


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table replayed as a file stream."""
    ev = read_table(spark, sf, "events")
    return (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
            .option("pathGlobFilter", "events.parquet").parquet(sf))


def _raw_readings_of(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("ts").alias("timestamp"), F.col("user_id").alias("site_id"),
                     F.when(F.col("user_id") % 2 == 0, "solar").otherwise("wind").alias("technology"),
                     (F.col("value") - 10).alias("production_kwh"))


def _drain(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    root = scratch_path(spark, name)
    ingest.run_incremental(df, f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out")


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    """Distinct readings from six drops of six days each that overlap by one: a
    row that comes again within two days is dropped, in whichever run it comes."""
    root = scratch_path(spark, "dedup")
    rows = fx.readings(spark, sf).select("site_id", "timestamp", "technology", "status")
    day = F.datediff(F.to_date("timestamp"), F.lit("2024-01-01").cast("date"))
    first = rows.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    for start in range(first["a"], first["b"] + 1, 5):
        rows.filter((day >= start) & (day < start + 6)).write.mode("append").parquet(f"{root}/in")
        stream = dedup.drop_repeats(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), rows.columns, "2 days")
        ingest.run_incremental(stream, f"{root}/out", f"{root}/_checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@register("stream_rollup")
def q_stream_rollup(spark, sf):
    """Hourly event-time windows per site from a stream with a 10-minute
    watermark; only windows closed by the watermark are emitted."""
    s = srollup.windowed_rollup(_raw_readings_of(_events_stream(spark, sf)), "1 hour", "10 minutes")
    return _drain(s, spark, "stream_rollup")


@register("stream_multiscale")
def q_stream_multiscale(spark, sf):
    """Minutes, hours and days from one stream; windows closed by the watermark."""
    return _drain(srollup.multi_scale_stream(_raw_readings_of(_events_stream(spark, sf))), spark, "multiscale")


DRIFT_SPLIT = "2024-01-20"


@register("drift_alerts")
def q_drift_alerts(spark, sf):
    """Daily production per site from the event stream (from 2024-01-20),
    labelled against each site's baseline from the batch daily KPIs before it."""
    base = srollup.site_baseline(gold.daily_production(production(spark, sf))
                                 .filter(F.col("date") < F.lit(DRIFT_SPLIT).cast("date")))
    stream = _raw_readings_of(_events_stream(spark, sf)).filter(
        F.col("timestamp") >= F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))
    alerts = srollup.drift_alerts(srollup.daily_production_stream(stream), base)
    return _drain(alerts.select("date", "site_id", "production_mwh",
                                F.round("baseline_mean", 4).alias("baseline_mean"), "z_score",
                                "alert_level"), spark, "drift")


@register("drift_stateful")
def q_drift_stateful(spark, sf):
    """Daily production per site and technology arrives in three drops; each day
    is judged by the site's days before it, learned from batch to batch. After
    three days of silence a site starts anew."""
    root = scratch_path(spark, "drift_state")
    rows = stored(gold.daily_production(production(spark, sf)).filter("date is not null"), "daily")
    for n, (start, end) in enumerate((("1970-01-01", "2024-01-08"), ("2024-01-08", "2024-01-19"), ("2024-01-19", "9999-01-01"))):
        rows.filter((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date"))).write.mode("append").parquet(f"{root}/in")
        stream = drift.learned_drift(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), expiry_days=3)
        ingest.run_incremental(stream, f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out")


# ---------------------------------------------------------------- medallion end to end


def landing_files(spark: SparkSession, sf: str, root: str) -> str:
    """sites / solar / wind CSV landing files as the reference receives them."""
    s = fx.sites(spark, sf).select(*[F.col(c).cast("string") for c in
                                     ["site_id", "site_name", "region", "capacity_mw", "latitude", "longitude"]])
    layers.write_csv(s, f"{root}/sites")
    layers.write_csv(fx.solar_raw(spark, sf).drop("event_id").withColumn("site_id", F.col("site_id").cast("string")),
                     f"{root}/solar")
    layers.write_csv(fx.wind_raw(spark, sf).drop("event_id").withColumn("site_id", F.col("site_id").cast("string")),
                     f"{root}/wind")
    return root


def _landing_layout(spark: SparkSession, sf: str, root: str) -> str:
    """One landing folder whose file names tell the kinds apart."""
    landing_files(spark, sf, f"{root}/by_kind")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    flat = jvm.org.apache.hadoop.fs.Path(f"{root}/landing")
    fs = flat.getFileSystem(conf)
    fs.mkdirs(flat)
    for kind in ("sites", "solar", "wind"):
        src = jvm.org.apache.hadoop.fs.Path(f"{root}/by_kind/{kind}")
        for st in fs.listStatus(src):
            name = st.getPath().getName()
            if name.endswith(".csv"):
                fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(flat, f"{kind}_{name}"))
    return f"{root}/landing"


@register("layer_inventory")
def q_layer_inventory(spark, sf):
    """Run bronze → silver → gold over landing files, then list every table
    with its row and column counts."""
    root = scratch_path(spark, "lake")
    lake = medallion.Lake(f"{root}/lake")
    landing = _landing_layout(spark, sf, root)
    medallion.bronze_job(spark, landing, lake, batch_id="fixture")
    medallion.silver_job(spark, lake, tiebreak=["sensor_metric_1", "sensor_metric_2", "status"])
    medallion.gold_job(spark, lake)
    return layout.layer_inventory(spark, lake.tables()).drop("last_ingested_at", "last_altered")


@register("row_counts")
def q_row_counts(spark, sf):
    """Global row count and count of distinct rows of the readings, in one
    aggregate (a distinct count of the whole row as a struct; NULL fields
    compare equal, as in SELECT DISTINCT)."""
    cols = ["site_id", "timestamp", "technology", "status"]
    r = fx.readings(spark, sf).select(*cols)
    return r.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_distinct(F.struct(*cols)).alias("distinct_rows"))


@register("schema_evolution")
def q_schema_evolution(spark, sf):
    """Two appends to one table, the second with an extra column; the merged
    read shows NULL for it in the first batch's rows."""
    path = scratch_path(spark, "evolve")
    r = fx.readings(spark, sf)
    layers.append_layer(r.filter(F.col("technology") == "solar")
                        .select("event_id", "site_id", "production_kwh"), path)
    layers.append_layer(r.filter(F.col("technology") == "wind")
                        .select("event_id", "site_id", "production_kwh", "status"), path)
    return layers.read_layer(spark, path).select("event_id", "site_id", "production_kwh", "status")


@register("stream_upsert")
def q_stream_upsert(spark, sf):
    """Landing files of both kinds arrive in three drops that overlap in rows and
    dates, each drained by a stream per kind whose micro-batches are merged in
    place into one silver table partitioned by date (a last run finds nothing
    new). Whatever the order, the table ends as the batch job's silver."""
    root = scratch_path(spark, "stream_upsert")
    table = f"{root}/silver"

    def drain(kind: str) -> None:
        def to_silver(batch: DataFrame) -> DataFrame:
            b = batch.withColumns({"site_id": F.col("site_id").cast("bigint"), "timestamp": F.col("timestamp").cast("timestamp_ntz")})
            return silver.silver_technology(b, silver.SPECS[kind])

        supsert.upsert_stream(ingest.stream_csv(spark, f"{root}/{kind}", KINDS[kind][1]), table, f"{root}/_ckpt_{kind}", to_silver)

    e = F.col("event_id")
    for keep in (e % 3 == 0, e % 3 == 1, (e % 3 == 2) | (e % 5 == 0), None):
        for kind in KINDS:
            if keep is not None:
                _land(spark, sf, kind, root, keep)
            drain(kind)
    return spark.read.parquet(table).select(
        "timestamp", "site_id", "technology", "production_kwh", "status", "sensor_metric_1", "sensor_metric_2", "date", "hour")


@register("bronze_time_travel")
def q_bronze_time_travel(spark, sf):
    """Bronze ingested twice; per kind the row count AS OF version 0 and the
    number of committed versions (time travel and history on bronze)."""
    root = scratch_path(spark, "lake")
    lake = medallion.Lake(f"{root}/lake")
    landing = _landing_layout(spark, sf, root)
    medallion.bronze_job(spark, landing, lake, batch_id="first")
    medallion.bronze_job(spark, landing, lake, batch_id="second")

    def of_kind(kind):
        path = lake.table("bronze", f"{kind}_raw")
        n_versions = versioned.history(spark, path).count()  # a handful of commit rows
        return versioned.read_version(spark, path, 0).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows_v0"),
                                                          F.lit(n_versions).cast("bigint").alias("versions"))
    return _both(of_kind)
