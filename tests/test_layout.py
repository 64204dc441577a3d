from pyspark.sql import functions as F

from kilowatt.operators import layout
from kilowatt.session import scratch_path
from kilowatt.sources.files import read_table
from tests.conftest import SF_SMALL


def multiset(df):
    return sorted(tuple(r) for r in df.collect())


def test_layouts_keep_rows(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                                        "l_partkey", "l_shipdate", "l_returnflag")
    want = multiset(li)
    p1 = layout.compact(li, scratch_path(spark, "t-compact"), ["l_returnflag"])
    p2 = layout.zorder_layout(li, ["l_suppkey", "l_partkey"], scratch_path(spark, "t-z"), files=8)
    p3 = layout.sorted_write(li, ["l_shipdate"], scratch_path(spark, "t-sort"), files=4)
    for p in (p1, p2, p3):
        assert multiset(spark.read.parquet(p).select(*li.columns)) == want


def _files_touched(spark, path, cond):
    return spark.read.parquet(path).filter(cond).select(F.input_file_name()).distinct().count()


def test_zorder_skips_files(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    z = layout.zorder_layout(li, ["l_suppkey", "l_partkey"], scratch_path(spark, "t-z"), files=16)
    plain = scratch_path(spark, "t-plain")
    li.repartition(16).write.parquet(plain)
    for cond in (F.col("l_suppkey") == 7, F.col("l_partkey") == 123):
        assert _files_touched(spark, z, cond) < _files_touched(spark, plain, cond)


def test_sorted_write_orders_files(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    p = layout.sorted_write(li, ["l_orderkey"], scratch_path(spark, "t-sort"), files=4)
    ranges = (spark.read.parquet(p).groupBy(F.input_file_name().alias("f"))
              .agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi")).orderBy("lo").collect())
    assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))


def test_partition_profile_and_inventory(spark):
    df = spark.createDataFrame([("solar", 1), ("solar", 2), ("wind", 3)], "technology string, v int")
    p = scratch_path(spark, "t-inv")
    df.write.partitionBy("technology").parquet(p)
    prof = {r["technology"]: r["num_rows"] for r in layout.partition_profile(spark.read.parquet(p),
                                                                            ["technology"]).collect()}
    assert prof == {"solar": 2, "wind": 1}
    inv = layout.layer_inventory(spark, {"bronze.t": p}).collect()[0]
    assert (inv["layer"], inv["num_rows"], inv["num_columns"]) == ("bronze", 3, 2)


def test_zorder_on_prefixed_string_ids_skips_files(spark):
    df = spark.range(40_000).select(F.format_string("SITE-%06d", F.col("id") % 2000).alias("site_id"),
                                    (F.col("id") % 997).alias("hour_key"))
    z = layout.zorder_layout(df, ["site_id", "hour_key"], scratch_path(spark, "t-zs"), files=16)
    assert _files_touched(spark, z, F.col("site_id") == "SITE-000123") <= 8


def test_zorder_splits_few_distinct_values(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("a"), F.lit(1).alias("b"), "id")
    p = layout.zorder_layout(df, ["a", "b"], scratch_path(spark, "t-hot"), files=32)
    per_file = [r["count"] for r in spark.read.parquet(p).groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) >= 28 and max(per_file) < 3 * 30_000 / 32


def test_zorder_bits_follow_the_files():
    assert layout.z_bits(8, 2) == 8 and layout.z_bits(1 << 20, 2) == 12 and layout.z_bits(1 << 20, 4) == 8


def _per_file(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]


def test_ranges_follow_the_rows(spark):
    """Twice the table: twice the ranges, none larger."""
    wide = F.array(*[F.col("id") + i for i in range(3)])
    for rows in (20_000, 40_000):
        df = spark.range(rows).select("id", (F.col("id") * 7919 % 997).alias("k"), F.repeat(F.lit("x"), 100).alias("s"), wide.alias("v"))
        want = multiset(df)
        for p in (layout.zorder_layout(df, ["id", "k"], scratch_path(spark, "t-many"), files=2, range_bytes=200_000),
                  layout.sorted_write(df, [F.col("k").desc()], scratch_path(spark, "t-many"), files=2, range_bytes=200_000)):
            assert max(_per_file(spark, p)) < 2_500
            assert multiset(spark.read.parquet(p)) == want


def test_sorted_write_splits_a_hot_key(spark):
    df = spark.range(30_000).select(F.lit(1).alias("a"), "id", F.create_map(F.lit("m"), "id").alias("m"))
    p = layout.sorted_write(df, ["a"], scratch_path(spark, "t-hot-sort"), files=8)
    assert len(_per_file(spark, p)) == 8 and max(_per_file(spark, p)) < 2 * 30_000 / 8
    assert spark.read.parquet(p).select("id").distinct().count() == 30_000


def test_layouts_of_empty_and_null_tables(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, None)], "a long, s string")
    for rows in (df, df.limit(0)):
        for p in (layout.zorder_layout(rows, ["a"], scratch_path(spark, "t-null")), layout.sorted_write(rows, ["a"], scratch_path(spark, "t-null")),
                  layout.sorted_write(rows, ["a"], scratch_path(spark, "t-null"), files=3)):
            assert spark.read.schema(df.schema).parquet(p).count() == rows.count()
