"""Operators on inputs other than those of the registered keys."""

import pytest
from pyspark.sql import functions as F

from windowlens.operators import clean, features, labels, parse, quality, traffic
from windowlens.plans.frames import Frames
from windowlens.session import work_path
from windowlens.sources import dimension


def test_seeds_pick_different_windows(spark, small_dir):
    spine = Frames(spark, small_dir).spine("1 hour")
    picks = [{r["window_start"] for r in labels.pick_labels(spine, seed=s).where("is_anomalous = 1").collect()}
             for s in (42, 43, 7)]
    assert len({len(p) for p in picks}) == 1 and len(set(map(frozenset, picks))) == 3


@pytest.mark.parametrize("stride", [1, 10, 1024])
def test_strided_keys_are_sampled_evenly(spark, stride):
    ids = spark.range(5000).select((F.col("id") * stride).alias("k"))
    counts = [traffic.hash_sample(ids, "k", 0.3, seed=s).count() for s in (0, 1)]
    assert all(abs(c - 1500) < 150 for c in counts)
    assert traffic.hash_sample(ids, "k", 1.0).count() == 5000 and traffic.hash_sample(ids, "k", 0.0).count() == 0


@pytest.mark.parametrize("width", ["7 minutes", "45 minutes", "11 hours", "2 days"])
def test_every_feature_window_is_on_the_calendar(spark, small_dir, width):
    f = Frames(spark, small_dir)
    feats, spine = f.features(width), f.spine(width)
    assert feats.join(spine, "window_start", "left_anti").count() == 0
    assert spine.count() == spine.distinct().count()


def test_calendar_bounds(spark):
    rows = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS ts UNION ALL SELECT timestamp_ntz'9999-12-31 23:59:59'")
    with pytest.raises(Exception, match="calendar of over"):
        features.window_spine(rows, "5 minutes").count()
    bounded = features.window_spine(rows, "6 hours", start="2024-01-01 00:00:00", end="2024-01-03 00:00:00")
    assert bounded.count() == 8
    assert features.window_spine(rows.limit(0), "6 hours").count() == 0
    good, other = clean.in_range(rows.unionByName(spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS ts")),
                                 "2024-01-01 00:00:00", "2025-01-01 00:00:00")
    assert (good.count(), other.count()) == (1, 2)


def test_label_stamps_must_be_complete(spark):
    path = work_path(spark, "stamps")
    stamps = ["2024-01-01 00:10:00", "2024", "2024-07", "2024-01-01T00:10", "2024-01-01 00:10", "2024-02-30 00:00:00",
              "2024-01-01 00:10:00Z", "x", ""]
    spark.createDataFrame([(s, "1", "error") for s in stamps], "a string, b string, c string").toDF(
        "window_start", "is_anomalous", "anomaly_type").write.option("header", True).csv(path)
    read = labels.read_labels_csv(spark, path)
    assert read.where("window_start is not null").count() == 1
    assert tuple(labels.stamp_report(read).first()) == (9, 8, 0)


def test_dimension_must_be_complete(spark):
    path = work_path(spark, "dimension")
    spark.createDataFrame([("/a", None, 1)], "endpoint string, service_owner string, "
                          "expected_avg_response_size long").write.parquet(path)
    with pytest.raises(Exception, match="service_owner is NULL or absent"):
        dimension.read_dimension(spark, path).collect()


def test_schema_diff_and_value_column(spark):
    a, b = spark.sql("SELECT 1 AS x, 'a' AS y"), spark.sql("SELECT 1L AS x")
    assert quality.schema_diff(a, b, ["x", "y", "z"]) == [
        ("x", "int", "bigint"), ("y", "string", "absent"), ("z", "absent", "absent")]
    lines = spark.createDataFrame([("2024-01-01 00:00:00 /a 200 5",)], "line string")
    assert "line" not in parse.accepted(parse.parse_lines(lines, value_col="line"), value_col="line").columns


def test_rollup_percentiles_equal_the_direct_ones(spark):
    rows = spark.range(3000).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 300).cast("int")))
        .alias("ts"), F.concat(F.lit("/e"), F.col("id") % 3).alias("endpoint"),
        F.when(F.col("id") % 11 > 0, 200 + F.col("id") % 2 * 300).cast("int").alias("status_code"),
        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(10_000))).alias("response_size"))
    got = features.window_features_rollup(rows, "1 hour")
    want = (rows.withColumn("window_start", F.window("ts", "1 hour").start).rollup("window_start", "endpoint")
            .agg(F.count(F.lit(1)).alias("total_requests"), F.avg((F.col("status_code") >= 400).cast("int")).alias("e"),
                 F.avg("response_size").alias("a"), F.percentile("response_size", F.lit(0.95)).alias("p")))
    key = lambda r: (str(r[0]), str(r[1]))
    for x, y in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert x[:3] == y[:3] and all(abs(p - q) < 1e-9 for p, q in zip(x[3:], y[3:]))
