"""The distributed replacements equal Spark's single-task built-ins."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.operators import features, ranking
from windowlens.operators.features import _aggregates
from windowlens.plans.frames import Frames, rounded


def _native_sessions(rows, gap, key="endpoint"):
    out = (rows.filter(F.col("ts").isNotNull())
           .groupBy(F.col(key), F.session_window(F.col("ts"), gap).alias("s"))
           .agg(*_aggregates("status_code", "response_size", 400, 0.95, "exact", 10000)))
    return out.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                      "total_requests", "error_rate", "avg_response_size", "p95_response_size")


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sessions_equal_native_session_window(spark, small_dir):
    rows = Frames(spark, small_dir).deduped
    for gap in ("10 minutes", "2 hours"):
        ours = rounded(features.session_features(rows, gap))
        native = rounded(_native_sessions(rows, gap))
        assert _same(ours, native), gap


def test_sessions_with_a_hot_key(spark, small_dir):
    rows = Frames(spark, small_dir).deduped
    # one endpoint gets a third of all rows: every row copied under /api/hot,
    # and half of them again one second later
    hot = rows.withColumn("endpoint", F.lit("/api/hot"))
    hot2 = hot.filter(F.hour("ts") % 2 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    skewed = rows.unionByName(hot).unionByName(hot2)
    ours = rounded(features.session_features(skewed, "30 minutes"))
    native = rounded(_native_sessions(skewed, "30 minutes"))
    assert _same(ours, native)


def test_global_rank_equals_row_number(spark, small_dir):
    table = Frames(spark, small_dir).features("5 minutes")
    ours = ranking.global_rank(table, "window_start").select("window_start", "global_rank", "total_rows")
    single = table.select("window_start",
                          F.row_number().over(Window.orderBy("window_start")).cast("bigint").alias("global_rank"),
                          F.count(F.lit(1)).over(Window.partitionBy()).alias("total_rows"))
    assert _same(ours, single)
