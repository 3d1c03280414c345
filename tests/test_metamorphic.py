"""Metamorphic properties of the feature computation."""

from pyspark.sql import functions as F

from windowlens.operators import clean, features, parse
from windowlens.plans.frames import Frames, rounded


def _features(lines, width="1 hour"):
    return rounded(features.window_features(clean.dedupe(clean.typed_rows(parse.parse_lines(lines))), width))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partitioning_does_not_change_features(spark, small_dir):
    lines = Frames(spark, small_dir).lines
    assert _same(_features(lines), _features(lines.repartition(7)))
    assert _same(_features(lines), _features(lines.repartition(3, "value").sortWithinPartitions(F.desc("value"))))


def test_extra_duplicates_change_only_the_audit(spark, small_dir):
    lines = Frames(spark, small_dir).lines
    doubled = lines.unionByName(lines)
    assert _same(_features(lines), _features(doubled))
    a = {r["step"]: r["rows"] for r in clean.cleaning_audit(parse.parse_lines(doubled)).collect()}
    b = {r["step"]: r["rows"] for r in clean.cleaning_audit(parse.parse_lines(lines)).collect()}
    assert a["after_dedupe"] == b["after_dedupe"]
    assert a["duplicates"] == b["duplicates"] + b["accepted"]


def test_shifting_time_shifts_windows(spark, small_dir):
    rows = Frames(spark, small_dir).deduped
    shifted = rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    base = rounded(features.window_features(rows, "1 hour")).withColumn(
        "window_start", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    assert _same(base, rounded(features.window_features(shifted, "1 hour")))
