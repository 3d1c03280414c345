"""Conservation properties and known counts on sf0.001 (FIXTURES.md)."""

from pyspark.sql import functions as F

from windowlens.operators import clean, features
from windowlens.plans.frames import Frames


def test_known_counts(spark, small_dir):
    f = Frames(spark, small_dir)
    assert f.lines.count() == 1015
    assert f.parsed.filter(~F.col("parse_ok")).count() == 17
    assert f.typed.count() == 998
    assert f.deduped.count() == 986
    assert f.deduped.filter(F.col("ts").isNull()).count() == 1
    assert f.features("5 minutes").count() == 922
    assert f.features("1 hour").count() == 527


def test_conservation(spark, small_dir):
    f = Frames(spark, small_dir)
    audit = {r["step"]: r["rows"] for r in clean.cleaning_audit(f.parsed).collect()}
    assert audit["lines_read"] == audit["rejected"] + audit["accepted"]
    assert audit["accepted"] == audit["after_dedupe"] + audit["duplicates"]
    total = f.features("5 minutes").agg(F.sum("total_requests")).first()[0]
    assert total + audit["null_timestamp"] == audit["after_dedupe"]


def test_spine_size(spark, small_dir):
    f = Frames(spark, small_dir)
    days = f.spine("1 day").count()
    assert f.spine("5 minutes").count() == days * 288
    assert f.spine("1 hour").count() == days * 24
    assert f.spine("1 hour").distinct().count() == days * 24


def test_label_join_keeps_every_window(spark, small_dir):
    f = Frames(spark, small_dir)
    labeled = f.labeled("1 hour")
    assert labeled.count() == f.spine("1 hour").count()
    assert labeled.filter(F.col("total_requests").isNotNull()).count() == f.features("1 hour").count()
