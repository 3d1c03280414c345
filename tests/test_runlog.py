"""Run audit and stage metrics from the event log."""

import glob

from windowlens.operators import runlog
from windowlens.plans.frames import Frames
from windowlens.session import work_path


def test_run_audit_counts(spark, small_dir):
    f = Frames(spark, small_dir)
    audit = runlog.run_feature_job(spark, f.lines, work_path(spark, "a-feat"), work_path(spark, "a-lab"),
                                   f.labels("5 minutes"))
    m = {(r["step"], r["metric"]): r["value"] for r in audit.collect()}
    assert m[("extract", "lines_read")] == 1015
    assert m[("extract", "rejected")] == 17
    assert m[("transform", "accepted")] == 998
    assert m[("transform", "deduped")] == 986
    assert m[("transform", "duplicates")] == 12
    assert m[("transform", "windows")] == 922
    assert m[("load", "labeled_windows")] == 30 * 288


def test_stage_metrics_from_event_log(spark, small_dir, event_log_dir):
    Frames(spark, small_dir).features("1 hour").collect()
    logs = glob.glob(event_log_dir + "/*")
    assert logs
    stages = runlog.stage_metrics(spark, logs[0]).collect()
    assert stages
    assert sum(r["tasks"] for r in stages) > 0
    assert any(r["shuffle_write_bytes"] > 0 for r in stages)


def test_equal_runs_share_their_hash(spark):
    one = runlog.config_hash(spark, {"width": "5 minutes"})
    assert one == runlog.config_hash(spark, {"width": "5 minutes"})
    assert one != runlog.config_hash(spark, {"width": "1 hour"})
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one != runlog.config_hash(spark, {"width": "5 minutes"})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_runs_are_appended_and_outputs_name_theirs(spark, small_dir):
    f, audit_path = Frames(spark, small_dir), work_path(spark, "audit")
    for _ in range(2):
        labeled = work_path(spark, "b-lab")
        audit = runlog.run_feature_job(spark, f.lines, work_path(spark, "b-feat"), labeled, f.labels("5 minutes"),
                                       audit_path=audit_path)
        run = audit.select("run_id", "config_hash").distinct().collect()
        assert spark.read.parquet(labeled).select("run_id", "config_hash").distinct().collect() == run
    table = spark.read.parquet(audit_path)
    assert table.count() == 22 and table.select("run_id").distinct().count() == 2
    assert table.select("config_hash").distinct().count() == 1
