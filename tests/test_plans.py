"""Physical-plan properties: broadcast, pushdown, pruning, no Python rows."""

import pytest
from pyspark.sql import functions as F

from windowlens.operators import enrich, parse, quality, sink
from windowlens.plans.frames import Frames
from windowlens.plans.registry import all_queries
from windowlens.session import work_path

# Registered queries that write files or run streams/ML as part of building
# the frame; their plans are checked elsewhere.
SIDE_EFFECT_KEYS = {"labels_csv", "partition_counts", "file_inventory", "reconcile", "lr_batch_score",
                    "cv_grid", "coefficient_table", "stream_features", "stream_dedupe", "stream_score",
                    "run_audit", "stream_enrich", "cv_time_folds", "cv_repeated", "write_predictions",
                    "unlabeled_windows", "labels_csv_damaged", "label_stamp_report",
                    "incremental_features", "stream_sessions", "stream_labels",
                    "stream_late_rows", "stream_model_versions", "window_sketches", "window_features_approx", "distinct_sketches",
                    "reconcile_dates", "first_lines", "lineage_runs"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_is_broadcast(spark, small_dir):
    f = Frames(spark, small_dir)
    out = enrich.enrich(f.deduped, f.dimension)
    out.count()
    assert "BroadcastHashJoin" in _plan(out)


def test_parse_ok_filter_reaches_parquet(spark, small_dir):
    path = work_path(spark, "parsed")
    Frames(spark, small_dir).parsed.write.parquet(path)
    plan = _plan(parse.accepted(spark.read.parquet(path)).select("endpoint"))
    assert "PushedFilters: [IsNotNull(parse_ok), EqualTo(parse_ok,true)]" in plan
    assert "ReadSchema: struct<endpoint:string,parse_ok:boolean>" in plan


def test_date_predicate_prunes_partitions(spark, small_dir):
    path = work_path(spark, "by-date")
    sink.write_partitioned(sink.with_date(Frames(spark, small_dir).labeled("1 hour")), path)
    df = spark.read.parquet(path).filter(F.col("date") == F.lit("2024-01-05").cast("date"))
    assert "PartitionFilters: [isnotnull(date" in _plan(df)
    assert df.count() == 24


def test_scan_reads_only_needed_columns(spark, small_dir):
    plan = _plan(Frames(spark, small_dir).typed)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_top_n_per_class_uses_group_limit(spark, small_dir):
    out = quality.sample_per_class(Frames(spark, small_dir).labeled("1 hour"))
    out.collect()
    assert "WindowGroupLimit" in _plan(out)


@pytest.mark.parametrize("key", sorted(set(all_queries()) - SIDE_EFFECT_KEYS))
def test_no_python_rows_in_plans(spark, small_dir, key):
    plan = _plan(all_queries()[key](spark, small_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_large_dimension_is_not_broadcast(spark, small_dir):
    f = Frames(spark, small_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        out = enrich.enrich(f.deduped, f.dimension)
        assert out.count() == f.deduped.count()
        assert "BroadcastHashJoin" not in _plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_enrichment_scans_the_facts_once(spark, small_dir):
    f = Frames(spark, small_dir)
    plan = enrich.enrich(f.deduped, f.dimension)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_type") and plan.count("Relation [event_id") == 1


def test_sessions_parse_once(spark, small_dir):
    from windowlens.operators import features
    plan = _plan(features.session_features(Frames(spark, small_dir).deduped, "10 minutes"))
    assert "regexp_extract" not in plan      # the counts are stored; their one pass has parsed the lines


def test_calendar_is_spread_over_tasks(spark):
    from windowlens.operators import features
    rows = spark.sql("SELECT timestamp_ntz'2020-01-01 00:00:00' AS ts UNION ALL SELECT timestamp_ntz'2020-12-31 00:00:00'")
    spine = features.window_spine(rows, "1 minute")
    assert spine.count() == 366 * 1440
    assert "hashpartitioning(_p" in _plan(spine)
