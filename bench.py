"""Benchmark: the original job's Extract -> Transform -> Load and the model
steps, on the test data at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``.

The access log is derived from ``events`` (about 101k lines at sf0.1).  The
same three stages also run on a 15-fold replica of ``events`` (copy k
shifted by k seconds: the same days and windows with 15 times the rows,
about 1.5 million lines, the size of the original job's published run);
that total is the headline value.  A stage includes its checks, as in the
original.  Each ETL stage is the median of three timed runs; the total of the
first of them is reported too; a full run on sf0.001 warms the JVM first and
is not reported.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from windowlens.operators import (clean, enrich, evaluate, labels, model, parse, quality, sink,  # noqa: E402
                                  split)
from windowlens.operators import features as feat  # noqa: E402
from windowlens.plans import etl  # noqa: E402
from windowlens.plans.frames import Frames  # noqa: E402
from windowlens.session import build_session, work_path  # noqa: E402
from windowlens.sources import dimension, fixtures, tables, text  # noqa: E402
from windowlens.streaming import features as streaming  # noqa: E402

REPLICA_COPIES = int(os.environ.get("BENCH_REPLICA_COPIES", "15"))


def replicate(events, copies: int):
    """``copies`` copies of ``events``, copy k shifted by k seconds (explode,
    no join): the same days and windows with ``copies`` times the rows."""
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_k")
    return (events.select("*", k)
            .withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.col("_k")))
            .drop("_k"))


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def etl_run(spark, events, tag: str, times: dict, repeats: int = 3) -> int:
    """Extract, Transform, Load as three materialised stages, like the
    original job (each stage writes Parquet the next one reads), each with its
    checks: row preservation, quarantine and enrichment samples after Extract;
    cleaning audit, label coverage, distribution, histogram and samples after
    Transform; round trip and counts per date after Load.  Inputs are prepared
    once; the stages are timed ``repeats`` times into fresh folders; the
    median of each stage and the total of the first run are reported."""
    lines_path = work_path(spark, f"{tag}-lines")
    text.write_lines(fixtures.access_log_lines(events), lines_path)
    lab_path, dim_path = (work_path(spark, f"{tag}-{n}") for n in ("labels", "dimension"))
    # the inputs besides the log arrive as files, written outside the timed
    # stages: the endpoint dimension (Parquet) and the labels (CSV)
    fixtures.endpoint_dimension(events).write.parquet(dim_path)
    spine_src = events.select(F.col("ts"))
    labels.write_labels_csv(fixtures.rule_labels(feat.window_spine(spine_src)), lab_path)

    runs = {"extract": [], "transform": [], "load": []}
    for _ in range(repeats):
        ext_path, tr_path, load_path = (work_path(spark, f"{tag}-{n}") for n in ("extract", "transform", "load"))
        def do_extract():
            lines = text.read_lines(spark, lines_path)
            out = etl.write_stage(etl.extract(lines, dimension.read_dimension(spark, dim_path)), ext_path)
            enrich.row_preservation(lines, out, out).collect()
            parse.parse_audit(out).collect()
            parse.quarantine_sample(out).collect()
            enrich.enriched_sample(out.where("service_owner is not null"), 5,
                                   ("timestamp", "endpoint", "status_code", "response_size")).collect()
        runs["extract"].append(timed(do_extract))

        def do_transform():
            extracted = spark.read.parquet(ext_path)
            labeled = etl.write_stage(etl.transform(extracted, labels.read_labels_csv(spark, lab_path)), tr_path)
            clean.cleaning_audit(extracted).collect()
            labels.label_coverage(labeled).collect()
            quality.distribution(labeled, "error_rate").collect()
            quality.histogram(labeled, "error_rate").collect()
            quality.sample_per_class(labeled).collect()
        runs["transform"].append(timed(do_transform))

        def do_load():
            written = spark.read.parquet(tr_path)
            reread = etl.load(spark, written, load_path)
            quality.reconcile(written, reread.drop("date"), sink.FEATURE_TABLE_COLUMNS).collect()
            reread.groupBy("date").count().collect()
        runs["load"].append(timed(do_load))
    for stage, values in runs.items():
        times[f"{tag}_{stage}"] = statistics.median(values)
    times[f"{tag}_first_run"] = round(sum(v[0] for v in runs.values()), 3)
    times[f"{tag}_total"] = round(sum(times[f"{tag}_{s}"] for s in runs), 3)
    return spark.read.parquet(ext_path).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="windowlens-bench",
                          shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "8g"})
    times: dict[str, float] = {}

    # warm-up: one full run on the smallest data next to the bench data (JVM
    # JIT, codegen caches); not reported
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.exists(os.path.join(warm_dir, "events.parquet")):
        etl_run(spark, tables.read_table(spark, warm_dir, "events"), "warmup", {}, repeats=1)
        Frames(spark, warm_dir).labeled("1 hour").collect()

    events = tables.spread(tables.read_table(spark, sf_dir, "events"))
    sf_lines = etl_run(spark, events, "sf", times)

    f = Frames(spark, sf_dir)
    times["features_5m_one_plan"] = timed(lambda: f.features("5 minutes").collect())
    times["features_5m_approx_p95"] = timed(
        lambda: feat.window_features(f.deduped, "5 minutes", method="approx").collect())
    times["session_features_10m"] = timed(lambda: feat.session_features(f.deduped, "10 minutes").collect())
    times["label_windows_1h"] = timed(lambda: f.labeled("1 hour").collect())
    scored = evaluate.score_logistic(f.hourly_training)
    times["score_confusion_auc"] = timed(lambda: (evaluate.confusion(scored).collect(),
                                                  evaluate.auc(scored).collect()))
    times["chrono_split"] = timed(lambda: split.chrono_split(f.hourly_training).collect())
    times["lr_fit"] = timed(lambda: model.fit(split.train_part(split.chrono_split(f.hourly_training))))

    lines_path = work_path(spark, "stream-lines")
    text.write_lines(f.lines, lines_path)

    def do_stream():
        out = work_path(spark, "stream-out")
        streaming.run_available_now(streaming.feature_stream(text.read_line_stream(spark, lines_path), "1 hour"),
                                    out, out + "-ckpt")
        spark.read.parquet(out).count()
    times["stream_features_1h"] = timed(do_stream)

    replica_lines = etl_run(spark, replicate(events, REPLICA_COPIES), "x15", times)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "extract_transform_load_1.5M_lines",
        "value": times["x15_total"],
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "lines": sf_lines,
        "replica_lines": replica_lines,
        "etl_repeats": 3,
        "etl_statistic": "median",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
