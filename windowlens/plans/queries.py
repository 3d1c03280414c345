"""Registered queries: ``key -> (spark, data_dir) -> DataFrame``.

Each query reads the ``events`` table of the data folder (all of it) and runs
library operators on what Spark derives from it.  Double columns are rounded
(rates 6, sizes 4, probabilities 9 digits) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.functions.expressions import stamp_of
from windowlens.operators import (clean, drift, enrich, evaluate, incremental, labels, lineage, model, parse, quality,
                                  runlog, sink, sketches, split, traffic)
from windowlens.operators import features as feat
from windowlens.plans import etl
from windowlens.plans.frames import PROB_DIGITS, RATE_DIGITS, Frames, rounded
from windowlens.session import work_path
from windowlens.sources import fixtures, text
from windowlens.streaming import features as streaming
from windowlens.streaming import load as stream_load
from windowlens.streaming import scoring as stream_scoring

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def nullable_counts_as_double(df: DataFrame, names=("total_requests", "expected_avg_response_size")) -> DataFrame:
    """Present integer columns that can be NULL (windows without rows,
    rows without a dimension match) as DOUBLE, so that pandas-based
    comparisons see the same dtype (float64 with NaN) from every engine."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in df.columns])


def query(name: str):
    def register(fn):
        REGISTRY[name] = fn
        return fn
    return register


# --- parse / clean -----------------------------------------------------------

@query("parse_lines")
def q_parse_lines(spark, d):
    return Frames(spark, d).parsed


@query("parse_audit")
def q_parse_audit(spark, d):
    return parse.parse_audit(Frames(spark, d).parsed)


@query("parse_reasons")
def q_parse_reasons(spark, d):
    return parse.reason_counts(Frames(spark, d).parsed)


@query("parse_reasons_strict")
def q_parse_reasons_strict(spark, d):
    return parse.reason_counts(parse.parse_lines(Frames(spark, d).lines, strict_timestamps=True))


@query("quarantine_rows")
def q_quarantine_rows(spark, d):
    return parse.quarantine(Frames(spark, d).parsed)


@query("quarantine_sample")
def q_quarantine_sample(spark, d):
    return parse.quarantine_sample(Frames(spark, d).parsed, 10)


@query("typed_rows")
def q_typed_rows(spark, d):
    return Frames(spark, d).typed


@query("dedupe_rows")
def q_dedupe_rows(spark, d):
    return Frames(spark, d).deduped


@query("dedupe_audit")
def q_dedupe_audit(spark, d):
    return clean.dedupe_audit(Frames(spark, d).parsed)


@query("cleaning_audit")
def q_cleaning_audit(spark, d):
    return clean.cleaning_audit(Frames(spark, d).parsed)


# --- enrichment ----------------------------------------------------------------

@query("enrich_dim")
def q_enrich_dim(spark, d):
    f = Frames(spark, d)
    return nullable_counts_as_double(enrich.enrich(f.deduped, f.dimension))


@query("enrich_sample")
def q_enrich_sample(spark, d):
    f = Frames(spark, d)
    return nullable_counts_as_double(enrich.enriched_sample(enrich.enrich(f.typed, f.dimension), 5))


@query("row_preservation")
def q_row_preservation(spark, d):
    f = Frames(spark, d)
    return enrich.row_preservation(f.lines, f.parsed, enrich.enrich(f.parsed, f.dimension))


@query("enrich_coverage")
def q_enrich_coverage(spark, d):
    f = Frames(spark, d)
    return enrich.coverage(f.deduped, f.dimension)


# --- features -----------------------------------------------------------------

@query("window_features_5m")
def q_window_features_5m(spark, d):
    return rounded(Frames(spark, d).features("5 minutes"))


@query("window_features_1h")
def q_window_features_1h(spark, d):
    return rounded(Frames(spark, d).features("1 hour"))


@query("window_features_endpoint")
def q_window_features_endpoint(spark, d):
    return rounded(feat.window_features_rollup(Frames(spark, d).deduped, "1 hour"))


@query("window_spine")
def q_window_spine(spark, d):
    return Frames(spark, d).spine("5 minutes")


# --- labels ---------------------------------------------------------------------

@query("label_sample")
def q_label_sample(spark, d):
    return Frames(spark, d).labels("5 minutes")


@query("label_pick")
def q_label_pick(spark, d):
    return labels.pick_labels(Frames(spark, d).spine("5 minutes"))


@query("label_pick_seed7")
def q_label_pick_seed7(spark, d):
    return labels.pick_labels(Frames(spark, d).spine("5 minutes"), seed=7)


@query("label_windows")
def q_label_windows(spark, d):
    return nullable_counts_as_double(rounded(Frames(spark, d).labeled("5 minutes")))


@query("label_windows_7m")
def q_label_windows_7m(spark, d):
    """A width that does not divide the day."""
    return nullable_counts_as_double(rounded(Frames(spark, d).labeled("7 minutes")))


@query("label_windows_2d")
def q_label_windows_2d(spark, d):
    return nullable_counts_as_double(rounded(Frames(spark, d).labeled("2 days")))


@query("calendar_check")
def q_calendar_check(spark, d):
    """Feature windows and those of them that are not on the calendar."""
    f, out = Frames(spark, d), None
    for width in ("7 minutes", "1 hour", "2 days"):
        feats = f.feature_table(width)
        on = f.spine(width).withColumn("on", F.lit(1))
        one = feats.join(on, "window_start", "left").agg(
            F.count(F.lit(1)).alias("windows"), F.count_if(F.col("on").isNull()).alias("off_calendar"))
        one = one.select(F.lit(width).alias("width"), "windows", "off_calendar")
        out = one if out is None else out.unionByName(one)
    return out


@query("label_coverage")
def q_label_coverage(spark, d):
    return labels.label_coverage(Frames(spark, d).labeled("5 minutes"))


@query("label_mix")
def q_label_mix(spark, d):
    return labels.label_mix(Frames(spark, d).labels("5 minutes"))


@query("unlabeled_windows")
def q_unlabeled_windows(spark, d):
    """Feature windows without a label: the label file lacks every day of the
    month that leaves 3 when divided by 7."""
    f = Frames(spark, d)
    path = work_path(spark, "labels-with-gaps")
    labels.write_labels_csv(f.labels("5 minutes").where(F.dayofmonth("window_start") % 7 != 3), path)
    return rounded(labels.unlabeled_windows(f.feature_table("5 minutes"), labels.read_labels_csv(spark, path)))


def _damaged_labels(spark, d):
    """A label file in which the stamps of six hours a day are damaged."""
    path = work_path(spark, "labels-damaged")
    ts, hour = F.date_format("window_start", fixed.TIMESTAMP_TEXT_FORMAT), F.hour("window_start")
    text = (F.when(hour == 1, F.substring(ts, 1, 4)).when(hour == 5, F.substring(ts, 1, 7))
            .when(hour == 9, F.replace(ts, F.lit(" "), F.lit("T"))).when(hour == 13, F.substring(ts, 1, 16))
            .when(hour == 17, F.concat(F.substring(ts, 1, 5), F.lit("13-45 00:00:00")))
            .when(hour == 21, F.concat(ts, F.lit("Z"))).otherwise(ts))
    rows = Frames(spark, d).labels("5 minutes").select(text.alias("window_start"), "is_anomalous", "anomaly_type")
    rows.write.option("header", True).csv(path)
    return labels.read_labels_csv(spark, path)


@query("labels_csv_damaged")
def q_labels_csv_damaged(spark, d):
    return _damaged_labels(spark, d).where("window_start is not null")


@query("label_stamp_report")
def q_label_stamp_report(spark, d):
    return labels.stamp_report(_damaged_labels(spark, d))


# --- quality reports ------------------------------------------------------------

@query("feature_distribution")
def q_feature_distribution(spark, d):
    out = quality.distribution(Frames(spark, d).labeled("5 minutes"), "error_rate")
    return out.select(*[F.round(c, RATE_DIGITS).alias(c) if c.endswith("_value") and c != "distinct_values"
                        else F.col(c) for c in out.columns])


@query("feature_quantiles")
def q_feature_quantiles(spark, d):
    out = quality.quantiles(Frames(spark, d).labeled("5 minutes"), "error_rate")
    return out.select(*[F.round(c, RATE_DIGITS).alias(c) for c in out.columns])


@query("error_histogram")
def q_error_histogram(spark, d):
    return quality.histogram(Frames(spark, d).labeled("5 minutes"), "error_rate")


@query("sample_per_class")
def q_sample_per_class(spark, d):
    return nullable_counts_as_double(rounded(quality.sample_per_class(Frames(spark, d).labeled("5 minutes"))))


# --- traffic ----------------------------------------------------------------------

@query("daypart_profile")
def q_daypart_profile(spark, d):
    return traffic.daypart_profile(Frames(spark, d).deduped)


@query("proportional_allocation")
def q_proportional_allocation(spark, d):
    f = Frames(spark, d)
    # rows with a timestamp = sum of window counts: taken from the same
    # materialised window table as the calendar, so the raw lines are read once
    total = f.feature_table("1 hour").agg(F.sum("total_requests").alias("total"))
    return traffic.allocate(f.spine("1 hour"), total)


@query("endpoint_topk")
def q_endpoint_topk(spark, d):
    return traffic.endpoint_topk(Frames(spark, d).typed, k=3)


@query("render_lines")
def q_render_lines(spark, d):
    return traffic.render_lines(Frames(spark, d).deduped)


@query("hash_sample")
def q_hash_sample(spark, d):
    return fixtures.access_log_lines(traffic.hash_sample(Frames(spark, d).events, "event_id", 0.3, seed=7))


@query("hash_sample_strided")
def q_hash_sample_strided(spark, d):
    """Ids 0, 10, 20, ... are sampled like any others."""
    ev = Frames(spark, d).events.withColumn("strided", F.col("event_id") * 10)
    return traffic.hash_sample(ev, "strided", 0.3, seed=7).select("event_id")


@query("line_sample")
def q_line_sample(spark, d):
    return etl.sample_lines(Frames(spark, d).lines, fraction=0.1, seed=3)


# --- split, scoring, metrics ---------------------------------------------------------

def _split(spark, d, fraction=fixed.TRAIN_FRACTION):
    return split.chrono_split(Frames(spark, d).hourly_training, fraction)


def _scored(spark, d):
    return evaluate.score_logistic(Frames(spark, d).hourly_training)


def _round_all(df: DataFrame, names, digits=PROB_DIGITS) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


@query("chrono_split")
def q_chrono_split(spark, d):
    return _split(spark, d).select("window_start", "split_rank", "part")


@query("split_cutoff")
def q_split_cutoff(spark, d):
    return split.split_summary(_split(spark, d))


@query("class_balance")
def q_class_balance(spark, d):
    return split.class_balance(_split(spark, d))


@query("score_logistic")
def q_score_logistic(spark, d):
    out = _scored(spark, d).select("window_start", "is_anomalous", "anomaly_type", "prob_anomalous", "prediction")
    return _round_all(out, {"prob_anomalous"})


@query("confusion_matrix")
def q_confusion_matrix(spark, d):
    return evaluate.confusion(_scored(spark, d))


@query("classification_metrics")
def q_classification_metrics(spark, d):
    out = evaluate.metrics(evaluate.confusion(_scored(spark, d)))
    return _round_all(out, set(out.columns) - {"both_classes_predicted"})


@query("model_notes")
def q_model_notes(spark, d):
    return evaluate.notes(evaluate.confusion(_scored(spark, d)))


@query("write_predictions")
def q_write_predictions(spark, d):
    path = work_path(spark, "predictions")
    sink.write_predictions(q_score_logistic(spark, d), path)
    return spark.read.parquet(path)


@query("prediction_distribution")
def q_prediction_distribution(spark, d):
    return evaluate.prediction_distribution(_scored(spark, d))


@query("threshold_sweep")
def q_threshold_sweep(spark, d):
    return _round_all(evaluate.threshold_sweep(_scored(spark, d)), {"precision", "recall"})


@query("auc_rank")
def q_auc_rank(spark, d):
    return _round_all(evaluate.auc(_scored(spark, d)), {"auc"})


@query("psi_drift")
def q_psi_drift(spark, d):
    halves = _split(spark, d, 0.5)
    return _round_all(drift.psi(split.train_part(halves), split.test_part(halves)), {"psi"})


# --- sinks ------------------------------------------------------------------------------

def _written_features(spark, d, name):
    """Labelled 5-minute windows written partitioned by date; returns
    (frame as written, path)."""
    path = work_path(spark, name)
    table = sink.with_date(Frames(spark, d).labeled("5 minutes"))
    sink.write_partitioned(table, path)
    return table, path


@query("labels_csv")
def q_labels_csv(spark, d):
    path = work_path(spark, "labels-csv")
    labels.write_labels_csv(Frames(spark, d).labels("5 minutes"), path)
    return labels.read_labels_csv(spark, path)


@query("partition_counts")
def q_partition_counts(spark, d):
    _, path = _written_features(spark, d, "features-by-date")
    out = sink.partition_counts(spark, path)
    return out.select(F.date_format("date", fixed.DATE_TEXT_FORMAT).alias("date"), "rows")


@query("file_inventory")
def q_file_inventory(spark, d):
    _, path = _written_features(spark, d, "features-files")
    return sink.file_inventory(spark, path).select("date", "files")


@query("reconcile")
def q_reconcile(spark, d):
    table, path = _written_features(spark, d, "features-round-trip")
    return sink.round_trip(spark, table, path)


# --- fitted model: what must hold whatever the optimiser's last digits are -----------------

TOLERANCE = 1e-9       # of the closed form against the fitted model's own scores
SLOPE = 1e-3           # of the penalised loss at the fitted coefficients


def _fitted(spark, d):
    parts = _split(spark, d)
    return parts, model.fit(split.train_part(parts), reg_param=0.01, elastic_net=0.0)


@query("lr_batch_score")
def q_lr_batch_score(spark, d):
    """Windows scored by the saved and loaded model, and those on which the
    closed form differs."""
    parts, fitted = _fitted(spark, d)
    path = work_path(spark, "model")
    model.save(fitted, path)
    loaded = model.load(path)
    scored = model.score(loaded, split.test_part(parts), keep=["window_start", *fixed.FEATURE_COLUMNS])
    twin = evaluate.score_logistic(scored.withColumnRenamed("prob_anomalous", "by_model")
                                   .withColumnRenamed("prediction", "model_says"), **model.closed_form(loaded))
    differs = (F.abs(F.col("by_model") - F.col("prob_anomalous")) > TOLERANCE) | (
        F.col("model_says") != F.col("prediction"))
    return twin.agg(F.count(F.lit(1)).alias("windows"), F.count_if(differs).alias("differing"))


AREAS = ["fold", "reg_param", "elastic_net", "train_rows", "valid_rows", "positives"]


def _evaluated(spark, table, fitted):
    """MLlib's own area of every model on its fold."""
    found = [(fold, *point, float(model.auc_evaluator().evaluate(m.transform(table.where(F.col("_fold") == fold)))))
             for (fold, point), m in fitted.items()]
    return spark.createDataFrame(found, "fold int, reg_param double, elastic_net double, by_mllib double")


def _area_equal():
    return F.coalesce(F.abs(F.col("auc") - F.col("by_mllib")) <= TOLERANCE,
                      F.col("positives").isin(0, F.col("valid_rows"))).alias("area_equal")


@query("cv_grid")
def q_cv_grid(spark, d):
    """Folds, their sizes and classes; whether each area equals MLlib's; and
    whether the winner of the search is the first point with the top mean."""
    train = split.train_part(_split(spark, d)).checkpoint(eager=True)
    table = train.withColumn("_fold", model.hash_fold("window_start", fixed.CV_FOLDS, fixed.CV_SEED))
    fitted = model.fit_folds(table, range(fixed.CV_FOLDS), model.grid_points())
    areas = model.fold_areas(table, fitted).join(_evaluated(spark, table, fitted), ["fold", "reg_param", "elastic_net"])
    searched = model.grid_table(spark, model.cross_validate(train)).collect()     # one row a grid point
    top = max(range(len(searched)), key=lambda i: searched[i]["avg_auc"])
    won = [r["best"] for r in searched] == [i == top for i in range(len(searched))]
    return areas.select(*AREAS, _area_equal(), F.lit(won).alias("winner_is_best"))


@query("cv_time_folds")
def q_cv_time_folds(spark, d):
    table = model.time_blocks(split.train_part(_split(spark, d))).checkpoint(eager=True)
    fitted = model.fit_folds(table, range(1, fixed.CV_FOLDS + 1), model.grid_points(), True)
    areas = model.fold_areas(table, fitted, True)
    return areas.join(_evaluated(spark, table, fitted), ["fold", "reg_param", "elastic_net"]).select(
        *AREAS, _area_equal())


@query("cv_repeated")
def q_cv_repeated(spark, d):
    """The full grid under three seeds: folds and classes of every area, and
    whether the spread over the seeds is that of the areas."""
    areas = model.repeated_cv(spark, split.train_part(_split(spark, d))).checkpoint(eager=True)
    means = {}
    for r in areas.collect():                    # seeds x folds x grid points
        means.setdefault((r["reg_param"], r["elastic_net"]), {}).setdefault(r["seed"], []).append(r["auc"])
    table = model.over_seeds(areas).collect()
    ok = len(table) == len(means) and all(
        abs(r["mean_auc"] - sum(sum(x) / len(x) for x in seeds.values()) / len(seeds)) < TOLERANCE
        and r["seeds"] == len(seeds) for r in table for seeds in [means[r["reg_param"], r["elastic_net"]]])
    return areas.select("seed", *AREAS, F.coalesce(F.col("auc").between(0.0, 1.0), F.lit(False)).alias("auc_valid"),
                        F.lit(ok).alias("means_agree"))


@query("coefficient_table")
def q_coefficient_table(spark, d):
    """Terms of the fitted model; at each the penalised loss is flat."""
    parts, fitted = _fitted(spark, d)
    scored = model.score(fitted, split.train_part(parts), keep=[*fixed.FEATURE_COLUMNS, model.LABEL])
    return (model.coefficient_table(spark, fitted).join(model.gradient(scored, fitted), "term")
            .select("term", (F.abs("slope") < SLOPE).alias("at_optimum")))


# --- streaming ------------------------------------------------------------------------------

STREAM_WIDTH = "1 hour"


def _line_folder(spark, d):
    path = work_path(spark, "lines")
    text.write_lines(Frames(spark, d).lines, path)
    return path


def _run_stream(spark, stream_df, name):
    out = work_path(spark, name)
    streaming.run_available_now(stream_df, out, out + "-checkpoint")
    return streaming.read_sink(spark, out)


@query("stream_features")
def q_stream_features(spark, d):
    """The windows the stream has closed and, from its state, the ones it
    holds open."""
    lines = text.read_line_stream(spark, _line_folder(spark, d))
    out = work_path(spark, "stream-counts")
    streaming.run_available_now(streaming.count_stream(lines, STREAM_WIDTH), out, out + "-checkpoint")
    return rounded(streaming.all_windows(spark, streaming.read_sink(spark, out), out + "-checkpoint"))


#: After all stamps of the given tables.
END_OF_INPUT = "2100-01-01 00:00:00"


def _closed_folder(spark, d):
    """The lines, and one that lets the stream close all windows."""
    path = _line_folder(spark, d)
    closing = spark.createDataFrame([(streaming.closing_line(END_OF_INPUT),)], "value string")
    text.write_lines(closing, path, mode="append")
    return path


def _stream_rows(spark, d, name, step=lambda rows: rows):
    """Stamped rows through a deduplicating stream, the others through a
    stateless one and deduplicated in batch; ``step`` is applied to both."""
    lines = text.read_line_stream(spark, _line_folder(spark, d))
    typed = streaming.typed_stream(lines)
    stamped = _run_stream(spark, step(streaming.dedupe_stream(typed)), name)
    rest = _run_stream(spark, streaming.unstamped(typed), f"{name}-unstamped")
    return stamped.drop("event_time").unionByName(step(clean.dedupe(rest.select(*clean.TYPED_COLUMNS))))


@query("stream_dedupe")
def q_stream_dedupe(spark, d):
    return _stream_rows(spark, d, "stream-dedupe").select(*clean.TYPED_COLUMNS)


@query("stream_score")
def q_stream_score(spark, d):
    lines = text.read_line_stream(spark, _closed_folder(spark, d))
    scored = streaming.scored_stream(streaming.feature_stream(lines, STREAM_WIDTH))
    out = _run_stream(spark, scored, "stream-score")
    return _round_all(out.select("window_start", "prob_anomalous", "prediction"), {"prob_anomalous"})


@query("stream_sessions")
def q_stream_sessions(spark, d):
    lines = text.read_line_stream(spark, _closed_folder(spark, d))
    return rounded(_run_stream(spark, streaming.session_stream(lines, "10 minutes"), "stream-sessions"))


@query("stream_labels")
def q_stream_labels(spark, d):
    """Labels and features joined as two streams."""
    f, path = Frames(spark, d), work_path(spark, "stream-label-csv")
    labels.write_labels_csv(f.labels(), path)
    last = spark.createDataFrame([(END_OF_INPUT, 0, "none")], "window_start string, is_anomalous int, anomaly_type string")
    labels.write_labels_csv(last.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), path, "append")
    joined = streaming.labeled_stream(streaming.label_stream(spark, path),
                                      text.read_line_stream(spark, _closed_folder(spark, d)))
    return nullable_counts_as_double(rounded(_run_stream(spark, joined, "stream-labels")))


def _stamp():
    return stamp_of(F.substring("value", 1, 19))     # NULL for damaged lines


def _arrive(lines, arrival, number, path):
    lines.where(F.coalesce(arrival, F.lit(0)) == number).select("value").write.mode("append").text(path)


def out_of_order(stamp, first_day):
    """Arrival of a line, 0 to 3: eight days each, but of the second eight
    days the odd seconds come with the third."""
    part = F.least(F.floor(F.date_diff(F.to_date(stamp), first_day) / 8), F.lit(3))
    return F.when((part == 1) & (F.second(stamp) % 2 == 1), F.lit(2)).otherwise(part)


@query("stream_late_rows")
def q_stream_late_rows(spark, d):
    """Features of closed and open windows after four arrivals, some of them
    out of order, and of the late rows."""
    f = Frames(spark, d)
    lines, store, folder = f.lines, work_path(spark, "late-store"), work_path(spark, "late-lines")
    first_day = f.events.agg(F.min(F.to_date("ts")).alias("d")).first()["d"]
    for arrival in range(4):
        _arrive(lines, out_of_order(_stamp(), F.lit(first_day)), arrival, folder)
        stream_load.run_load_stream(text.read_line_stream(spark, folder), store, STREAM_WIDTH)
    late = feat.window_features(stream_load.late_rows(spark, store), STREAM_WIDTH).withColumn("state", F.lit("late"))
    return rounded(stream_load.window_states(spark, store, STREAM_WIDTH).unionByName(late))


@query("stream_model_versions")
def q_stream_model_versions(spark, d):
    """Windows scored by each model version of one stream, and those on which
    the version's closed form differs.  The second model is published between
    two runs."""
    f, base = Frames(spark, d), work_path(spark, "versions")
    train = split.train_part(_split(spark, d)).checkpoint(eager=True)
    lines, early = f.lines, F.coalesce(F.dayofmonth(_stamp()) <= 15, F.lit(True)).cast("int")
    forms = {}
    for number, reg in ((1, 0.01), (0, 0.1)):
        _arrive(lines, early, number, f"{base}/lines")
        if not number:
            text.write_lines(spark.createDataFrame([(streaming.closing_line(END_OF_INPUT),)], "value string"),
                             f"{base}/lines", mode="append")
        fitted = model.fit(train, reg_param=reg)
        forms[stream_scoring.publish(fitted, f"{base}/registry", spark)] = model.closed_form(fitted)
        stream = streaming.feature_stream(text.read_line_stream(spark, f"{base}/lines"), STREAM_WIDTH)
        stream_scoring.run_scored(stream, f"{base}/registry", f"{base}/scored", f"{base}/checkpoint")
    scored = (spark.read.parquet(f"{base}/scored").drop("batch")
              .withColumnsRenamed({"prob_anomalous": "by_model", "prediction": "model_says"}))
    twins = [evaluate.score_logistic(scored.where(F.col("version") == v), **form) for v, form in forms.items()]
    differs = (F.abs(F.col("by_model") - F.col("prob_anomalous")) > TOLERANCE) | (
        F.col("model_says") != F.col("prediction"))
    return twins[0].unionByName(twins[1]).groupBy("version").agg(
        F.count(F.lit(1)).alias("windows"), F.count_if(differs).alias("differing"))


# --- run audit ------------------------------------------------------------------------------

@query("run_audit")
def q_run_audit(spark, d):
    """The audit table after one run (times and ids left out)."""
    f, path = Frames(spark, d), work_path(spark, "audit")
    runlog.run_feature_job(spark, f.lines, work_path(spark, "run-features"), work_path(spark, "run-labeled"),
                           f.labels("5 minutes"), audit_path=path)
    audit = spark.read.schema(runlog.AUDIT_SCHEMA).parquet(path)
    return audit.where("metric != 'elapsed_ms'").orderBy("step_no", "metric")


# --- incremental load -----------------------------------------------------------------------

@query("incremental_features")
def q_incremental_features(spark, d):
    """Three batches: the first half of every window, the second half with
    the first ten days of each month once more, and the second again."""
    rows, store = Frames(spark, d).typed, work_path(spark, "incremental")
    first = F.coalesce(F.pmod(F.unix_timestamp("ts"), F.lit(300)) < 150, F.lit(True))
    again = F.dayofmonth("ts") <= 10
    incremental.load_batch(rows.where(first), store, "first")
    for _ in range(2):
        incremental.load_batch(rows.where(~first | again), store, "second")
    return rounded(incremental.stored_features(spark, store))


# --- mergeable sketches ---------------------------------------------------------------------

@query("window_sketches")
def q_window_sketches(spark, d):
    """Days rolled up from 5-minute sketches by way of hours; the percentile
    as whether its rank is within the sketch's bound."""
    rows = Frames(spark, d).deduped.checkpoint(eager=True)
    path = work_path(spark, "sketches")
    sketches.window_sketches(rows).write.parquet(path)
    days = sketches.roll_up(sketches.roll_up(spark.read.parquet(path), "1 hour"), "1 day")
    found = sketches.sketch_features(days).checkpoint(eager=True)
    within = sketches.rank_check(found, rows, "1 day", sketches.kll_rank_error())
    return rounded(found.join(within, "window_start").drop("p95_response_size"))


@query("window_features_approx")
def q_window_features_approx(spark, d):
    """Hourly features with Spark's approximate percentile, as whether its
    rank is within the accuracy asked for."""
    rows = Frames(spark, d).deduped.checkpoint(eager=True)
    found = feat.window_features(rows, "1 hour", method="approx", accuracy=1000).checkpoint(eager=True)
    within = sketches.rank_check(found, rows, "1 hour", 1 / 1000)
    return rounded(found.join(within, "window_start").drop("p95_response_size"))


@query("distinct_sketches")
def q_distinct_sketches(spark, d):
    """Distinct sizes of every ISO week, united from the sketches of its
    days, as whether they are within the error of the exact count."""
    rows = Frames(spark, d).deduped.where("ts is not null").checkpoint(eager=True)
    path = work_path(spark, "distinct")
    sketches.distinct_sketches(rows, "response_size", F.to_date("ts")).write.parquet(path)
    week = F.date_format(F.date_trunc("week", F.col("part")), fixed.DATE_TEXT_FORMAT)
    about = sketches.distinct_over(spark.read.parquet(path), week)
    exact = rows.groupBy(F.date_format(F.date_trunc("week", "ts"), fixed.DATE_TEXT_FORMAT).alias("span")).agg(
        F.count_distinct("response_size").alias("exact"))
    off = F.abs(F.col("distinct_values") - F.col("exact")) <= F.ceil(F.col("exact") * sketches.hll_error())
    return about.join(exact, "span").select(F.col("span").alias("week"), F.col("exact").alias("distinct_sizes"),
                                            off.alias("within"))


# --- parts that differ, first lines, lineage ------------------------------------------------

def damaged_copy(table):
    """On days 1, 11, 21 the windows of 3 o'clock are lost, on days 2, 12, 22
    those of 5 o'clock doubled, on days 3, 13, 23 those of 7 o'clock changed."""
    day, hour = F.dayofmonth("window_start") % 10, F.hour("window_start")
    lost, doubled, changed = (day == 1) & (hour == 3), (day == 2) & (hour == 5), (day == 3) & (hour == 7)
    copies = F.when(lost, F.array().cast("array<int>")).when(doubled, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (table.withColumn("_copy", F.explode(copies)).drop("_copy")
            .withColumn("is_anomalous", F.col("is_anomalous") + F.when(changed, 1).otherwise(0)))


@query("reconcile_dates")
def q_reconcile_dates(spark, d):
    table, path = _written_features(spark, d, "features-whole")
    copy = work_path(spark, "features-damaged")
    sink.write_partitioned(damaged_copy(spark.read.parquet(path)), copy)
    out = quality.reconcile_parts(spark.read.parquet(path), spark.read.parquet(copy), sink.FEATURE_TABLE_COLUMNS, "date")
    return out.select(F.date_format("date", fixed.DATE_TEXT_FORMAT).alias("date"), "missing", "extra")


@query("first_lines")
def q_first_lines(spark, d):
    """The first 2,000 lines of files that follow each other in text order."""
    path = work_path(spark, "sorted-lines")
    Frames(spark, d).lines.orderBy("value").write.text(path)
    return text.numbered_lines(spark, path, 2000).select("line_no", "value")


@query("lineage_runs")
def q_lineage_runs(spark, d):
    """Lines each of four runs read: ten days, nothing new, the other days,
    nothing new."""
    lines, base = Frames(spark, d).lines, work_path(spark, "lineage")
    early = F.coalesce(F.dayofmonth(_stamp()) <= 10, F.lit(True)).cast("int")
    for run in range(1, 5):
        if run % 2:
            _arrive(lines, early, int(run == 1), f"{base}/lines")
        lineage.run_once(spark, f"{base}/lines", f"{base}/ledger", str(run), lambda rows: rows.select(
            "value", F.lit(run).alias("run")).write.mode("append").parquet(f"{base}/read"))
    runs = spark.range(1, 5).select(F.col("id").alias("run"))
    return runs.join(spark.read.parquet(f"{base}/read"), "run", "left").groupBy("run").agg(F.count("value").alias("lines"))


# --- sliding and session windows ------------------------------------------------------

@query("window_features_sliding")
def q_window_features_sliding(spark, d):
    return rounded(feat.sliding_features(Frames(spark, d).deduped, "1 hour", "30 minutes"))


@query("session_features")
def q_session_features(spark, d):
    return rounded(feat.session_features(Frames(spark, d).deduped, "10 minutes", key="endpoint"))


@query("stream_enrich")
def q_stream_enrich(spark, d):
    """Deduplicated stream rows enriched with the (static) dimension."""
    dim = Frames(spark, d).dimension
    out = _stream_rows(spark, d, "stream-enrich", lambda rows: enrich.enrich(rows, dim))
    return nullable_counts_as_double(out.select(*clean.TYPED_COLUMNS, "service_owner", "expected_avg_response_size"))
