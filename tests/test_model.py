"""Model and metric checks against MLlib."""

from pyspark.sql import functions as F

from windowlens.operators import evaluate, model, split
from windowlens.plans.frames import Frames


def test_closed_form_equals_model_transform(spark, small_dir):
    data = Frames(spark, small_dir).hourly_training
    fitted = model.fit(data, reg_param=0.01)
    coefs = dict(zip(model.FEATURES, fitted.stages[-1].coefficients.toArray()))
    by_model = model.score(fitted, data).select("window_start", F.col("prob_anomalous").alias("m"),
                                                F.col("prediction").alias("mp"))
    by_formula = evaluate.score_logistic(data, coefs, fitted.stages[-1].intercept).select(
        "window_start", F.col("prob_anomalous").alias("f"), F.col("prediction").alias("fp"))
    joined = by_model.join(by_formula, "window_start")
    worst = joined.agg(F.max(F.abs(F.col("m") - F.col("f")))).first()[0]
    assert worst < 1e-9
    assert joined.filter(F.col("mp") != F.col("fp")).count() == 0


def test_rank_auc_equals_mllib_exact_auc(spark, small_dir):
    scored = evaluate.score_logistic(Frames(spark, small_dir).hourly_training)
    ours = evaluate.auc(scored).first()["auc"]
    mllib = model.auc_evaluator(exact=True).setRawPredictionCol("prob_anomalous").evaluate(
        scored.withColumn("is_anomalous", F.col("is_anomalous").cast("double")))
    assert abs(ours - mllib) < 1e-9


def test_threshold_sweep_matches_confusion(spark, small_dir):
    scored = evaluate.score_logistic(Frames(spark, small_dir).hourly_training)
    at_half = evaluate.threshold_sweep(scored).filter(F.col("threshold") == 0.5).first()
    conf = evaluate.confusion(scored).first()
    assert (at_half["tp"], at_half["fp"], at_half["fn"]) == (conf["tp"], conf["fp"], conf["fn"])


def test_chrono_split_counts(spark, small_dir):
    data = Frames(spark, small_dir).hourly_training
    n = data.count()
    summary = split.split_summary(split.chrono_split(data, 0.8)).first()
    assert summary["train_windows"] == int(n * 0.8)
    assert summary["test_windows"] == n - int(n * 0.8)
    assert summary["last_train_window"] < summary["first_test_window"]
    ranks = split.chrono_split(data, 0.8).select("split_rank").distinct().count()
    assert ranks == n


def test_empty_test_part_gives_null_cutoff(spark, small_dir):
    data = Frames(spark, small_dir).hourly_training
    summary = split.split_summary(split.chrono_split(data, 1.0)).first()
    assert summary["test_windows"] == 0 and summary["first_test_window"] is None


def test_time_folds_move_forward(spark, small_dir):
    data = Frames(spark, small_dir).hourly_training
    for train, valid in model.time_folds(data, 3):
        last_train = train.agg(F.max("window_start")).first()[0]
        first_valid = valid.agg(F.min("window_start")).first()[0]
        assert last_train < first_valid


def test_fold_areas_equal_one_by_one(spark, small_dir):
    """All areas of one job against the rank area and MLlib's of each model."""
    table = model.time_blocks(Frames(spark, small_dir).hourly_training, 2).checkpoint()
    fitted = model.fit_folds(table, (1, 2), [(0.01, 0.0), (1.0, 1.0)], forward=True)
    areas = {(r["fold"], r["reg_param"]): r for r in model.fold_areas(table, fitted, forward=True).collect()}
    assert len(areas) == 4
    for (fold, (reg, enet)), m in fitted.items():
        valid, found = table.where(F.col("_fold") == fold), areas[fold, reg]
        one = evaluate.auc(model.score(m, valid, [model.LABEL])).first()
        assert (found["positives"], found["valid_rows"]) == (one["positives"], one["positives"] + one["negatives"])
        assert found["train_rows"] == table.where(F.col("_fold") < fold).count()
        assert abs(found["auc"] - one["auc"]) < 1e-9
        assert abs(found["auc"] - model.auc_evaluator().evaluate(m.transform(valid))) < 1e-9
    assert areas[1, 1.0]["auc"] == 0.5          # a strong lasso leaves the intercept alone
    means = {r["reg_param"]: r for r in model.mean_areas(model.fold_areas(table, fitted, forward=True)).collect()}
    assert abs(means[0.01]["avg_auc"] - (areas[1, 0.01]["auc"] + areas[2, 0.01]["auc"]) / 2) < 1e-12


def test_grouped_auc_with_ties_and_one_class(spark):
    rows = [("a", float(i % 5), i % 3 == 0) for i in range(60)] + [("b", 1.0, True)] * 3 + [("c", 2.0, i < 2) for i in range(5)]
    pred = spark.createDataFrame([(g, s, int(y)) for g, s, y in rows], "g string, s double, y int").repartition(4)
    got = {r["g"]: r["auc"] for r in evaluate.grouped_auc(pred, ["g"], "s", F.floor(F.col("s") / 2), "y").collect()}
    for g in "ac":
        pos, neg = ([s for x, s, y in rows if x == g and y is want] for want in (True, False))
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert abs(got[g] - wins / (len(pos) * len(neg))) < 1e-12
    assert got["b"] is None


def test_train_then_predict_end_to_end(spark, small_dir):
    from windowlens.plans import etl
    from windowlens.session import work_path
    table = Frames(spark, small_dir).labeled("1 hour")
    path = work_path(spark, "model")
    grid, test_pred, metrics, coefs = etl.train(spark, table, path)
    assert grid.count() == 9 and coefs.count() == 5
    assert test_pred.count() == table.filter(F.col("total_requests").isNotNull()).count() - \
        int(table.filter(F.col("total_requests").isNotNull()).count() * 0.8)
    pred, conf, m, dist = etl.predict(path, table)
    assert conf.first()["total"] == table.filter(F.col("total_requests").isNotNull()).count()
    assert 0.0 <= m.first()["accuracy"] <= 1.0
