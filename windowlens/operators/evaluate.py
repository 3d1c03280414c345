"""Scoring with fixed coefficients and classification metrics as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.functions import fixed
from windowlens.functions.expressions import logistic_score, ratio
from windowlens.operators.ranking import prefix_sums, quantile_bucket

LABEL = fixed.LABEL_COLUMN


def score_logistic(df: DataFrame, coefficients: dict[str, float] | None = None,
                   intercept: float = fixed.PUBLISHED_INTERCEPT,
                   threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
    """Add ``prob_anomalous`` = sigmoid(intercept + sum(c_i x_i)) and
    ``prediction`` (1.0 when the probability is above ``threshold``), the
    same numbers a fitted logistic-regression model gives, as plain column
    expressions."""
    prob = logistic_score(coefficients or dict(fixed.PUBLISHED_COEFFICIENTS), intercept)
    return (df.withColumn("prob_anomalous", prob)
            .withColumn("prediction", F.when(F.col("prob_anomalous") > F.lit(float(threshold)), F.lit(1.0))
                        .otherwise(F.lit(0.0))))


def confusion(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One row ``tp fp tn fn total`` from a single aggregate pass."""
    y, p = F.col(label), F.col(prediction)
    return pred.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count(F.lit(1)).alias("total"),
    )


def metrics(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1, accuracy and the accuracy of always predicting
    the majority (normal) class; 0 where a denominator is 0."""
    tp, fp, tn, fn, total = (F.col(c) for c in ("tp", "fp", "tn", "fn", "total"))
    precision = F.coalesce(ratio(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(ratio(tp, tp + fn), F.lit(0.0))
    return conf.select(
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(ratio(F.lit(2.0) * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
        F.coalesce(ratio(tp + tn, total), F.lit(0.0)).alias("accuracy"),
        F.coalesce(ratio(tn + fn, total), F.lit(0.0)).alias("majority_accuracy"),
        ((tp + fp > 0) & (tn + fn > 0)).alias("both_classes_predicted"),
    )


LOW_PRECISION = 0.5


def notes(conf: DataFrame, low_precision: float = LOW_PRECISION) -> DataFrame:
    """``(note, holds)`` in a fixed order: warnings a report should show."""
    m = metrics(conf).select(
        F.array(F.struct(F.lit("low_precision").alias("note"), (F.col("precision") < low_precision).alias("holds")),
                F.struct(F.lit("not_better_than_majority").alias("note"),
                         (F.col("accuracy") <= F.col("majority_accuracy")).alias("holds")),
                F.struct(F.lit("one_class_predicted").alias("note"),
                         (~F.col("both_classes_predicted")).alias("holds"))).alias("n"))
    return m.select(F.inline("n"))


def prediction_distribution(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Windows per predicted class and their share."""
    counts = pred.groupBy(prediction).agg(F.count(F.lit(1)).alias("windows"))
    # unpartitioned window over the grouped table: one row per predicted class
    return counts.select(prediction, "windows",
                         (F.col("windows").cast("double") / F.sum("windows").over(Window.partitionBy()))
                         .alias("share"))


def threshold_sweep(pred: DataFrame, step: float = 0.05, score: str = "prob_anomalous",
                    label: str = LABEL) -> DataFrame:
    """Precision and recall at thresholds ``step, 2*step, ... < 1``.

    No cross join: each row is counted once in the bucket of the highest
    threshold it exceeds; a descending running sum over the (few) threshold
    buckets gives the rows above each threshold.
    """
    m = int(round(1.0 / step)) - 1
    s = F.col(score)
    # number of grid thresholds strictly below the score, 0..m
    idx = F.least(F.lit(m), F.greatest(F.lit(0), F.ceil(s / F.lit(step)).cast("int") - 1))
    per = pred.groupBy(idx.alias("i")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    # every bucket 0..m, including empty ones (a left join the tiny grid can broadcast)
    grid = pred.sparkSession.range(0, m + 1).select(F.col("id").cast("int").alias("i"))
    above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    table = (grid.join(per, "i", "left").fillna(0, ["pos", "neg"])
             .select("i", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
                     F.sum("pos").over(everything).alias("p")))
    return table.filter(F.col("i") >= 1).select(
        F.round(F.col("i") * F.lit(step), 10).alias("threshold"),
        F.col("tp"), F.col("fp"), (F.col("p") - F.col("tp")).alias("fn"),
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("p")), F.lit(0.0)).alias("recall"))


def auc(pred: DataFrame, score: str = "prob_anomalous", label: str = LABEL,
        buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (Mann-Whitney: a positive scores above
    a negative, ties count one half), plus the class counts.

    Rows are first grouped by distinct score (map-side combine), then a
    distributed running count of negatives along the score order gives each
    score's negatives below.
    """
    per_score = pred.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("n_pos"),
                                        F.count_if(F.col(label) == 0).alias("n_neg"))
    bucket = quantile_bucket(per_score, score, buckets)
    run = prefix_sums(per_score, [score], {"neg": F.col("n_neg"), "pos": F.col("n_pos")}, bucket)
    below = F.col("cum_neg") - F.col("n_neg")
    wins = F.col("n_pos").cast("double") * (below.cast("double") + F.lit(0.5) * F.col("n_neg"))
    return run.agg(
        F.try_divide(F.sum(wins), F.first("total_pos").cast("double") * F.first("total_neg")).alias("auc"),
        F.first("total_pos").alias("positives"),
        F.first("total_neg").alias("negatives"))


def grouped_auc(pred: DataFrame, by: list[str], score: str, bucket: Column, label: str = LABEL) -> DataFrame:
    """:func:`auc` of every group in one job: (by..., positives, negatives,
    auc); the area is null where a class is missing.

    ``bucket`` must not decrease with ``score``.  Rows are grouped by distinct
    score first; the running count inside a bucket starts from the totals of
    the buckets below, so no task sorts a whole group.
    """
    per_score = (pred.groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("n_pos"),
                                              F.count_if(F.col(label) == 0).alias("n_neg"))
                 .withColumn("_bucket", bucket))
    below = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (per_score.groupBy(*by, "_bucket").agg(F.sum("n_neg").alias("_n"))
              .select(*by, "_bucket", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before")))
    inside = Window.partitionBy(*by, "_bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    run = per_score.withColumn("_within", F.coalesce(F.sum("n_neg").over(inside), F.lit(0))).join(starts, [*by, "_bucket"])
    wins = F.col("n_pos").cast("double") * ((F.col("_before") + F.col("_within")).cast("double") + 0.5 * F.col("n_neg"))
    out = run.groupBy(*by).agg(F.sum("n_pos").alias("positives"), F.sum("n_neg").alias("negatives"),
                               F.sum(wins).alias("_wins"))
    return out.select(*by, "positives", "negatives", F.try_divide(
        F.col("_wins"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"))
