"""Logistic-regression model on window features (Spark MLlib).

Training data is the window table (one row per window), so fits are small
distributed jobs; scoring is ``PipelineModel.transform``, a projection that
runs inside the scan's tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.functions.expressions import seeded_hash, text_timestamp
from windowlens.operators.evaluate import grouped_auc
from windowlens.operators.ranking import global_rank
from windowlens.session import checkpoint_dir

FEATURES = list(fixed.FEATURE_COLUMNS)
LABEL = fixed.LABEL_COLUMN


def pipeline(features: Sequence[str] = FEATURES, label: str = LABEL, **settings) -> Pipeline:
    """Feature assembler (rows with NULL features are skipped) followed by a
    logistic regression with internal standardisation; ``settings`` are the
    regression's own parameters."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=[*features], outputCol="features", handleInvalid="skip"),
        LogisticRegression(labelCol=label, featuresCol="features", **settings)])


def regression(stages) -> object:
    """The regression stage of a pipeline or of a fitted one."""
    return (stages.getStages() if isinstance(stages, Pipeline) else stages.stages)[-1]


def grid_points(reg_params: Sequence[float] = fixed.GRID_REG_PARAM,
                elastic_nets: Sequence[float] = fixed.GRID_ELASTIC_NET) -> list[tuple[float, float]]:
    return [(float(r), float(e)) for r, e in product(reg_params, elastic_nets)]


def auc_evaluator(label: str = LABEL, exact: bool = True) -> BinaryClassificationEvaluator:
    """Area under ROC; ``exact`` uses every distinct score (numBins=0)."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC",
                                         numBins=0 if exact else 1000)


def cross_validate(train: DataFrame, folds: int = fixed.CV_FOLDS, seed: int = fixed.CV_SEED,
                   parallelism: int = 9, features: Sequence[str] = FEATURES, label: str = LABEL,
                   reg_params: Sequence[float] = fixed.GRID_REG_PARAM,
                   elastic_nets: Sequence[float] = fixed.GRID_ELASTIC_NET,
                   key: str = "window_start"):
    """Grid search with k-fold cross-validation; returns the fitted
    ``CrossValidatorModel`` (best model refit on all of ``train``).

    Folds come from a seeded hash of ``key`` (:func:`hash_fold`), so the
    assignment is the same on every run and every partitioning; grid points
    are fitted ``parallelism`` at a time.
    """
    estimator = pipeline(features, label)
    lr = regression(estimator)
    grid = [{lr.regParam: r, lr.elasticNetParam: e} for r, e in grid_points(reg_params, elastic_nets)]
    with_fold = train.withColumn("_fold", hash_fold(key, folds, seed))
    # Materialise the (window-sized) training table once in the shared
    # checkpoint folder: folds and refits then read it instead of recomputing
    # the whole feature plan, and a lost executor does not lose it.
    checkpoint_dir(train.sparkSession)
    with_fold = with_fold.checkpoint(eager=True)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid,
                        evaluator=auc_evaluator(label), numFolds=folds, seed=seed,
                        parallelism=parallelism, foldCol="_fold")
    return cv.fit(with_fold)


def hash_fold(key: str, folds: int, seed: int) -> Column:
    """Fold 0 to ``folds - 1`` of a row, from a seeded hash of a stamp that is
    the same on every engine."""
    digits = F.substring(seeded_hash(text_timestamp(key), seed), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % folds).cast("int")


def fit_folds(table: DataFrame, folds: Sequence[int], points: Sequence[tuple[float, float]], forward: bool = False,
              parallelism: int = 8, features: Sequence[str] = FEATURES, label: str = LABEL) -> dict:
    """{(fold, point): fitted model}: every grid point fitted on the rows
    outside the fold (``forward``: before it), several at a time.  ``table``
    has ``_fold`` and should be stored: every fit reads it."""
    def one(job):
        fold, (reg, enet) = job
        rows = table.where(F.col("_fold") < fold) if forward else table.where(F.col("_fold") != fold)
        return fit(rows, reg, enet, features, label)

    jobs = list(product(folds, points))
    with ThreadPoolExecutor(parallelism) as pool:
        return dict(zip(jobs, pool.map(one, jobs)))


def fold_areas(table: DataFrame, fitted: dict, forward: bool = False, label: str = LABEL) -> DataFrame:
    """(fold, reg_param, elastic_net, train_rows, valid_rows, positives, auc):
    every model judged on its own fold, all in one grouped rank-sum job.

    Validation rows meet the coefficients of their fold's models (a table of
    folds x grid points) and are ranked by the margin."""
    spark = table.sparkSession
    terms = [(fold, reg, enet, [float(c) for c in regression(m).coefficients], float(regression(m).intercept))
             for (fold, (reg, enet)), m in fitted.items()]
    names = next(iter(fitted.values())).stages[0].getInputCols()
    models = spark.createDataFrame(terms, "_fold int, reg_param double, elastic_net double, c array<double>, b double")
    margin = F.lit(0.0)
    for i, name in enumerate(names):
        margin = margin + F.col("c")[i] * F.col(name).cast("double")
    by = ["_fold", "reg_param", "elastic_net"]
    scored = (table.select("_fold", label, *names).join(models, "_fold")
              .select(*by, label, (margin + F.col("b")).alias("margin")))
    share = F.floor(F.lit(256) / (1 + F.exp(-F.col("margin"))))
    areas = grouped_auc(scored, by, "margin", share, label)
    rows = table.groupBy("_fold").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("_fold", "of")
    usable = rows["of"] < models["_fold"] if forward else rows["of"] != models["_fold"]
    learnt = models.join(rows, usable).groupBy(*by).agg(F.sum("n").alias("train_rows"))
    return areas.join(learnt, by).select(
        F.col("_fold").alias("fold"), "reg_param", "elastic_net", "train_rows",
        (F.col("positives") + F.col("negatives")).alias("valid_rows"), "positives", "auc")


def repeated_cv(spark: SparkSession, train: DataFrame, seeds: Sequence[int] = (42, 7, 123),
                folds: int = fixed.CV_FOLDS, parallelism: int = 8,
                reg_params: Sequence[float] = fixed.GRID_REG_PARAM,
                elastic_nets: Sequence[float] = fixed.GRID_ELASTIC_NET,
                features: Sequence[str] = FEATURES, label: str = LABEL, key: str = "window_start") -> DataFrame:
    """Cross-validation repeated with several fold seeds: (seed, fold,
    reg_param, elastic_net, train_rows, valid_rows, positives, auc).  The
    training table is stored once; each seed is one job of areas."""
    checkpoint_dir(spark)
    base, points = train.checkpoint(eager=True), grid_points(reg_params, elastic_nets)
    out = None
    for seed in seeds:
        table = base.withColumn("_fold", hash_fold(key, folds, seed))
        fitted = fit_folds(table, range(folds), points, False, parallelism, features, label)
        areas = fold_areas(table, fitted, label=label).withColumn("seed", F.lit(seed))
        out = areas if out is None else out.unionByName(areas)
    return out


def over_seeds(areas: DataFrame) -> DataFrame:
    """Mean and spread over the seeds of each grid point's mean area."""
    per_seed = areas.groupBy("seed", "reg_param", "elastic_net").agg(F.avg("auc").alias("avg_auc"))
    return per_seed.groupBy("reg_param", "elastic_net").agg(
        F.avg("avg_auc").alias("mean_auc"), F.stddev("avg_auc").alias("std_auc_across_seeds"),
        F.count(F.lit(1)).alias("seeds"))


def grid_table(spark: SparkSession, cv_model) -> DataFrame:
    """(reg_param, elastic_net, avg_auc, std_auc, best) per grid point;
    ``best`` marks the point the refitted model has."""
    won = regression(cv_model.bestModel)
    table = spark.createDataFrame(
        [({p.name: float(v) for p, v in point.items()}, float(mean), float(spread)) for point, mean, spread in
         zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, cv_model.stdMetrics)],
        "point map<string,double>, avg_auc double, std_auc double")
    point = F.col("point")
    best = ((point["regParam"] == won.getRegParam()) & (point["elasticNetParam"] == won.getElasticNetParam()))
    return table.select(point["regParam"].alias("reg_param"), point["elasticNetParam"].alias("elastic_net"),
                        "avg_auc", "std_auc", best.alias("best"))


def time_blocks(df: DataFrame, folds: int = fixed.CV_FOLDS, ts: str = "window_start") -> DataFrame:
    """``df`` with ``_fold``: blocks 0 to ``folds`` of equal length in time
    order, from a distributed rank."""
    ranked = global_rank(df, ts)
    block = F.floor((F.col("global_rank") - 1) * F.lit(folds + 1) / F.col("total_rows")).cast("int")
    return ranked.withColumn("_fold", block).drop("global_rank", "total_rows")


def time_folds(df: DataFrame, folds: int = fixed.CV_FOLDS, ts: str = "window_start"):
    """Forward-chaining folds: fold i trains on the first i blocks of time
    and validates on block i+1.  Yields (train, validation) frame pairs."""
    blocked = time_blocks(df, folds, ts)
    for i in range(1, folds + 1):
        yield blocked.filter(F.col("_fold") < i).drop("_fold"), blocked.filter(F.col("_fold") == i).drop("_fold")


def cross_validate_time(spark: SparkSession, train: DataFrame, folds: int = fixed.CV_FOLDS,
                        reg_params: Sequence[float] = fixed.GRID_REG_PARAM,
                        elastic_nets: Sequence[float] = fixed.GRID_ELASTIC_NET,
                        features: Sequence[str] = FEATURES, label: str = LABEL, parallelism: int = 8) -> DataFrame:
    """Grid search on forward-chaining time folds: every grid point is fitted
    on the past and judged on the next block; returns :func:`fold_areas`.  A
    fold whose block has a single class has a null area.  The blocks are
    ranked and stored once."""
    checkpoint_dir(spark)
    table = time_blocks(train, folds).checkpoint(eager=True)
    points = grid_points(reg_params, elastic_nets)
    return fold_areas(table, fit_folds(table, range(1, folds + 1), points, True, parallelism, features, label),
                      True, label)


def mean_areas(areas: DataFrame) -> DataFrame:
    """(reg_param, elastic_net, avg_auc, folds_used) of fold areas."""
    return areas.groupBy("reg_param", "elastic_net").agg(F.avg("auc").alias("avg_auc"),
                                                         F.count("auc").alias("folds_used"))


def fit(train: DataFrame, reg_param: float = 0.01, elastic_net: float = 0.0,
        features: Sequence[str] = FEATURES, label: str = LABEL) -> PipelineModel:
    return pipeline(features, label, regParam=reg_param, elasticNetParam=elastic_net).fit(train)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame,
          keep: Sequence[str] = ("window_start", LABEL, "anomaly_type")) -> DataFrame:
    """``prediction`` and ``prob_anomalous`` = P(class 1) per row."""
    out = model.transform(df)
    return out.select(*keep, "prediction",
                      vector_to_array(F.col("probability")).getItem(1).alias("prob_anomalous"))


def coefficient_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(term, coefficient): one row per feature plus the intercept, named
    after the inputs of the fitted assembler."""
    fitted = regression(model)
    terms = dict(zip(model.stages[0].getInputCols(), fitted.coefficients), intercept=fitted.intercept)
    return spark.createDataFrame([(t, float(c)) for t, c in terms.items()], "term string, coefficient double")


def closed_form(model: PipelineModel) -> dict:
    """Coefficients and intercept as ``evaluate.score_logistic`` takes them."""
    fitted = regression(model)
    names = model.stages[0].getInputCols()
    return {"coefficients": dict(zip(names, map(float, fitted.coefficients))), "intercept": float(fitted.intercept)}


def gradient(scored: DataFrame, model: PipelineModel, label: str = LABEL) -> DataFrame:
    """(term, slope): the slope of the ridge-penalised mean log loss at the
    model's coefficients, in units of the standardised features; near zero at
    the optimum.  ``scored`` has the features, the label and
    ``prob_anomalous``."""
    fitted, names = regression(model), model.stages[0].getInputCols()
    miss = F.col("prob_anomalous") - F.col(label)
    sums = scored.agg(*[F.avg(miss * F.col(n)).alias(f"g_{n}") for n in names], F.avg(miss).alias("g"),
                      *[F.stddev_samp(n).alias(f"s_{n}") for n in names])
    penalty = fitted.getRegParam() * (1 - fitted.getElasticNetParam())
    slopes = [F.struct(F.lit(n).alias("term"), F.when(F.col(f"s_{n}") > 0, F.col(f"g_{n}") / F.col(f"s_{n}") +
                       penalty * float(c) * F.col(f"s_{n}")).otherwise(0.0).alias("slope"))
              for n, c in zip(names, fitted.coefficients)]
    slopes.append(F.struct(F.lit("intercept").alias("term"), F.col("g").alias("slope")))
    return sums.select(F.inline(F.array(*slopes)))
