"""The three stages of the original job as plain DataFrame functions.

``extract`` -> ``transform`` -> ``load`` give the same outputs as the
original Extract / Transform / Load scripts, but return DataFrames instead
of printing, and leave materialisation to the caller: compose them lazily
into one plan (Catalyst then prunes the enrichment columns the features never
read), or write each stage's output to share it between jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from windowlens.functions import fixed
from windowlens.operators import clean, enrich, evaluate, features, labels, model, parse, sink, split, traffic


def sample_lines(lines: DataFrame, fraction: float, seed: int = 0, value_col: str = "value") -> DataFrame:
    """A repeatable share of raw lines (by a seeded hash of their text), for
    trial runs."""
    return traffic.hash_sample(lines, value_col, fraction, seed)


def extract(lines: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Raw lines -> parsed string fields, tag and reason, enriched with the
    endpoint dimension (left join).  No line is
    dropped; rejected lines stay, tagged."""
    parsed = parse.parse_lines(lines)
    return parsed if dimension is None else enrich.enrich(parsed, dimension)


def write_stage(table: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write the output of ``extract`` or ``transform`` as Parquet and return
    the table read back."""
    table.write.mode(mode).parquet(path)
    return table.sparkSession.read.parquet(path)


def transform(extracted: DataFrame, label_df: DataFrame | None = None,
              width: str = fixed.WINDOW_WIDTH, method: str = "exact") -> DataFrame:
    """Accepted rows -> typed -> deduplicated -> window features, joined to
    the label calendar when given (every labelled window kept)."""
    rows = clean.dedupe(clean.typed_rows(extracted))
    feats = features.window_features(rows, width, method=method)
    return feats if label_df is None else labels.attach_labels(label_df, feats)


def load(spark: SparkSession, table: DataFrame, path: str, ts: str = "window_start") -> DataFrame:
    """Write partitioned by date (dynamic overwrite) and return the re-read
    table (``date`` comes back as DATE through partition discovery)."""
    sink.write_partitioned(sink.with_date(table, ts), path)
    return spark.read.parquet(path)


def train(spark: SparkSession, features_table: DataFrame, model_path: str,
          fraction: float = fixed.TRAIN_FRACTION, folds: int = fixed.CV_FOLDS, seed: int = fixed.CV_SEED):
    """Chronological split, grid search with cross-validation on the train
    part, best model refit and saved, test part scored.

    Returns ``(grid, test_predictions, test_metrics, coefficients)`` as
    DataFrames; rows without features are skipped.
    """
    parts = split.chrono_split(labels.with_features_only(features_table), fraction)
    cv_model = model.cross_validate(split.train_part(parts), folds=folds, seed=seed)
    best = cv_model.bestModel
    model.save(best, model_path)
    predictions = model.score(best, split.test_part(parts))
    metrics = evaluate.metrics(evaluate.confusion(predictions))
    return model.grid_table(spark, cv_model), predictions, metrics, model.coefficient_table(spark, best)


def predict(model_path: str, features_table: DataFrame, out_path: str | None = None):
    """Score a (later) labelled feature table with a saved model; returns
    ``(predictions, confusion, metrics, prediction_distribution)``.  With
    ``out_path`` the predictions are written there in time order, and the
    reports read the written table."""
    predictions = model.score(model.load(model_path), labels.with_features_only(features_table))
    if out_path is not None:
        sink.write_predictions(predictions, out_path)
        predictions = features_table.sparkSession.read.parquet(out_path)
    confusion = evaluate.confusion(predictions)
    return predictions, confusion, evaluate.metrics(confusion), evaluate.prediction_distribution(predictions)
