"""Window labels: rule labels, sampled labels, the label join and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.functions import fixed
from windowlens.functions.expressions import seeded_hash, stamp_of, text_timestamp
from windowlens.operators.ranking import global_rank

LABEL_COLUMNS = ("window_start", "is_anomalous", "anomaly_type")
FEATURES = tuple(fixed.FEATURE_COLUMNS)


def pick_labels(spine: DataFrame, fraction: float = fixed.ANOMALY_WINDOW_FRACTION,
                seed: int = 42, types: tuple[str, ...] = tuple(fixed.ANOMALY_TYPES)) -> DataFrame:
    """Label ``round(N * fraction)`` windows anomalous, chosen by the order of
    a seeded hash of their stamps; their types alternate in time order.

    Both orders are distributed ranks (by the first digits of the hash, by
    day), so no task sees the whole calendar.
    """
    n = spine.count()
    k = int(round(n * fraction))  # half to even
    hashed = spine.select("window_start", seeded_hash(text_timestamp("window_start"), seed).alias("_h"))
    picked = (global_rank(hashed, "_h", F.substring("_h", 1, 2)).where(F.col("global_rank") <= k)
              .select("window_start"))
    turn = (F.col("global_rank") - 1) % len(types) + 1
    kind = F.element_at(F.array(*[F.lit(t) for t in types]), turn.cast("int"))
    marks = global_rank(picked, "window_start").select("window_start", kind.alias("_kind"))
    return (spine.join(marks, "window_start", "left")
            .select("window_start",
                    F.when(F.col("_kind").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("is_anomalous"),
                    F.coalesce(F.col("_kind"), F.lit("none")).alias("anomaly_type")))


def attach_labels(label_df: DataFrame, features: DataFrame) -> DataFrame:
    """Labels (the window calendar) left-joined with features.

    Every labelled window is kept; windows without rows get NULL features.
    Feature windows outside the labels are not returned here; see
    :func:`unlabeled_windows`.  Both sides are keyed by window, so their size
    grows with the time span, not with the raw rows; the join strategy is
    left to AQE (broadcast when the runtime size is small, else sort-merge).
    """
    return label_df.join(features, "window_start", "left").select(*LABEL_COLUMNS, *FEATURES)


def with_features_only(labeled: DataFrame) -> DataFrame:
    """Skip policy: drop labelled windows without features (NULL features
    would fail a vector assembler)."""
    return labeled.filter(F.col("total_requests").isNotNull())


def fill_missing_features(labeled: DataFrame) -> DataFrame:
    """Fill policy: a window without rows has 0 requests and 0 rates/sizes."""
    return labeled.fillna({c: 0 for c in FEATURES})


def label_coverage(labeled: DataFrame) -> DataFrame:
    """One row: windows, anomalous windows, windows without features,
    windows without labels."""
    return labeled.agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("is_anomalous") == 1).alias("anomalous"),
        F.count_if(F.col("total_requests").isNull()).alias("null_features"),
        F.count_if(F.col("is_anomalous").isNull()).alias("null_labels"),
    )


def label_mix(label_df: DataFrame) -> DataFrame:
    """Windows per anomaly type and their share of all windows."""
    counts = label_df.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("windows"))
    # unpartitioned window over the grouped table: one row per label type
    total = F.sum("windows").over(Window.partitionBy())
    return counts.select("anomaly_type", "windows",
                         (F.col("windows").cast("double") / total).alias("share"))


def unlabeled_windows(features: DataFrame, label_df: DataFrame) -> DataFrame:
    """Feature windows that have no label (left anti join)."""
    return features.join(label_df.select("window_start"), "window_start", "left_anti")


def write_labels_csv(label_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write labels as CSV with a header, timestamps as ``yyyy-MM-dd HH:mm:ss``."""
    (label_df.select(text_timestamp("window_start").alias("window_start"),
                     "is_anomalous", "anomaly_type")
     .write.mode(mode).option("header", True).csv(path))


LABEL_CSV_SCHEMA = "window_start STRING, is_anomalous STRING, anomaly_type STRING"


def read_labels_csv(spark, path: str) -> DataFrame:
    """Read a label CSV with an explicit schema.  Stamps must have the form
    ``yyyy-MM-dd HH:mm:ss`` in full and be real dates; the label must be an
    int.  Anything else becomes NULL instead of failing the job;
    :func:`stamp_report` counts such rows."""
    return labels_of_text(spark.read.schema(LABEL_CSV_SCHEMA).option("header", True).csv(path))


def labels_of_text(raw: DataFrame) -> DataFrame:
    """Typed label rows of the text columns of a label CSV."""
    return raw.select(stamp_of("window_start").alias("window_start"),
                      F.col("is_anomalous").try_cast("int").alias("is_anomalous"),
                      "anomaly_type")


def stamp_report(label_df: DataFrame) -> DataFrame:
    """One row: label rows, rows without a usable stamp, rows without a
    usable label."""
    return label_df.agg(F.count(F.lit(1)).alias("rows"),
                        F.count_if(F.col("window_start").isNull()).alias("bad_stamps"),
                        F.count_if(F.col("is_anomalous").isNull()).alias("bad_labels"))
