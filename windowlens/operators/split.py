"""Chronological train/test split of a window table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.functions.expressions import text_timestamp
from windowlens.operators.ranking import global_rank


def chrono_split(df: DataFrame, fraction: float = fixed.TRAIN_FRACTION,
                 ts: str = "window_start") -> DataFrame:
    """Rank windows by time; the first ``floor(N * fraction)`` are ``train``,
    the rest ``test``.  Adds ``split_rank`` (1..N) and ``part``.

    The rank comes from a distributed prefix count over day buckets (see
    :mod:`windowlens.operators.ranking`), not a global ``row_number``.
    ``ts`` must be unique (true for window starts).
    """
    ranked = global_rank(df, ts, name="split_rank")
    k = F.floor(F.col("total_rows") * F.lit(float(fraction)))
    return ranked.select(*df.columns, F.col("split_rank"),
                         F.when(F.col("split_rank") <= k, F.lit("train")).otherwise(F.lit("test")).alias("part"))


def train_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("part") == "train").drop("split_rank", "part")


def test_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("part") == "test").drop("split_rank", "part")


def split_summary(split: DataFrame, ts: str = "window_start") -> DataFrame:
    """One row: windows, train and test counts, the last train window and
    the first test window as UTC text (NULL when a part is empty)."""
    train = F.col("part") == "train"
    test = F.col("part") == "test"
    return split.agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(train).alias("train_windows"),
        F.count_if(test).alias("test_windows"),
        text_timestamp(F.max(F.when(train, F.col(ts)))).alias("last_train_window"),
        text_timestamp(F.min(F.when(test, F.col(ts)))).alias("first_test_window"),
    )


def class_balance(split: DataFrame, label: str = fixed.LABEL_COLUMN) -> DataFrame:
    """Windows per (part, label)."""
    return split.groupBy("part", label).agg(F.count(F.lit(1)).alias("windows"))
