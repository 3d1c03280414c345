"""Mergeable sketches: quantiles and distinct counts without the rows.

A sketch a window (or day) is written once; wider windows and any range of
days come from merging sketches, so a re-plan of the reporting widths never
goes back to the log.  Both kinds are Spark's own aggregates (KLL and HLL),
with partial aggregation; a sketch has a bounded size whatever its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.functions.expressions import is_error

KLL_K = 1000       # items a KLL sketch keeps at its widest level
HLL_LG_K = 14      # 2**14 registers


def kll_rank_error(k: int = KLL_K) -> float:
    """Rank error of a KLL quantile, as a share of the rows: 3.5 times the
    figure published for 99% confidence, ``2.296 / k ** 0.9723``."""
    return 3.5 * 2.296 / k ** 0.9723


def hll_error(lg_k: int = HLL_LG_K) -> float:
    """Relative error of a united HLL count: four standard errors,
    ``1.04 / sqrt(2 ** lg_k)`` each."""
    return 4 * 1.04 / 2 ** (lg_k / 2)


def window_sketches(rows: DataFrame, width: str = fixed.WINDOW_WIDTH, ts: str = "ts", status: str = "status_code",
                    size: str = "response_size", min_status: int = fixed.ERROR_STATUS_MIN, k: int = KLL_K) -> DataFrame:
    """(window_start, sums, sizes): counts that add up and a KLL sketch of
    the sizes, per tumbling window."""
    err = is_error(status, min_status)
    out = rows.groupBy(F.window(F.col(ts), width).alias("window")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(err).alias("judged"), F.sum(err).alias("errors"),
        F.count(size).alias("sized"), F.sum(size).alias("size_sum"), F.kll_sketch_agg_bigint(size, k).alias("sizes"))
    return out.select(F.col("window.start").alias("window_start"), *out.columns[1:])


def roll_up(sketches: DataFrame, width: str) -> DataFrame:
    """The same table for a width that is a multiple of the present one."""
    sums = ["rows", "judged", "errors", "sized", "size_sum"]
    out = sketches.groupBy(F.window("window_start", width).alias("window")).agg(
        *[F.sum(c).alias(c) for c in sums], F.kll_merge_agg_bigint("sizes").alias("sizes"))
    return out.select(F.col("window.start").alias("window_start"), *sums, "sizes")


def sketch_features(sketches: DataFrame, percentile: float = fixed.SIZE_PERCENTILE) -> DataFrame:
    """The window features; the percentile is a size whose rank is off by
    :func:`kll_rank_error` at most, all else is exact."""
    quantile = F.when(F.col("sized") > 0, F.kll_sketch_get_quantile_bigint("sizes", F.lit(percentile)))
    return sketches.select(
        "window_start", F.col("rows").alias("total_requests"),
        F.try_divide(F.col("errors").cast("double"), F.col("judged")).alias("error_rate"),
        F.try_divide(F.col("size_sum").cast("double"), F.col("sized")).alias("avg_response_size"),
        quantile.cast("double").alias("p95_response_size"))


def rank_within(value: Column, below: Column, upto: Column, n: Column, q: float, error: float) -> Column:
    """Whether ``value`` lies at rank ``q`` give or take ``error``: ``below``
    rows of ``n`` are smaller, ``upto`` not larger."""
    return value.isNull() | ((below <= (q + error) * n + 1) & (upto >= (q - error) * n - 1))


def rank_check(features: DataFrame, rows: DataFrame, width: str, error: float,
               percentile: float = fixed.SIZE_PERCENTILE, ts: str = "ts", size: str = "response_size") -> DataFrame:
    """(window_start, within): each approximate percentile of ``features``
    against the exact ranks of ``rows``."""
    sizes = rows.where(F.col(size).isNotNull()).select(
        F.window(F.col(ts), width).start.alias("window_start"), F.col(size).alias("_size"))
    value = F.col("p95_response_size")
    ranks = features.join(sizes, "window_start", "left").groupBy("window_start", "p95_response_size").agg(
        F.count("_size").alias("n"), F.count_if(F.col("_size") < value).alias("below"),
        F.count_if(F.col("_size") <= value).alias("upto"))
    return ranks.select("window_start", rank_within(value, F.col("below"), F.col("upto"), F.col("n"), percentile, error)
                        .alias("within"))


def distinct_sketches(rows: DataFrame, column: str, by: Column, lg_k: int = HLL_LG_K) -> DataFrame:
    """(part, values): an HLL sketch of a column's values per part (nulls
    aside)."""
    return rows.groupBy(by.alias("part")).agg(F.hll_sketch_agg(column, lg_k).alias("values"))


def distinct_over(sketches: DataFrame, span: Column) -> DataFrame:
    """(span, distinct_values): estimates for unions of parts."""
    return sketches.groupBy(span.alias("span")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_values"))
