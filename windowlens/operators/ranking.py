"""Distributed running sums and global ranks.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one
task.  Here an ordered frame is first cut into buckets that are monotone in
the sort order (days of a timestamp, or ranges between approximate quantiles
of a score).  Per-bucket totals are small (one row per bucket), their
exclusive prefix gives each bucket's offset, and the running sum inside a
bucket is a window partitioned by the bucket.  Each task therefore holds one
bucket at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def prefix_sums(df: DataFrame, order: Sequence[str], values: dict[str, Column],
                bucket: Column) -> DataFrame:
    """Add ``cum_<name>`` (inclusive running sum in ``order``) and
    ``total_<name>`` (grand total) for every entry of ``values``.

    ``bucket`` must be non-decreasing along ``order``.
    """
    names = list(values)
    b = df.select("*", bucket.alias("_bucket"), *[v.alias(f"_v_{n}") for n, v in values.items()])
    per = b.groupBy("_bucket").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = per.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names],
        *[F.sum(f"_t_{n}").over(everything).alias(f"total_{n}") for n in names])
    inside = (Window.partitionBy("_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = b.join(offsets, "_bucket")
    return joined.select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(inside)).alias(f"cum_{n}") for n in names],
        *[F.col(f"total_{n}") for n in names])


def day_bucket(ts: str) -> Column:
    return F.date_trunc("day", F.col(ts))


def quantile_bucket(df: DataFrame, column: str, buckets: int | None = None, accuracy: int = 10000) -> Column:
    """A bucket expression for ``column`` from approximate quantiles.

    One aggregate pass computes ``buckets - 1`` cut points; only these few
    numbers reach the driver.  By default there are as many buckets as
    shuffle partitions, so the tasks grow with the cluster; at most 1,024,
    because the cut points become part of the expression.  The bucket of a value is the number of cut
    points below it, so buckets are monotone and roughly equal in size.
    """
    if buckets is None:
        buckets = min(1024, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(F.col(column).cast("double"), probs, accuracy).alias("c")).first()["c"]
    cuts = sorted(set(c for c in (cuts or []) if c is not None))
    if not cuts:
        return F.lit(0)
    arr = F.array(*[F.lit(float(c)) for c in cuts])
    return F.size(F.filter(arr, lambda c: c < F.col(column).cast("double")))


def global_rank(df: DataFrame, order_col: str, bucket: Column | None = None,
                name: str = "global_rank") -> DataFrame:
    """1-based rank of every row in ``order_col`` order (ties broken by the
    row order inside a bucket, so use a unique key), plus ``total_rows``."""
    bucket = day_bucket(order_col) if bucket is None else bucket
    out = prefix_sums(df, [order_col], {"rows": F.lit(1)}, bucket)
    return out.withColumnRenamed("cum_rows", name)
