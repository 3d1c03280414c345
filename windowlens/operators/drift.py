"""Feature drift between two periods: population stability index (PSI)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.functions import fixed

DEFAULT_CUTS = (0.25, 0.5, 0.75)


def _long(df: DataFrame, features: Sequence[str], period: str) -> DataFrame:
    """(period, feature, value) rows; ``stack`` keeps it one pass, no union."""
    args = [x for f in features for x in (F.lit(f), F.col(f).cast("double"))]
    return df.select(F.lit(period).alias("period"),
                     F.stack(F.lit(len(features)), *args).alias("feature", "value"))


def psi(reference: DataFrame, current: DataFrame,
        features: Sequence[str] = tuple(fixed.FEATURE_COLUMNS),
        cuts: Sequence[float] = DEFAULT_CUTS, smoothing: float = 0.5) -> DataFrame:
    """PSI per feature: sum over buckets of (q - p) * ln(q / p).

    Bucket edges are exact quantiles (``cuts``) of the reference period, one
    row per feature; a value falls in bucket 1 + (edges below it).  Shares
    are smoothed by ``smoothing`` per bucket so an empty bucket does not
    divide by zero.  The edge table has one row per feature, so it is
    broadcast.
    """
    n_buckets = len(cuts) + 1
    rows = _long(reference, features, "reference").unionByName(_long(current, features, "current"))
    rows = rows.filter(F.col("value").isNotNull())
    edges = (rows.filter(F.col("period") == "reference").groupBy("feature")
             .agg(F.percentile("value", F.array(*[F.lit(float(c)) for c in cuts])).alias("edges")))
    bucket = F.lit(1) + F.size(F.filter(F.col("edges"), lambda e: e < F.col("value")))
    counted = (rows.join(F.broadcast(edges), "feature")
               .groupBy("feature", bucket.alias("bucket"))
               .agg(F.count_if(F.col("period") == "reference").alias("n_ref"),
                    F.count_if(F.col("period") == "current").alias("n_cur")))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(1), F.lit(n_buckets))).alias("bucket"))
    full = grid.join(counted, ["feature", "bucket"], "left").fillna(0, ["n_ref", "n_cur"])
    per_feature = Window.partitionBy("feature")
    s = F.lit(float(smoothing))
    p = (F.col("n_ref") + s) / (F.sum("n_ref").over(per_feature) + s * n_buckets)
    q = (F.col("n_cur") + s) / (F.sum("n_cur").over(per_feature) + s * n_buckets)
    shares = full.select("feature", "bucket", p.alias("p"), q.alias("q"))
    return (shares.groupBy("feature")
            .agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi")))
