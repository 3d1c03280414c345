"""Dimension enrichment and its coverage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(rows: DataFrame, dim: DataFrame, key: str = "endpoint", broadcast: bool = False) -> DataFrame:
    """Left join ``rows`` with a dimension keyed by ``key``.

    No row of ``rows`` is lost (unmatched rows get NULL dimension columns).
    Spark picks the strategy from the dimension's size (file size at planning
    time, shuffled size at run time): broadcast below
    ``spark.sql.autoBroadcastJoinThreshold``, else a shuffled join whose hot
    keys AQE splits.  ``broadcast=True`` is for a caller that knows a bound.
    A unique dimension key means no fan-out; :func:`coverage` reports
    duplicate keys.
    """
    return rows.join(F.broadcast(dim) if broadcast else dim, key, "left")


def row_preservation(raw: DataFrame, parsed: DataFrame, enriched: DataFrame) -> DataFrame:
    """``(step, rows)`` for raw lines, parsed and enriched rows side by side,
    and the rows lost or added on the way (0 when all are equal)."""
    steps = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("step"), "rows")
             for name, df in (("raw", raw), ("parsed", parsed), ("enriched", enriched))]
    counts = steps[0].unionByName(steps[1]).unionByName(steps[2])
    drift = counts.agg((F.max("rows") - F.min("rows")).alias("rows")).select(F.lit("drift").alias("step"), "rows")
    return counts.unionByName(drift)


def coverage(rows: DataFrame, dim: DataFrame, key: str = "endpoint") -> DataFrame:
    """Problems of an enrichment as ``(issue, key, rows)``:

    * ``no_dimension_row``: key values of ``rows`` missing in the dimension,
      with how many rows carry them (rows are counted per key first, so only
      one row per key reaches the anti join);
    * ``duplicate_key``: dimension keys present more than once (would fan out).
    """
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    missing = (per_key.join(dim.select(key), key, "left_anti")
               .select(F.lit("no_dimension_row").alias("issue"), key, "rows"))
    dups = (dim.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1)
            .select(F.lit("duplicate_key").alias("issue"), key, "rows"))
    return missing.unionByName(dups)


def enriched_sample(enriched: DataFrame, n: int = 5, order=("ts", "endpoint", "status_code", "response_size")) -> DataFrame:
    """The first ``n`` enriched rows in a total order (NULLs last): a
    stable sample."""
    return enriched.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)
