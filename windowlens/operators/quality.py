"""Feature-table quality reports, returned as tables instead of print-outs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.functions import fixed
from windowlens.functions.expressions import bucket_of


def distribution(df: DataFrame, column: str = "error_rate", approx_distinct: bool = False) -> DataFrame:
    """One row: min, max, mean, distinct values (NULL counted as one value,
    like ``select(c).distinct().count()``) and windows where the value is 0.

    ``approx_distinct`` uses a HyperLogLog sketch instead of an exact
    distinct count, for very large inputs."""
    c = F.col(column)
    distinct = F.approx_count_distinct(c) if approx_distinct else F.count_distinct(c)
    return df.agg(
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.avg(c).alias("mean_value"),
        (distinct + F.max(F.when(c.isNull(), 1).otherwise(0))).alias("distinct_values"),
        F.count_if(c == 0).alias("zero_windows"),
    )


def quantiles(df: DataFrame, column: str = "error_rate",
              probs: Sequence[float] = fixed.ERROR_RATE_QUANTILES) -> DataFrame:
    """Exact quantiles (linear interpolation, NULLs ignored), one column each,
    named ``p25``, ``p50``, ...  One aggregate computes all of them."""
    arr = F.percentile(F.col(column), F.array(*[F.lit(float(p)) for p in probs]))
    out = df.agg(arr.alias("_q"))
    return out.select(*[F.col("_q")[i].alias(f"p{int(round(p * 100))}") for i, p in enumerate(probs)])


def histogram(df: DataFrame, column: str = "error_rate",
              buckets=fixed.ERROR_RATE_BUCKETS, null_label: str = "no data") -> DataFrame:
    """Windows per bucket, with a separate bucket for NULL and a numeric
    bucket order (``bucket_no``)."""
    number, label = bucket_of(column, buckets, null_label)
    return (df.groupBy(number.alias("bucket_no"), label.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("windows")))


def sample_per_class(labeled: DataFrame, per_class: dict[str, int] | None = None,
                     class_col: str = "anomaly_type", order_col: str = "window_start") -> DataFrame:
    """The first ``n`` windows in time of each class.

    ``row_number() <= n`` per class is planned with a group limit before the
    shuffle (at most n rows per class leave each task), so a class holding
    most windows does not have to be sorted in one task.
    """
    per_class = per_class or dict(fixed.SAMPLES_PER_CLASS)
    limit = F.element_at(F.create_map(*[x for k, v in per_class.items() for x in (F.lit(k), F.lit(v))]),
                         F.col(class_col))
    top = max(per_class.values())
    w = Window.partitionBy(class_col).orderBy(order_col)
    ranked = (labeled.filter(F.col(class_col).isin(*per_class))
              .withColumn("class_rank", F.row_number().over(w))
              .filter(F.col("class_rank") <= top))
    return ranked.filter(F.col("class_rank") <= limit)


def reconcile(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact multiset comparison of two tables without collecting them.

    ``missing`` = rows of ``expected`` not in ``actual``, ``extra`` the other
    way (repeats counted, NULLs equal, as with ``exceptAll``), plus both row
    counts and the number of columns whose types differ (``columns_differ``).  Both tables are tagged, unioned and grouped by all columns once:
    one shuffle (with partial aggregation) instead of two ``exceptAll`` plans
    and two counts.  Returned as ``(item, rows)``.
    """
    a = expected.select(*columns, F.lit(1).alias("_in"), F.lit(0).alias("_out"))
    b = actual.select(*columns, F.lit(0).alias("_in"), F.lit(1).alias("_out"))
    per_row = a.unionByName(b).groupBy(*columns).agg(F.sum("_in").alias("n_in"), F.sum("_out").alias("n_out"))
    totals = per_row.agg(
        F.sum(F.greatest(F.col("n_in") - F.col("n_out"), F.lit(0))).alias("missing"),
        F.sum(F.greatest(F.col("n_out") - F.col("n_in"), F.lit(0))).alias("extra"),
        F.sum("n_in").alias("rows_in"),
        F.sum("n_out").alias("rows_out"))
    wrong = schema_diff(expected, actual, columns)
    return totals.select(F.stack(F.lit(5), F.lit("missing"), F.coalesce("missing", F.lit(0)),
                                 F.lit("extra"), F.coalesce("extra", F.lit(0)),
                                 F.lit("rows_in"), F.coalesce("rows_in", F.lit(0)),
                                 F.lit("rows_out"), F.coalesce("rows_out", F.lit(0)),
                                 F.lit("columns_differ"), F.lit(len(wrong)).cast("bigint"))
                         .alias("item", "rows"))


def schema_diff(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) for columns whose types differ or
    that are absent on a side (type ``absent``), on both sides included."""
    def types(df):
        return {f.name: f.dataType.simpleString() for f in df.schema.fields}
    e, a = types(expected), types(actual)
    return [(c, e.get(c, "absent"), a.get(c, "absent")) for c in columns if c not in e or e[c] != a.get(c)]


def fingerprints(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, rows, mark): an order-free fingerprint of the multiset of rows of
    every part, as the sums of two independent 64-bit row hashes.  Lost,
    doubled and changed rows all change it; one value a part is shuffled."""
    row = [F.col(c) for c in columns]
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.struct(F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias("a"),
                 F.sum(F.xxhash64(F.lit(1), *row).cast("decimal(38,0)")).alias("b")).alias("mark"))


def parts_that_differ(expected: DataFrame, actual: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Parts whose fingerprints differ, or that one side lacks: (by, rows_in,
    rows_out)."""
    a, b = (fingerprints(df, columns, by) for df in (expected, actual))
    a, b = a.select(F.col(by).alias("_a"), F.col("rows").alias("rows_in"), F.col("mark").alias("_mark_in")), \
        b.select(F.col(by).alias("_b"), F.col("rows").alias("rows_out"), F.col("mark").alias("_mark_out"))
    both = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full").where(~F.col("_mark_in").eqNullSafe(F.col("_mark_out")))
    return both.select(F.coalesce("_a", "_b").alias(by), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_in", "rows_out")])


def reconcile_parts(expected: DataFrame, actual: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, missing, extra) of the parts that differ: :func:`reconcile` row by
    row, but only for parts whose fingerprints differ.  Equal parts leave two
    hashes each and nothing more."""
    differ = parts_that_differ(expected, actual, columns, by).select(F.col(by).alias("_part"))
    a = expected.select(by, *columns, F.lit(1).alias("_n"))
    b = actual.select(by, *columns, F.lit(-1).alias("_n"))
    rows = a.unionByName(b).join(differ, F.col(by).eqNullSafe(F.col("_part")), "left_semi")
    per_row = rows.groupBy(by, *columns).agg(F.sum("_n").alias("n"))
    return per_row.groupBy(by).agg(F.sum(F.greatest("n", F.lit(0))).alias("missing"),
                                   F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("extra"))
