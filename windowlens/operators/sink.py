"""Partitioned Parquet output and its round-trip checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.operators.quality import reconcile

FEATURE_TABLE_COLUMNS = ["window_start", "is_anomalous", "anomaly_type", *fixed.FEATURE_COLUMNS]


def with_date(df: DataFrame, ts: str = "window_start", name: str = "date") -> DataFrame:
    """Add the partition column ``date`` (``yyyy-MM-dd`` text of ``ts``)."""
    return df.withColumn(name, F.date_format(F.col(ts), fixed.DATE_TEXT_FORMAT))


def write_partitioned(df: DataFrame, path: str, partition_col: str = "date",
                      files_per_partition: int = 1, mode: str = "overwrite") -> None:
    """Write Parquet partitioned by ``partition_col``.

    Dynamic partition overwrite replaces only the partitions present in
    ``df``, so writing a later batch keeps earlier dates.  Rows are first
    shuffled on the partition value (plus a hash spread over
    ``files_per_partition`` files for large partitions), so each partition
    directory gets a bounded number of files instead of one per task.
    """
    if files_per_partition <= 1:
        laid_out = df.repartition(F.col(partition_col))
    else:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        laid_out = df.repartition(F.col(partition_col), spread)
    (laid_out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def write_predictions(predictions: DataFrame, path: str, ts: str = "window_start", mode: str = "overwrite") -> None:
    """Write scored windows in time order (range-partitioned and sorted, so
    files follow each other in time)."""
    predictions.orderBy(ts).write.mode(mode).parquet(path)


def partition_counts(spark: SparkSession, path: str, partition_col: str = "date") -> DataFrame:
    """Rows per partition value after re-reading, plus a grand total row
    (partition NULL), through ``ROLLUP``."""
    return (spark.read.parquet(path).rollup(partition_col)
            .agg(F.count(F.lit(1)).alias("rows")))


def file_inventory(spark: SparkSession, path: str, partition_col: str = "date") -> DataFrame:
    """Files and bytes per partition from a file listing: the ``binaryFile``
    source with only ``path`` and ``length`` selected reads no file
    contents, so this costs a listing, not a scan of the table's rows.  The
    partition value is taken from the ``<col>=<value>`` folder name."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    value = F.regexp_extract(F.col("path"), f"{partition_col}=([^/]+)", 1)
    return (files.groupBy(value.alias(partition_col))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def round_trip(spark: SparkSession, written: DataFrame, path: str,
               columns: Sequence[str] = FEATURE_TABLE_COLUMNS) -> DataFrame:
    """Compare what was written with what is read back (``exceptAll`` both
    ways and row counts).  Column types are checked by
    :func:`windowlens.operators.quality.schema_diff`."""
    return reconcile(written, spark.read.parquet(path), columns)


def read_features(spark: SparkSession, path: str,
                  columns: Sequence[str] = ("window_start", *fixed.FEATURE_COLUMNS, fixed.LABEL_COLUMN,
                                            "anomaly_type")) -> DataFrame:
    """Model input: the partitioned feature table with only the needed
    columns (the ``date`` partition column and anything else is pruned from
    the scan)."""
    return spark.read.parquet(path).select(*columns)


def read_window_range(spark: SparkSession, path: str, start: str, end: str,
                      ts: str = "window_start", partition_col: str = "date") -> DataFrame:
    """Windows with ``start <= ts < end`` from a date-partitioned table.

    A filter on ``window_start`` alone cannot prune directories; the same
    range is also stated on the partition column, so only the matching
    ``date=...`` folders are listed and read.
    """
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    day_lo = F.to_date(lo)
    day_hi = F.to_date(hi - F.expr("INTERVAL 1 MICROSECOND"))
    return (spark.read.parquet(path)
            .filter((F.col(partition_col) >= day_lo) & (F.col(partition_col) <= day_hi))
            .filter((F.col(ts) >= lo) & (F.col(ts) < hi)))
