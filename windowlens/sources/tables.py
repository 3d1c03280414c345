"""Parquet tables of a test-data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-split scan over the cluster's cores.

    A single small file (one Parquet row group) is read by one task, so all
    per-row work after it would run on one core.  Only when the scan has
    fewer partitions than ``min_partitions`` (default: the default
    parallelism) is it repartitioned round-robin; a large scan is already
    split by file blocks and is returned unchanged, without a shuffle.
    Round-robin repartitioning sorts first by default, so a retried task
    sees the same rows.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)
