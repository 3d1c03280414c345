"""Fitted models in a stream.

A registry is a folder with the saved models and a table that names them.
Every micro-batch of features is scored by the newest model published when
the batch starts, and each row carries its version; no restart is needed to
bring a new model in.  The model is loaded through Spark and applied as a
projection in the tasks.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windowlens.functions import fixed
from windowlens.operators import model
from windowlens.operators.incremental import read_or_empty

VERSION_SCHEMA = "version long, path string"


def versions(spark: SparkSession, registry: str) -> DataFrame:
    return read_or_empty(spark, f"{registry}/versions", VERSION_SCHEMA)


def publish(fitted: PipelineModel, registry: str, spark: SparkSession) -> int:
    """Save a model under the next version.  It is named in the table only
    once it is saved, so no reader meets half a model."""
    version = (versions(spark, registry).agg(F.max("version").alias("v")).first()["v"] or 0) + 1
    path = f"{registry}/models/{version}"
    model.save(fitted, path)
    spark.createDataFrame([(version, path)], VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{registry}/versions")
    return version


def newest(spark: SparkSession, registry: str) -> tuple[int, PipelineModel]:
    last = versions(spark, registry).orderBy(F.desc("version")).first()
    if last is None:
        raise ValueError(f"no model published in {registry}")
    return last["version"], model.load(last["path"])


def score_micro_batch(features: DataFrame, batch_id: int, registry: str, out: str) -> None:
    """Score one micro-batch; a batch that is run again replaces what it
    wrote (perhaps by a newer version)."""
    version, fitted = newest(features.sparkSession, registry)
    scored = model.score(fitted, features, keep=["window_start", *fixed.FEATURE_COLUMNS])
    scored.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def run_scored(features: DataFrame, registry: str, out: str, checkpoint_path: str) -> StreamingQuery:
    """Score everything available now, then stop."""
    query = (features.writeStream
             .foreachBatch(lambda rows, batch_id: score_micro_batch(rows, batch_id, registry, out))
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
