"""Run audit, and stage metrics from Spark's event log.

Stage metrics are read from the event log files (``spark.eventLog.dir``), so
no UI port is needed.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.operators import clean, features, labels, parse, sink

AUDIT_SCHEMA = "step_no int, step string, metric string, value bigint"


#: Settings that say where a run happened, not what it computed.
PLACES = ("spark.sql.warehouse.dir", "spark.sql.catalogImplementation")


def config_hash(spark: SparkSession, parameters: dict | None = None) -> str:
    """Short hash of the SQL settings in force and of logical parameters
    (widths, thresholds; not output paths), so that equal runs share it and a
    setting changed at run time changes it."""
    conf = {r["key"]: r["value"] for r in spark.sql("SET").collect()
            if r["key"].startswith("spark.sql.") and r["key"] not in PLACES}
    blob = json.dumps({"conf": conf, "parameters": parameters or {}}, sort_keys=True, default=str)
    return hashlib.sha256(blob.encode()).hexdigest()[:16]


def run_feature_job(spark: SparkSession, lines: DataFrame, features_path: str, labeled_path: str,
                    label_df: DataFrame, width: str = fixed.WINDOW_WIDTH, audit_path: str | None = None) -> DataFrame:
    """Lines -> parse -> typed -> dedupe -> window features, written
    partitioned by date; then ``label_df`` joined to the written features and
    written too.  Both tables carry ``run_id`` and ``config_hash``.  Returns
    the audit ``(step_no, step, metric, value, run_id, config_hash)``, also
    appended to the table at ``audit_path`` if given.

    Counts come from tables, not from task-side observers, which count again
    when a lost executor's stage is repeated: the cleaning steps from one
    aggregate pass over the lines, the rest from what was written.
    """
    digest = config_hash(spark, {"width": width})
    run_id = uuid.uuid4().hex[:12]

    def stamped(df: DataFrame) -> DataFrame:
        return df.withColumn("run_id", F.lit(run_id)).withColumn("config_hash", F.lit(digest))

    t0 = time.perf_counter()
    parsed = parse.parse_lines(lines)
    feats = features.window_features(clean.dedupe(clean.typed_rows(parsed)), width)
    sink.write_partitioned(stamped(sink.with_date(feats)), features_path)
    t1 = time.perf_counter()
    written = spark.read.parquet(features_path).where(F.col("run_id") == run_id)
    labeled = labels.attach_labels(label_df, written)
    sink.write_partitioned(stamped(sink.with_date(labeled)), labeled_path)
    t2 = time.perf_counter()

    steps = {r["step"]: r["rows"] for r in clean.cleaning_audit(parsed).collect()}
    out = spark.read.parquet(labeled_path).where(F.col("run_id") == run_id).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("total_requests").isNull()).alias("empty")).first()
    rows = [
        (1, "extract", "lines_read", steps["lines_read"]),
        (1, "extract", "rejected", steps["rejected"]),
        (2, "transform", "accepted", steps["accepted"]),
        (2, "transform", "duplicates", steps["duplicates"]),
        (2, "transform", "deduped", steps["after_dedupe"]),
        (2, "transform", "null_timestamp", steps["null_timestamp"]),
        (2, "transform", "windows", written.count()),
        (2, "transform", "elapsed_ms", int((t1 - t0) * 1000)),
        (3, "load", "labeled_windows", out["n"]),
        (3, "load", "windows_without_rows", out["empty"]),
        (3, "load", "elapsed_ms", int((t2 - t1) * 1000)),
    ]
    audit = stamped(spark.createDataFrame(rows, AUDIT_SCHEMA))
    if audit_path is not None:
        audit.coalesce(1).write.mode("append").parquet(audit_path)
    return audit


#: What is read of a task's end; one parse a line.
TASK_END = (
    "Event STRING, `Stage ID` INT, `Stage Attempt ID` INT, `Task Metrics` STRUCT<`Executor Run Time`: BIGINT, "
    "`Disk Bytes Spilled`: BIGINT, `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: BIGINT, "
    "`Local Bytes Read`: BIGINT>, `Shuffle Write Metrics`: STRUCT<`Shuffle Bytes Written`: BIGINT>>")


def stage_metrics(spark: SparkSession, event_log_path: str) -> DataFrame:
    """Tasks, shuffle read and shuffle write bytes and run time per stage,
    aggregated from ``SparkListenerTaskEnd`` events of an event log.

    The log is read as JSON lines, so it must be written uncompressed
    (``spark.eventLog.compress=false``); Spark's own ``.zstd`` suffix is not
    a codec the text reader recognises."""
    log = spark.read.text(event_log_path).where(F.col("value").contains("SparkListenerTaskEnd"))
    e = log.select(F.from_json("value", TASK_END).alias("e")).where("e.Event = 'SparkListenerTaskEnd'").select("e.*")
    m = F.col("Task Metrics")

    def number(c):
        return F.coalesce(c, F.lit(0))

    read, write = m["Shuffle Read Metrics"], m["Shuffle Write Metrics"]
    ends = e.select(
        F.col("Stage ID").alias("stage_id"), F.col("Stage Attempt ID").alias("stage_attempt"),
        (number(read["Remote Bytes Read"]) + number(read["Local Bytes Read"])).alias("shuffle_read"),
        number(write["Shuffle Bytes Written"]).alias("shuffle_write"),
        number(m["Executor Run Time"]).alias("run_ms"), number(m["Disk Bytes Spilled"]).alias("spilled"))
    # max_task_ms far above mean_task_ms is the signature of a skewed stage
    return (ends.groupBy("stage_id", "stage_attempt")
            .agg(F.count(F.lit(1)).alias("tasks"), F.sum("shuffle_read").alias("shuffle_read_bytes"),
                 F.sum("shuffle_write").alias("shuffle_write_bytes"), F.sum("run_ms").alias("task_ms"),
                 F.max("run_ms").alias("max_task_ms"), F.avg("run_ms").alias("mean_task_ms"),
                 F.sum("spilled").alias("disk_spilled_bytes"))
            .orderBy("stage_id", "stage_attempt"))
