"""A stream that loads its micro-batches into an incremental store.

Every micro-batch has a watermark: the latest stamp of the batches before it
less ``delay``.  Its rows from the watermark on are merged into the store
(``operators.incremental``), earlier ones go to a table of late rows, where
nothing is lost.  Copies of rows the store or the late table has are
duplicates, not late rows.  Windows that end by the watermark are closed and
never change again; the others are open.  Their features come from the
stored window states, never from a second pass over the log.

* ``marks/batch=<id>``: latest stamp of a batch and the watermark it ran with;
* ``late/batch=<id>/date=<day>``: late rows.

A micro-batch that is run again after a failure replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windowlens.functions import fixed
from windowlens.operators.clean import TYPED_COLUMNS, dedupe, typed_rows
from windowlens.operators.incremental import ROW_SCHEMA, load_batch, loaded_rows, read_or_empty, stored_features, unseen
from windowlens.operators.parse import parse_lines
from windowlens.operators.sink import with_date
from windowlens.session import remove_path, work_path
from windowlens.streaming.features import DEFAULT_DELAY

MARK_SCHEMA = "latest timestamp_ntz, watermark timestamp_ntz, batch long"


def watermark(spark: SparkSession, store: str, delay: str = DEFAULT_DELAY, before: int | None = None):
    """The latest stamp less ``delay`` over the batches so far (None without
    a stamp); with ``before`` over the batches before that id."""
    marks = read_or_empty(spark, f"{store}/marks", MARK_SCHEMA)
    if before is not None:
        marks = marks.where(F.col("batch") < before)
    return marks.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]


def load_micro_batch(rows: DataFrame, batch_id: int, store: str, width: str = fixed.WINDOW_WIDTH,
                     delay: str = DEFAULT_DELAY) -> None:
    """One micro-batch of typed rows: marks, late rows, merged rows."""
    spark = rows.sparkSession
    staged = work_path(spark, "micro-batch")
    rows.select(*TYPED_COLUMNS).write.parquet(staged)
    mine = spark.read.schema(rows.select(*TYPED_COLUMNS).schema).parquet(staged)
    mark = watermark(spark, store, delay, before=batch_id)
    (mine.agg(F.max("ts").alias("latest"), F.lit(mark).cast("timestamp_ntz").alias("watermark"))
     .write.mode("overwrite").parquet(f"{store}/marks/batch={batch_id}"))
    behind = F.col("ts") < F.lit(mark).cast("timestamp_ntz") if mark is not None else F.lit(False)
    late = with_date(dedupe(mine.where(behind)), "ts")
    days = [r["date"] for r in late.select("date").distinct().collect()]     # one value a day
    other = F.col("date").isin(days)
    known = loaded_rows(spark, store).where(other).unionByName(
        late_rows(spark, store).where(other & (F.col("batch") != str(batch_id))))
    unseen(late, known).repartition("date").write.mode("overwrite").partitionBy("date").parquet(
        f"{store}/late/batch={batch_id}")
    load_batch(mine.where(~behind), store, str(batch_id), width)
    remove_path(spark, staged)


def run_load_stream(lines: DataFrame, store: str, width: str = fixed.WINDOW_WIDTH,
                    delay: str = DEFAULT_DELAY) -> StreamingQuery:
    """Load everything that has arrived, then stop; the next run goes on with
    the files that have come since."""
    query = (typed_rows(parse_lines(lines)).writeStream
             .foreachBatch(lambda rows, batch_id: load_micro_batch(rows, batch_id, store, width, delay))
             .option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def late_rows(spark: SparkSession, store: str) -> DataFrame:
    return read_or_empty(spark, f"{store}/late", ROW_SCHEMA)


def window_states(spark: SparkSession, store: str, width: str = fixed.WINDOW_WIDTH,
                  delay: str = DEFAULT_DELAY) -> DataFrame:
    """The stored features with ``state``: ``closed`` or ``open``."""
    mark = watermark(spark, store, delay)
    over = F.col("window_start") + F.expr(f"INTERVAL {width}") <= F.lit(mark).cast("timestamp_ntz")
    return stored_features(spark, store).withColumn("state", F.when(over, "closed").otherwise("open"))
