"""Features loaded batch by batch.

A store is a folder that every batch adds to:

* ``rows/batch=<id>/date=<day>``: the distinct rows a batch brought that no
  other batch has, by day of their stamp;
* ``counts/batch=<id>/date=<day>``: the mergeable state of its windows (rows,
  judged rows and errors per window and size), by day of the window;
* ``features/date=<day>``: the features of all windows of a day, from the
  states of all batches.

A batch may cover part of a day or of a window, bring rows of days long
loaded, or repeat rows of other batches.  Only the days a batch touches are
read and written, and only their states, never earlier rows as a whole.
A batch replaces what an earlier attempt under its id has left, so a run that
failed half-way is simply run again.  One batch at a time is loaded.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.operators.clean import TYPED_COLUMNS, dedupe
from windowlens.operators.features import features_of_counts, window_counts
from windowlens.operators.sink import with_date, write_partitioned
from windowlens.session import remove_path, work_path

ROW_SCHEMA = "ts timestamp_ntz, endpoint string, status_code int, response_size bigint, batch string, date string"
COUNT_SCHEMA = ("window_start timestamp_ntz, _size bigint, _n bigint, _judged bigint, _errors bigint, "
                "batch string, date string")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _days(table: DataFrame) -> list[str]:
    """The days a batch touches (one value a day)."""
    return [r["date"] for r in table.select("date").distinct().collect()]


def loaded_rows(spark: SparkSession, store: str) -> DataFrame:
    return read_or_empty(spark, f"{store}/rows", ROW_SCHEMA)


def unseen(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (distinct) that ``known`` doesn't hold; null equals null."""
    same = F.lit(True)
    for c in (*TYPED_COLUMNS, "date"):
        same = same & rows[c].eqNullSafe(known[c])
    return rows.join(known, same, "left_anti")


def load_batch(rows: DataFrame, store: str, batch: str, width: str = fixed.WINDOW_WIDTH,
               percentile: float = fixed.SIZE_PERCENTILE) -> DataFrame:
    """Merge typed rows into the store; returns the features of the days
    whose windows the batch touched.

    Rows without a stamp are left out.  All batches of a store use one
    ``width``.
    """
    spark = rows.sparkSession
    staged = work_path(spark, "batch-rows")
    dated = with_date(dedupe(rows.select(*TYPED_COLUMNS).where("ts is not null")), "ts")
    dated.write.parquet(staged)
    mine = spark.read.schema(dated.schema).parquet(staged)
    known = loaded_rows(spark, store).where(F.col("date").isin(_days(mine)) & (F.col("batch") != batch))
    own_rows, own_counts = (f"{store}/{kind}/batch={batch}" for kind in ("rows", "counts"))
    unseen(mine, known).repartition("date").write.mode("overwrite").partitionBy("date").parquet(own_rows)
    remove_path(spark, staged)
    fresh = loaded_rows(spark, store).where(F.col("batch") == batch)
    counts = with_date(window_counts(fresh, width))
    counts.repartition("date").write.mode("overwrite").partitionBy("date").parquet(own_counts)
    every = spark.read.schema(COUNT_SCHEMA).parquet(f"{store}/counts")
    touched = every.where(F.col("date").isin(_days(every.where(F.col("batch") == batch))))
    features = with_date(features_of_counts(touched, percentile))
    write_partitioned(features, f"{store}/features")
    return features


def stored_features(spark: SparkSession, store: str) -> DataFrame:
    """The features of all windows loaded so far."""
    return spark.read.parquet(f"{store}/features").drop("date")
