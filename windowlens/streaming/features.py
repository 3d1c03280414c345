"""Window features as a Structured Streaming job.

The stream uses the same operators as the batch job (``parse_lines``,
``typed_rows``, ``window_features``), plus a watermark.  Duplicate rows are
removed with state bounded by the watermark, windows are emitted once in
append mode when the watermark passes their end, and later rows for a closed
window are dropped.  Exact percentiles keep a value->count map per open
window in state; ``method="approx"`` bounds it for long, wide windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windowlens.functions import fixed
from windowlens.functions.expressions import instant_of, wall_clock_of
from windowlens.operators.clean import TYPED_COLUMNS, typed_rows
from windowlens.operators.evaluate import score_logistic
from windowlens.operators.features import features_of_counts, session_aggregates, window_counts, window_features
from windowlens.operators.labels import LABEL_COLUMNS, LABEL_CSV_SCHEMA, labels_of_text
from windowlens.operators.parse import parse_lines

DEFAULT_DELAY = "10 minutes"


def typed_stream(lines: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Parsed, typed rows plus ``event_time`` (the instant of ``ts``, which
    is UTC wall-clock) carrying the watermark.  Watermarks need TIMESTAMP,
    and the conversion does not depend on the session time zone."""
    typed = typed_rows(parse_lines(lines))
    return typed.withColumn("event_time", instant_of("ts")).withWatermark("event_time", delay)


def unstamped(typed: DataFrame) -> DataFrame:
    """The rows without an event time (stateless).  No watermark ever passes
    them, so they must not reach a stateful operator; deduplicate what was
    written of them in batch."""
    return typed.where(F.col("event_time").isNull())


def dedupe_stream(typed: DataFrame, salt_buckets: int = 8) -> DataFrame:
    """Exact duplicates removed; the event time is part of the key, so the
    state of a key is dropped once the watermark passes it.  Rows without an
    event time would stay in state for ever and are left out
    (:func:`unstamped` has them).

    Streaming dedupe has no map-side combine, so every copy of a hot row
    would reach one task.  With ``salt_buckets > 1`` a first dedupe keyed by
    (row, input partition mod salt_buckets) spreads the copies over up to
    that many tasks and passes on at most ``salt_buckets`` copies per row;
    the second, exact dedupe keyed by the row alone removes the rest.  A
    retried task reads the same input partition, so its salt is stable.
    """
    keys = [*TYPED_COLUMNS, "event_time"]
    typed = typed.where(F.col("event_time").isNotNull())
    if salt_buckets <= 1:
        return typed.dropDuplicates(keys)
    salted = typed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salt_buckets)))
    return salted.dropDuplicates([*keys, "_salt"]).drop("_salt").dropDuplicates(keys)


def feature_stream(lines: DataFrame, width: str = fixed.WINDOW_WIDTH, delay: str = DEFAULT_DELAY,
                   method: str = "exact") -> DataFrame:
    """Lines stream -> closed-window feature rows (append mode); window
    starts are returned as TIMESTAMP_NTZ like the batch features."""
    out = window_features(dedupe_stream(typed_stream(lines, delay)), width, ts="event_time", method=method)
    return out.withColumn("window_start", wall_clock_of("window_start"))


def scored_stream(features: DataFrame, **score_args) -> DataFrame:
    """Feature stream scored with the logistic formula (stateless)."""
    return score_logistic(features, **score_args)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint_path: str,
                      fmt: str = "parquet", output_mode: str = "append") -> StreamingQuery:
    """Process everything available now, then stop.  The checkpoint makes
    the run restartable after a failure (exactly-once to a file sink)."""
    query = (stream.writeStream.format(fmt).outputMode(output_mode)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start(sink_path))
    query.awaitTermination()
    return query


def read_sink(spark: SparkSession, sink_path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(sink_path)


def count_stream(lines: DataFrame, width: str = fixed.WINDOW_WIDTH, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Lines stream -> window states (``features.window_counts``) of closed
    windows, in append mode.  The state the stream keeps of an open window is
    the same few numbers per size, so it can be read back."""
    out = window_counts(dedupe_stream(typed_stream(lines, delay)), width, ts="event_time")
    return out.withColumn("window_start", wall_clock_of("window_start"))


def open_counts(spark: SparkSession, checkpoint_path: str) -> DataFrame:
    """Window states of the windows that a :func:`count_stream` run holds
    open, from the state store of its checkpoint."""
    kept = (spark.read.format("state-metadata").load(checkpoint_path)
            .where("operatorName = 'stateStoreSave'").select("operatorId").first())
    state = spark.read.format("statestore").option("operatorId", kept["operatorId"]).load(checkpoint_path)
    # by position: the store names both counts "count"
    key = F.col("key").cast("struct<window:struct<start:timestamp,end:timestamp>,size:bigint>")
    value = F.col("value").cast("struct<n:bigint,judged:bigint,errors:bigint>")
    return state.select(wall_clock_of(key["window"]["start"]).alias("window_start"), key["size"].alias("_size"),
                        value["n"].alias("_n"), value["judged"].alias("_judged"), value["errors"].alias("_errors"))


def all_windows(spark: SparkSession, closed: DataFrame, checkpoint_path: str) -> DataFrame:
    """Features of the closed windows (what a :func:`count_stream` run has
    written) and of those it holds open."""
    return features_of_counts(closed.unionByName(open_counts(spark, checkpoint_path)))


def session_stream(lines: DataFrame, gap: str, key: str = "endpoint", delay: str = DEFAULT_DELAY,
                   min_status: int = fixed.ERROR_STATUS_MIN, percentile: float = fixed.SIZE_PERCENTILE) -> DataFrame:
    """Lines stream -> features of closed sessions of ``key`` in append mode,
    as ``features.session_features`` gives them.  A row that falls between
    two open sessions merges them in state; a session closes when the
    watermark passes its end."""
    rows = dedupe_stream(typed_stream(lines, delay))
    out = rows.groupBy(F.session_window("event_time", gap).alias("session"), F.col(key)).agg(
        *session_aggregates(min_status, percentile))
    return out.select(key, wall_clock_of("session.start").alias("session_start"),
                      wall_clock_of("session.end").alias("session_end"), *fixed.FEATURE_COLUMNS)


def label_stream(spark: SparkSession, path: str) -> DataFrame:
    """Label CSV files as a stream of (window_start, is_anomalous,
    anomaly_type); rows without a usable stamp are left out, because no
    watermark would ever pass them."""
    raw = spark.readStream.schema(LABEL_CSV_SCHEMA).option("header", True).csv(path)
    return labels_of_text(raw).where("window_start is not null")


def labeled_stream(label_rows: DataFrame, lines: DataFrame, width: str = fixed.WINDOW_WIDTH,
                   delay: str = DEFAULT_DELAY) -> DataFrame:
    """Label stream left-joined with the feature stream (append mode), as
    ``labels.attach_labels`` does in batch.

    Both sides carry a watermark on the last instant of a window, so a label
    whose window has no rows is emitted with null features once the watermark
    passes it, and neither side keeps a window longer.  The watermark is that
    of the side that lags behind; after a restart both must bring rows before
    it moves on."""
    features = window_features(dedupe_stream(typed_stream(lines, delay)), width, ts="event_time", keep_window=True)
    features = features.select(F.window_time("window").alias("last"), *fixed.FEATURE_COLUMNS)
    end = instant_of("window_start") + F.expr(f"INTERVAL {width}") - F.expr("INTERVAL 1 MICROSECOND")
    spine = label_rows.withColumn("last", end).withWatermark("last", delay)
    return spine.join(features, "last", "leftOuter").select(*LABEL_COLUMNS, *fixed.FEATURE_COLUMNS)


def closing_line(after: str, endpoint: str = "/heartbeat") -> str:
    """A line stamped ``after`` (yyyy-MM-dd HH:mm:ss).  Sent last, it moves
    the watermark so that every window or session ending a delay before it is
    closed; its own window stays open and is never emitted."""
    return f"{after} {endpoint} 200 0"
