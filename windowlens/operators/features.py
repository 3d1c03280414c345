"""Time-window features and the window calendar (spine).

One ``window_features`` serves batch, streaming, training and scoring, so the
model always sees features computed the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.functions import fixed
from windowlens.functions.expressions import is_error, stamp_at
from windowlens.operators.ranking import prefix_sums
from windowlens.session import checkpoint_dir


def _aggregates(status: str, size: str, min_status: int, percentile: float,
                method: str, accuracy: int) -> list[Column]:
    if method == "exact":
        p = F.percentile(F.col(size), F.lit(percentile))
    elif method == "approx":
        p = F.percentile_approx(F.col(size), percentile, accuracy).cast("double")
    else:
        raise ValueError(f"unknown percentile method {method!r}")
    return [
        F.count(F.lit(1)).alias("total_requests"),
        F.avg(is_error(status, min_status)).alias("error_rate"),
        F.avg(F.col(size)).alias("avg_response_size"),
        p.alias("p95_response_size"),
    ]


def window_features(rows: DataFrame, width: str = fixed.WINDOW_WIDTH, ts: str = "ts",
                    status: str = "status_code", size: str = "response_size",
                    min_status: int = fixed.ERROR_STATUS_MIN,
                    percentile: float = fixed.SIZE_PERCENTILE,
                    method: str = "exact", accuracy: int = 10000,
                    by: list[str] | None = None, keep_window: bool = False) -> DataFrame:
    """Per tumbling window (and optional extra keys): ``total_requests``,
    ``error_rate`` (share of status >= min_status, 0..1), ``avg_response_size``
    and ``p95_response_size``.

    Rows with a NULL timestamp fall out (``F.window`` drops them).  All four
    aggregates run partially before the shuffle, so a window holding a large
    share of the rows still sends only one partial row per task.  The exact
    percentile keeps a value->count map per window; ``method="approx"``
    switches to ``percentile_approx`` for very wide windows or long streams.
    ``keep_window`` returns the window itself in place of its start.
    """
    keys = [F.window(F.col(ts), width).alias("window")] + [F.col(k) for k in (by or [])]
    out = rows.groupBy(*keys).agg(*_aggregates(status, size, min_status, percentile, method, accuracy))
    start = F.col("window") if keep_window else F.col("window.start").alias("window_start")
    return out.select(start, *(by or []), "total_requests", "error_rate", "avg_response_size", "p95_response_size")


def session_aggregates(min_status: int = fixed.ERROR_STATUS_MIN, percentile: float = fixed.SIZE_PERCENTILE,
                       status: str = "status_code", size: str = "response_size") -> list[Column]:
    """The four features as plain aggregates, for Spark's own sessions in a
    stream."""
    return _aggregates(status, size, min_status, percentile, "exact", 0)


def sliding_features(rows: DataFrame, width: str, slide: str, ts: str = "ts",
                     status: str = "status_code", size: str = "response_size",
                     min_status: int = fixed.ERROR_STATUS_MIN, percentile: float = fixed.SIZE_PERCENTILE,
                     method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Features over sliding windows (``width`` every ``slide``); each row
    falls into width/slide windows."""
    out = (rows.groupBy(F.window(F.col(ts), width, slide).alias("window"))
           .agg(*_aggregates(status, size, min_status, percentile, method, accuracy)))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "total_requests", "error_rate", "avg_response_size", "p95_response_size")


def _seconds(interval: str) -> int:
    amount, unit = interval.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s").lower()]
    return int(amount) * scale


def _size_counts(rows: DataFrame, keys: list[Column], status: str, size: str, min_status: int, ts: str) -> DataFrame:
    """Rows per keys and size: ``n``, rows with a status, errors, first and
    last stamp.  Everything the features need, merged without the rows; kept
    in the checkpoint folder, because it is read more than once."""
    checkpoint_dir(rows.sparkSession)
    err = is_error(status, min_status)
    return (rows.groupBy(*keys, F.col(size).alias("_size"))
            .agg(F.count(F.lit(1)).alias("_n"), F.count(err).alias("_judged"), F.sum(err).alias("_errors"),
                 F.min(ts).alias("_first"), F.max(ts).alias("_last"))
            .checkpoint(eager=True))


def _merged(percentile: float | None) -> list[Column]:
    """The four features from size counts (no percentile if None)."""
    sized = F.when(F.col("_size").isNotNull(), F.col("_n"))
    out = [F.sum("_n").alias("total_requests"),
           F.try_divide(F.sum("_errors").cast("double"), F.sum("_judged")).alias("error_rate"),
           F.try_divide(F.sum(F.col("_size") * F.col("_n")).cast("double"), F.sum(sized)).alias("avg_response_size")]
    if percentile is not None:
        out.append(F.percentile(F.col("_size"), F.lit(percentile), F.col("_n")).alias("p95_response_size"))
    return out


def window_counts(rows: DataFrame, width: str = fixed.WINDOW_WIDTH, ts: str = "ts", status: str = "status_code",
                  size: str = "response_size", min_status: int = fixed.ERROR_STATUS_MIN) -> DataFrame:
    """Mergeable state of tumbling windows: rows, judged rows and errors per
    window and size.  States of disjoint sets of rows add up."""
    err = is_error(status, min_status)
    out = rows.groupBy(F.window(F.col(ts), width).alias("window"), F.col(size).alias("_size")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(err).alias("_judged"), F.sum(err).alias("_errors"))
    return out.select(F.col("window.start").alias("window_start"), "_size", "_n", "_judged", "_errors")


def features_of_counts(counts: DataFrame, percentile: float = fixed.SIZE_PERCENTILE) -> DataFrame:
    """The features of :func:`window_features` from window states, however
    many there are of a window."""
    return counts.groupBy("window_start").agg(*_merged(percentile))


def session_features(rows: DataFrame, gap: str, key: str = "endpoint", ts: str = "ts",
                     status: str = "status_code", size: str = "response_size",
                     min_status: int = fixed.ERROR_STATUS_MIN, percentile: float = fixed.SIZE_PERCENTILE) -> DataFrame:
    """Features per activity session of ``key``: a session ends when no row
    follows within ``gap`` (the semantics of ``session_window``), and spans
    ``[first row, last row + gap)``.

    Two rows of a key in one gap-wide time bucket are always in the same
    session, so rows are counted per (key, bucket, size) first, with partial
    aggregation and in one pass.  Sessions are found with ``lag`` over one
    row per (key, bucket), whose number is bounded by the time span, and the
    counts are merged per session.  No row-level sort or join.
    """
    gap_seconds = _seconds(gap)
    bucket = F.floor(F.unix_timestamp(F.col(ts)) / F.lit(gap_seconds)).alias("_bucket")
    counts = _size_counts(rows.filter(F.col(ts).isNotNull()), [F.col(key), bucket], status, size, min_status, ts)
    buckets = counts.groupBy(key, "_bucket").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    order = Window.partitionBy(key).orderBy("_bucket")
    width = F.make_dt_interval(secs=F.lit(gap_seconds))
    before = F.lag("_last").over(order)
    opened = F.when(before.isNull() | (F.col("_first") >= before + width), F.col("_first"))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    starts = (buckets.select(key, "_bucket", opened.alias("_open"))
              .select(key, "_bucket", F.max("_open").over(running).alias("session_start")))
    return (counts.join(starts, [key, "_bucket"]).groupBy(key, "session_start")
            .agg(F.max("_last").alias("_end"), *_merged(percentile))
            .select(key, "session_start", (F.col("_end") + width).alias("session_end"), "total_requests",
                    "error_rate", "avg_response_size", "p95_response_size"))


def window_features_rollup(rows: DataFrame, width: str = fixed.WINDOW_WIDTH, ts: str = "ts",
                           key: str = "endpoint", status: str = "status_code",
                           size: str = "response_size", min_status: int = fixed.ERROR_STATUS_MIN,
                           percentile: float = fixed.SIZE_PERCENTILE) -> DataFrame:
    """Features per (window, key) with per-window subtotals (key NULL) and a
    grand total (both NULL), as ``ROLLUP(window_start, key)`` gives.

    Rows are counted once per (window, key, size); all levels are merged from
    these counts.  The percentile of the grand total comes from distributed
    running counts over the sizes, not from one group that holds them all.
    """
    start = F.window(F.col(ts), width).start.alias("window_start")
    counts = _size_counts(rows.filter(F.col(ts).isNotNull()), [start, F.col(key)], status, size, min_status, ts)
    cols = ["window_start", key, "total_requests", "error_rate", "avg_response_size", "p95_response_size"]
    leaves = counts.groupBy("window_start", key).agg(*_merged(percentile)).select(*cols)
    none = F.lit(None).cast(counts.schema[key].dataType)
    per_window = (counts.groupBy("window_start").agg(*_merged(percentile))
                  .withColumn(key, none).select(*cols))
    total = (counts.agg(*_merged(None)).where("total_requests > 0")
             .withColumn("p95_response_size", quantile_of_counts(counts, percentile).scalar())
             .withColumn("window_start", F.lit(None).cast(counts.schema["window_start"].dataType))
             .withColumn(key, none).select(*cols))
    return leaves.unionByName(per_window).unionByName(total)


def quantile_of_counts(counts: DataFrame, q: float) -> DataFrame:
    """One row ``p95_response_size``: the ``q`` quantile (linear between
    neighbours) of ``_size`` repeated ``_n`` times."""
    sizes = counts.where("_size is not null").groupBy("_size").agg(F.sum("_n").alias("_n"))
    bucket = F.floor(F.log2(F.greatest(F.col("_size"), F.lit(0)) + 1) * 8)   # monotone in the size
    ranked = prefix_sums(sizes, ["_size"], {"n": F.col("_n")}, bucket)
    at = (F.col("total_n") - 1) * F.lit(q)
    low, high = F.floor(at), F.ceil(at)
    ends = ranked.agg(F.min(F.when(F.col("cum_n") > low, F.col("_size"))).alias("lo"),
                      F.min(F.when(F.col("cum_n") > high, F.col("_size"))).alias("hi"),
                      F.max(at - low).alias("share"))
    return ends.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("share")).alias("p95_response_size"))


#: Windows of a calendar at most; beyond that its bounds are taken for wrong.
MAX_WINDOWS = 100_000_000


def window_spine(rows: DataFrame, width: str = fixed.WINDOW_WIDTH, ts: str = "ts", start: str | None = None,
                 end: str | None = None, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Every window start from the first day of the data up to the end of the
    last day, or between explicit bounds (``start`` inclusive, ``end``
    exclusive, ``yyyy-MM-dd HH:mm:ss``).

    Windows are floored on the epoch, as ``F.window`` does, for every width,
    so each feature window of the range is on the calendar.  The range is cut
    into parts of 4,096 windows that are dealt to the tasks before they are
    expanded.  A range of over ``max_windows`` windows (one absurd stamp is
    enough) raises an error; give bounds, or drop such rows first
    (``clean.in_range``).
    """
    w = _seconds(width)
    day = F.lit(86400)
    first = F.floor(F.unix_timestamp(F.min(ts)) / day) * day if start is None else F.unix_timestamp(
        F.lit(start).cast("timestamp_ntz"))
    last = (F.floor(F.unix_timestamp(F.max(ts)) / day) + 1) * day if end is None else F.unix_timestamp(
        F.lit(end).cast("timestamp_ntz"))
    bounds = rows.agg(first.alias("_a"), last.alias("_b")).where("_a < _b")
    bounds = bounds.select((F.floor(F.col("_a") / w)).alias("_i"), F.ceil(F.col("_b") / w).alias("_j"))
    size = F.col("_j") - F.col("_i")
    bounds = bounds.select("_i", F.when(size > max_windows, F.raise_error(F.concat(
        F.lit(f"calendar of over {max_windows} windows: "), size.cast("string"))).cast("bigint"))
        .otherwise(F.col("_j")).alias("_j"))
    parts = bounds.select("_j", F.explode(F.sequence("_i", F.col("_j") - 1, F.lit(4096).cast("bigint"))).alias("_p"))
    each = F.sequence(F.col("_p"), F.least(F.col("_p") + 4095, F.col("_j") - 1))
    return (parts.repartition("_p").select(F.explode(each).alias("_k"))
            .select(stamp_at(F.col("_k") * w).alias("window_start")))
