"""Access-log fixture derived from the ``events`` table.

The log is derived deterministically from ``events`` (one line per event, in
a single scan with no shuffle), with damaged lines, duplicates and injected
error and size bursts.  Rules (all parameters):

* endpoint ``/api/<event_type>``; status 500 for ``error`` events whose id is
  divisible by 3, 201 for ``signup``, else 200; size ``round(value*100)``.
* hour index ``hidx`` since ``epoch``; an hour is anomalous when
  ``hidx % period == offset``; its type is ``error`` when ``hidx // period``
  is even, else ``size``.  Error hours turn even ids into 503, size hours
  multiply the size by 10.
* damage on ``id % 67 == 11``, kind ``id % 5``; duplicates on ``id % 97 == 0``;
  a blank line per ``id % 997 == 0``; a calendar-invalid line per
  ``id % 991 == 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windowlens.functions.expressions import epoch_seconds, text_timestamp

# --- FIXED VALUES of the fixture (FIXTURES.md §2) -----------------------------
FIXTURE_EPOCH = "2024-01-01 00:00:00"
LABEL_PERIOD = 25
LABEL_OFFSET = 7
CALENDAR_INVALID_LINE = "2024-13-45 99:99:99 /api/view 200 9"
# --- end of fixed values ------------------------------------------------------


def hour_index(ts: str | Column, epoch: str = FIXTURE_EPOCH) -> Column:
    """Whole hours since ``epoch`` (floor), zone-free on TIMESTAMP_NTZ."""
    start = F.lit(epoch).cast("timestamp_ntz")
    return F.floor((epoch_seconds(ts) - epoch_seconds(start)) / F.lit(3600))


def rule_label(ts: str | Column, epoch: str = FIXTURE_EPOCH,
               period: int = LABEL_PERIOD, offset: int = LABEL_OFFSET) -> tuple[Column, Column]:
    """(is_anomalous int, anomaly_type string) of the hour containing ``ts``."""
    hidx = hour_index(ts, epoch)
    anomalous = (hidx % period) == offset
    kind = F.when(F.floor(hidx / F.lit(period)) % 2 == 0, F.lit("error")).otherwise(F.lit("size"))
    return (F.when(anomalous, F.lit(1)).otherwise(F.lit(0)),
            F.when(anomalous, kind).otherwise(F.lit("none")))


def rule_labels(spine: DataFrame, **rule) -> DataFrame:
    """Label every window of a calendar with the hour rule."""
    is_anom, kind = rule_label("window_start", **rule)
    return spine.select("window_start", is_anom.alias("is_anomalous"), kind.alias("anomaly_type"))


def access_log_lines(events: DataFrame, epoch: str = FIXTURE_EPOCH,
                     period: int = LABEL_PERIOD, offset: int = LABEL_OFFSET) -> DataFrame:
    """``DataFrame[value: string]`` of access-log lines, one scan of ``events``.

    Shared pieces (stamp text, hour index, status, size) are computed once
    per event in a projection; the lines are then built from those columns
    and exploded, so no expression is evaluated once per branch.
    """
    eid = F.col("event_id")
    etype = F.col("event_type")
    hidx = hour_index("ts", epoch)
    base = events.select(
        eid.alias("eid"),
        text_timestamp("ts").alias("tstr"),
        F.concat(F.lit("/api/"), etype).alias("endpoint"),
        (hidx % period == offset).alias("anomalous"),
        (F.floor(hidx / F.lit(period)) % 2).alias("kind_bit"),
        (F.when((etype == "error") & (eid % 3 == 0), F.lit(500))
          .when(etype == "signup", F.lit(201)).otherwise(F.lit(200))).alias("status0"),
        F.round(F.col("value") * 100).cast("bigint").alias("size0"))
    error_hour = F.col("anomalous") & (F.col("kind_bit") == 0)
    size_hour = F.col("anomalous") & (F.col("kind_bit") == 1)
    fields = base.select(
        "eid", "tstr", "endpoint",
        F.when(error_hour & (F.col("eid") % 2 == 0), F.lit(503)).otherwise(F.col("status0"))
        .cast("string").alias("status"),
        F.when(size_hour, F.col("size0") * 10).otherwise(F.col("size0")).cast("string").alias("size"))
    e = F.col("eid")
    tstr, endpoint, status, size = (F.col(c) for c in ("tstr", "endpoint", "status", "size"))
    good = F.concat_ws(" ", tstr, endpoint, status, size)
    # one well-formed line, spoilt by: a date with slashes, semicolons for
    # spaces, a size with a unit, a doubled space, a note before the stamp
    spoilt = F.element_at(F.array(
        F.concat_ws(" ", F.translate(tstr, "-", "/"), endpoint, status, size),
        F.translate(good, " ", ";"),
        F.concat(good, F.lit("kB")),
        F.concat(tstr, F.lit("  "), endpoint, F.lit(" "), status, F.lit(" "), size),
        F.concat(F.lit("retry "), good)), (e % 5 + 1).cast("int"))
    with_line = fields.select("eid", F.when(e % 67 == 11, spoilt).otherwise(good).alias("line"))
    line = F.col("line")
    lines = F.array(
        line,
        F.when(e % 97 == 0, line),
        F.when(e % 997 == 0, F.lit("")),
        F.when(e % 991 == 0, F.lit(CALENDAR_INVALID_LINE)),
    )
    return with_line.select(F.explode(F.array_compact(lines)).alias("value"))


def endpoint_dimension(events: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Endpoint metadata derived from ``events``: one row per event type.

    ``service_owner`` is ``<type>-team`` and ``expected_avg_response_size``
    the rounded mean size of that type.  Types in ``exclude`` have no row.  Grouping first keeps this tiny
    (one row per type) whatever the size of ``events``.
    """
    size = F.round(F.col("value") * 100)
    return (events.filter(~F.col("event_type").isin(*exclude))
            .groupBy("event_type")
            .agg(F.round(F.avg(size)).cast("bigint").alias("expected_avg_response_size"))
            .select(F.concat(F.lit("/api/"), F.col("event_type")).alias("endpoint"),
                    F.concat(F.col("event_type"), F.lit("-team")).alias("service_owner"),
                    "expected_avg_response_size"))
