"""Typed rows, duplicate removal and the cleaning audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.operators.parse import accepted

TYPED_COLUMNS = ("ts", "endpoint", "status_code", "response_size")


def typed_rows(parsed: DataFrame) -> DataFrame:
    """Accepted lines cast to ``ts timestamp_ntz, endpoint string,
    status_code int, response_size bigint``.

    ``try_cast`` turns calendar-invalid stamps (which the pattern admits) into
    NULL instead of failing the job under ANSI mode; ``bigint`` keeps sizes
    above 2^31-1.
    """
    return accepted(parsed).select(
        F.col("timestamp").try_cast("timestamp_ntz").alias("ts"),
        F.col("endpoint"),
        F.col("status_code").try_cast("int").alias("status_code"),
        F.col("response_size").try_cast("bigint").alias("response_size"),
    )


def dedupe(rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Remove exact duplicates (over ``keys``, default all columns).

    Planned as a hash aggregate with a map-side partial step, so a hot
    repeated row shrinks to one row per task before the shuffle.
    """
    return rows.dropDuplicates(list(keys)) if keys else rows.dropDuplicates()


def cleaning_audit(parsed: DataFrame) -> DataFrame:
    """Row counts per cleaning step as ``(step_no, step, rows)``.

    One scan: all lines are grouped by (tag, typed fields) with a
    multiplicity count (the same shuffle a dedupe needs; rejected lines,
    whose fields are mostly empty, collapse in the map-side partial
    aggregate), and one global aggregate over the groups gives lines read,
    rejected, accepted, duplicates, deduped rows and deduped rows whose
    timestamp did not survive the cast.
    """
    ok = F.col("parse_ok")
    cast = parsed.select(
        ok,
        F.col("timestamp").try_cast("timestamp_ntz").alias("ts"),
        F.col("endpoint"),
        F.col("status_code").try_cast("int").alias("status_code"),
        F.col("response_size").try_cast("bigint").alias("response_size"))
    groups = cast.groupBy("parse_ok", *TYPED_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    totals = groups.agg(
        F.sum(n).alias("read"),
        F.coalesce(F.sum(F.when(~ok, n)), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(ok, n)), F.lit(0)).alias("accepted"),
        F.count_if(ok).alias("deduped"),
        F.count_if(ok & F.col("ts").isNull()).alias("null_ts"))
    return totals.select(F.stack(
        F.lit(6),
        F.lit(1), F.lit("lines_read"), F.col("read"),
        F.lit(2), F.lit("rejected"), F.col("rejected"),
        F.lit(3), F.lit("accepted"), F.col("accepted"),
        F.lit(4), F.lit("duplicates"), F.col("accepted") - F.col("deduped"),
        F.lit(5), F.lit("after_dedupe"), F.col("deduped"),
        F.lit(6), F.lit("null_timestamp"), F.col("null_ts")).alias("step_no", "step", "rows"))


def dedupe_audit(parsed: DataFrame) -> DataFrame:
    """One row: accepted rows, rows after dedupe, duplicates removed (one
    grouping of the typed rows with a multiplicity count)."""
    groups = typed_rows(parsed).groupBy(*TYPED_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").alias("accepted"), F.count(F.lit(1)).alias("deduped")).select(
        "accepted", "deduped", (F.col("accepted") - F.col("deduped")).alias("duplicates"))


def in_range(rows: DataFrame, start: str, end: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(rows with ``start <= ts < end``, the others): stamps outside the
    range, or missing, go to the second frame, for quarantine."""
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    ok = F.coalesce((F.col(ts) >= lo) & (F.col(ts) < hi), F.lit(False))
    return rows.filter(ok), rows.filter(~ok)
