"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from windowlens.functions import fixed


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_error(status: str | Column, min_status: int = fixed.ERROR_STATUS_MIN) -> Column:
    """1 when the status code counts as an error, 0 otherwise, NULL for NULL."""
    return (col_of(status) >= F.lit(min_status)).cast("int")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL (not an error) when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (zone-free)."""
    return F.unix_timestamp(col_of(ts))


def seeded_hash(text: str | Column, seed: int) -> Column:
    """MD5 hex digits of ``seed:text``: an order that changes with the seed
    and is the same on every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_of(text)))


#: What ``yyyy-MM-dd HH:mm:ss`` looks like.
STAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def stamp_of(text: str | Column) -> Column:
    """TIMESTAMP_NTZ of a text of exactly the form ``yyyy-MM-dd HH:mm:ss``;
    NULL for other forms and for dates or times that do not exist."""
    t = col_of(text)
    return F.when(t.rlike(STAMP_SHAPE), t.try_cast("timestamp_ntz"))


def stamp_at(seconds: Column) -> Column:
    """TIMESTAMP_NTZ of whole seconds since 1970-01-01."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def text_timestamp(ts: str | Column, fmt: str = fixed.TIMESTAMP_TEXT_FORMAT) -> Column:
    return F.date_format(col_of(ts), fmt)


def bucket_of(value: str | Column,
              buckets: Sequence[tuple[float | None, str]] = fixed.ERROR_RATE_BUCKETS,
              null_label: str = "no data") -> tuple[Column, Column]:
    """(bucket number, bucket label) of an ascending list of upper bounds.

    The last bound may be None (open).  NULL values get their own bucket with
    number len(buckets) + 1 instead of landing in the top bucket.
    """
    v = col_of(value)
    number = F.when(v.isNull(), F.lit(len(buckets) + 1))
    label = F.when(v.isNull(), F.lit(null_label))
    for i, (upper, name) in enumerate(buckets, start=1):
        cond = F.lit(True) if upper is None else (v < F.lit(upper))
        number = number.when(cond, F.lit(i))
        label = label.when(cond, F.lit(name))
    return number, label


def daypart_factor(ts: str | Column,
                   bands: Sequence[tuple[int, int, float]] = fixed.DAYPART_BANDS,
                   late: float = fixed.DAYPART_LATE_FACTOR) -> Column:
    hour = F.hour(col_of(ts))
    expr = None
    for lo, hi, factor in bands:
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, F.lit(factor)) if expr is None else expr.when(cond, F.lit(factor))
    return expr.otherwise(F.lit(late))


def is_weekend(ts: str | Column) -> Column:
    """True on Saturday and Sunday (weekday(): Monday=0)."""
    return F.weekday(col_of(ts)) >= 5


def weekend_factor(ts: str | Column, factor: float = fixed.WEEKEND_FACTOR) -> Column:
    return F.when(is_weekend(ts), F.lit(factor)).otherwise(F.lit(1.0))


def logistic_score(features: dict[str, float], intercept: float) -> Column:
    """P(class 1) = 1 / (1 + exp(-(intercept + sum(c_i * x_i))))."""
    z = F.lit(float(intercept))
    for name, coef in features.items():
        z = z + F.lit(float(coef)) * F.col(name).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def instant_of(ts: str | Column) -> Column:
    """TIMESTAMP (an instant) of a TIMESTAMP_NTZ read as UTC wall-clock,
    at second resolution and independent of the session time zone.  Needed
    where Spark insists on TIMESTAMP, such as streaming watermarks."""
    return F.timestamp_seconds(F.unix_timestamp(col_of(ts)))


def wall_clock_of(instant: str | Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall-clock) of a TIMESTAMP instant, independent
    of the session time zone (epoch + elapsed interval)."""
    secs = (F.unix_micros(col_of(instant)) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(secs=secs)
