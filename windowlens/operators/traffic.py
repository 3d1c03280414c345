"""Traffic profile, proportional allocation, top endpoints, line rendering
and repeatable sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.functions.expressions import daypart_factor, is_weekend, seeded_hash, text_timestamp, weekend_factor


def daypart_band(ts: str, bands=fixed.DAYPART_BANDS) -> tuple:
    """(band number, band label ``HH-HH``) of the hour of ``ts``; hours after
    the last band get number len(bands)+1 and label ``<last>-24``."""
    hour = F.hour(F.col(ts))
    number = None
    label = None
    for i, (lo, hi, _) in enumerate(bands, start=1):
        cond = (hour >= lo) & (hour < hi)
        text = F.lit(f"{lo:02d}-{hi:02d}")
        number = F.when(cond, F.lit(i)) if number is None else number.when(cond, F.lit(i))
        label = F.when(cond, text) if label is None else label.when(cond, text)
    last = bands[-1][1]
    return number.otherwise(F.lit(len(bands) + 1)), label.otherwise(F.lit(f"{last:02d}-24"))


def daypart_profile(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows per (hour band, weekend) with the expected traffic factor
    (band factor x weekend factor)."""
    number, label = daypart_band(ts)
    return (rows.filter(F.col(ts).isNotNull())
            .groupBy(number.alias("band_no"), label.alias("band"), is_weekend(ts).alias("is_weekend"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.first(daypart_factor(ts) * weekend_factor(ts)).alias("factor")))


def allocate(spine: DataFrame, total_rows: DataFrame, ts: str = "window_start") -> DataFrame:
    """Split a total over windows in proportion to their traffic factor:
    ``round(total * w / sum(w))`` (half to even), the last window absorbing the rounding
    drift so the parts add up exactly.

    ``total_rows`` is a one-row frame with column ``total``.  The total, the
    weight sum, the last window and the drift are global aggregates used as
    scalar subqueries (partial aggregation, no single-partition window), so
    the windows stay spread over tasks.
    """
    weighted = spine.select(ts, (daypart_factor(ts) * weekend_factor(ts)).alias("weight"))
    total = total_rows.select("total").scalar()
    weight_sum = weighted.agg(F.sum("weight")).scalar()
    last = weighted.agg(F.max(ts)).scalar()
    share = F.rint(total * F.col("weight") / weight_sum).cast("bigint")
    with_share = weighted.select(ts, "weight", share.alias("_rows"))
    drift = total - with_share.agg(F.sum("_rows")).scalar()
    return with_share.select(ts, "weight", F.when(F.col(ts) == last, F.col("_rows") + drift)
                             .otherwise(F.col("_rows")).alias("rows"))


def endpoint_topk(rows: DataFrame, k: int = 10, key: str = "endpoint") -> DataFrame:
    """The k keys with most rows, ties broken by key."""
    return (rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), F.asc(key)).limit(k))


def render_lines(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Typed rows back to access-log text lines (rows without a timestamp
    cannot be rendered and are skipped)."""
    return rows.filter(F.col(ts).isNotNull()).select(
        F.concat_ws(" ", text_timestamp(ts), F.col("endpoint"), F.col("status_code").cast("string"),
                    F.col("response_size").cast("string")).alias("value"))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Repeatable sample of about ``fraction`` of the rows: those whose
    seeded hash of ``key`` (any column, its text) is below a bound.

    The same rows are chosen on every run, partitioning and engine; rows with
    equal keys are chosen together; NULL keys count as empty text.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    if fraction == 1:
        return df
    bound = f"{int(fraction * 16 ** 8):08x}"
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return df.filter(F.substring(seeded_hash(text, seed), 1, 8) < bound)
