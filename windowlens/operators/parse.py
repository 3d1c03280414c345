"""Parse raw lines into string fields with a pass/fail tag.

Rejected lines are kept (tagged), never dropped silently; ``quarantine``
returns them with a reason.  Only group 0 of the anchored pattern is
extracted, then split on single spaces, which yields exactly the four
capture groups because none of them can contain a space.  That replaces five
group extractions, and the match sits behind a one-row ``explode`` so that a
later ``parse_ok`` filter is not pushed below it and re-inlined: the pattern
runs once per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.functions import fixed

FIELDS = ("timestamp", "endpoint", "status_code", "response_size")
REASON_OK, REASON_NULL, REASON_BLANK, REASON_MALFORMED = "ok", "null", "blank", "malformed"
REASON_BAD_TIMESTAMP = "bad_timestamp"


def parse_lines(raw: DataFrame, value_col: str = "value",
                pattern: str = fixed.LOG_LINE_PATTERN, strict_timestamps: bool = False) -> DataFrame:
    """Add ``timestamp endpoint status_code response_size`` (strings),
    ``parse_ok`` (boolean) and ``parse_reason`` to a lines frame.

    A line passes when the anchored pattern matches the whole, non-empty line.
    Fields of a non-matching line are ``''`` (NULL for a NULL line); fields of
    a line with a trailing line terminator are filled but the line fails.
    The pattern admits calendar-invalid stamps (``2024-13-45 99:99:99``);
    by default they pass and become NULL at the cast (counted as
    ``null_timestamp``); ``strict_timestamps`` rejects them here with reason
    ``bad_timestamp``.
    """
    value = F.col(value_col)
    # group 0 as a column, so the field expressions reuse it instead of
    # re-running the pattern
    # exploding a one-element array puts the match behind a Generate node:
    # a later filter on parse_ok cannot be pushed below it, so the pattern
    # runs exactly once per line
    matched = raw.select("*", F.explode(F.array(F.regexp_extract(value, pattern, 0))).alias("_whole"))
    whole = F.col("_whole")
    parts = F.split(whole, " ")
    # field -> positions in the match split on ' ' (the timestamp has one space)
    pieces = {
        "timestamp": F.concat_ws(" ", F.get(parts, 0), F.get(parts, 1)),
        "endpoint": F.get(parts, 2),
        "status_code": F.get(parts, 3),
        "response_size": F.get(parts, 4),
    }
    ok = F.coalesce((whole != F.lit("")) & (whole == value), F.lit(False))
    bad_stamp = F.lit(False)
    if strict_timestamps:
        bad_stamp = ok & pieces["timestamp"].try_cast("timestamp_ntz").isNull()
        ok = ok & ~bad_stamp
    reason = (F.when(value.isNull(), F.lit(REASON_NULL))
               .when(value == F.lit(""), F.lit(REASON_BLANK))
               .when(bad_stamp, F.lit(REASON_BAD_TIMESTAMP))
               .when(ok, F.lit(REASON_OK))
               .otherwise(F.lit(REASON_MALFORMED)))
    cols = [F.when(whole == F.lit(""), F.lit("")).when(whole.isNotNull(), expr).alias(name)
            for name, expr in pieces.items()]
    keep = [F.col(c) for c in raw.columns]
    return matched.select(*keep, *cols, ok.alias("parse_ok"), reason.alias("parse_reason"))


def accepted(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines that passed, without the raw text and the tag."""
    return parsed.filter(F.col("parse_ok")).drop("parse_ok", "parse_reason", value_col)


def quarantine(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Rejected lines with their reason and whatever fields were recovered."""
    return (parsed.filter(~F.col("parse_ok"))
            .select(value_col, "parse_reason", *FIELDS))


def parse_audit(parsed: DataFrame) -> DataFrame:
    """One row: lines, rejected lines and the rejected share (0..1)."""
    return parsed.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.col("parse_ok")).alias("rejected"),
        F.try_divide(F.count_if(~F.col("parse_ok")).cast("double"),
                     F.count(F.lit(1)).cast("double")).alias("rejected_share"),
    )


def reason_counts(parsed: DataFrame) -> DataFrame:
    """Lines per parse reason."""
    return parsed.groupBy("parse_reason").agg(F.count(F.lit(1)).alias("lines"))


def quarantine_sample(parsed: DataFrame, n: int = 10, value_col: str = "value") -> DataFrame:
    """The first ``n`` rejected lines in text order: a stable sample (a
    bounded top-n, at most n rows kept per task)."""
    return (quarantine(parsed, value_col)
            .orderBy(F.asc_nulls_last(value_col), F.asc_nulls_last("parse_reason")).limit(n))
