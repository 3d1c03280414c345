"""Standard lazily-built frames of one data folder.

Every registered query starts from the ``events`` table of a data folder and
derives the access-log lines, parsed rows, typed rows, features and labels
through the library operators.  Most properties return a new lazy plan that
Catalyst optimises as a whole; ``dimension``, ``feature_table`` and what is
built on them run a job each, once, and read its stored result.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.functions import fixed
from windowlens.operators import clean, features, labels, parse
from windowlens.session import checkpoint_dir, work_path
from windowlens.sources import dimension, fixtures, tables

# Output rounding for engine-independent comparison of doubles.
RATE_DIGITS = 6
SIZE_DIGITS = 4
PROB_DIGITS = 9


def rounded(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Round the standard double columns present in ``df``."""
    digits = digits or {"error_rate": RATE_DIGITS, "avg_response_size": SIZE_DIGITS,
                        "p95_response_size": SIZE_DIGITS}
    cols = [F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    return df.select(*cols)


class Frames:
    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir
        self._tables: dict[str, DataFrame] = {}

    @property
    def events(self) -> DataFrame:
        return tables.spread(tables.read_table(self.spark, self.data_dir, "events"))

    @property
    def lines(self) -> DataFrame:
        return fixtures.access_log_lines(self.events)

    @property
    def parsed(self) -> DataFrame:
        return parse.parse_lines(self.lines)

    @property
    def typed(self) -> DataFrame:
        return clean.typed_rows(self.parsed)

    @property
    def deduped(self) -> DataFrame:
        return clean.dedupe(self.typed)

    @cached_property
    def dimension(self) -> DataFrame:
        """The endpoint dimension as a table of its own, read with its schema
        (one event type is left out, so that some rows find no match)."""
        path = work_path(self.spark, "dimension")
        fixtures.endpoint_dimension(self.events, exclude=("error",)).write.parquet(path)
        return dimension.read_dimension(self.spark, path)

    def features(self, width: str = fixed.WINDOW_WIDTH) -> DataFrame:
        """Window features as one lazy plan over the raw lines."""
        return features.window_features(self.deduped, width)

    def feature_table(self, width: str = fixed.WINDOW_WIDTH) -> DataFrame:
        """The window features materialised once (reliable checkpoint in the
        shared checkpoint folder).  Plans that need both the calendar and the
        features read this small table twice instead of scanning and parsing
        the raw lines twice; it also cuts the lineage for the model steps."""
        if width not in self._tables:
            checkpoint_dir(self.spark)
            self._tables[width] = self.features(width).checkpoint(eager=True)
        return self._tables[width]

    def spine(self, width: str = fixed.WINDOW_WIDTH) -> DataFrame:
        """Calendar from the first to the last day of the feature windows."""
        starts = self.feature_table(width).select(F.col("window_start").alias("ts"))
        return features.window_spine(starts, width)

    def labels(self, width: str = fixed.WINDOW_WIDTH) -> DataFrame:
        return fixtures.rule_labels(self.spine(width))

    def labeled(self, width: str = fixed.WINDOW_WIDTH) -> DataFrame:
        return labels.attach_labels(self.labels(width), self.feature_table(width))

    @cached_property
    def hourly_training(self) -> DataFrame:
        """Hourly labelled windows that have features (model input)."""
        return labels.with_features_only(self.labeled("1 hour"))
