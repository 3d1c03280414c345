"""Raw text sources: one row per line in a single ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windowlens.sources.tables import spread

LINE_SCHEMA = "value STRING"


def read_lines(spark: SparkSession, path: str | list[str], spread_input: bool = True) -> DataFrame:
    """Read text files as lines, no schema imposed (parsing comes next).

    Splittable text is read in ``spark.sql.files.maxPartitionBytes`` chunks,
    so the scan parallelises with the input size.  A few non-splittable files
    (e.g. one large gzip log) give fewer tasks than cores; ``spread_input``
    then spreads the lines before the per-line parsing.
    """
    lines = spark.read.text(path)
    return spread(lines) if spread_input else lines


def read_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same lines as a Structured Streaming source over a folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-string-column frame as text, one line per row."""
    lines.select("value").write.mode(mode).text(path)


def numbered_lines(spark: SparkSession, path: str | list[str], first: int | None = None) -> DataFrame:
    """Lines (line_no, file, value), numbered from 1 in the order of file
    paths and of the lines in them; with ``first`` only that many.

    Lines are counted per piece of a file that a task reads, the counts of
    the pieces before give every piece its offset, and lines are numbered
    inside their piece, so no task holds more than one piece.  The numbers do
    not depend on how the files are cut.  With ``first``, pieces that begin
    beyond it are dropped before anything is shuffled.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"))          # rises with the lines of a piece
    pieces = lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("file", "_start").rowsBetween(Window.unboundedPreceding, -1)     # one row a piece
    offsets = pieces.select("file", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if first is not None:
        offsets = offsets.where(F.col("_before") < first)
    inside = Window.partitionBy("file", "_start").orderBy("_at")
    out = (lines.join(offsets, ["file", "_start"])
           .select((F.col("_before") + F.row_number().over(inside)).alias("line_no"), "file", "value"))
    return out if first is None else out.where(F.col("line_no") <= first)
