"""Which files a job has read: a ledger, and what is new against it.

A file counts as the one in the ledger if path, length and time of change are
equal, so a file that was rewritten is read again.  Facts of files come from a
listing; nothing is read to find that there is nothing to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.operators.incremental import read_or_empty

LEDGER_SCHEMA = "path string, length long, changed timestamp, run string"
_FACTS = ["path", "length", "changed"]


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, changed) of the files below a folder."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
              .load(folder))
    return listed.select("path", "length", F.col("modificationTime").alias("changed"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, LEDGER_SCHEMA)


def unread(spark: SparkSession, folder: str, ledger_path: str, pattern: str = "*") -> DataFrame:
    """The files the ledger doesn't have (left anti join)."""
    return files(spark, folder, pattern).join(ledger(spark, ledger_path), _FACTS, "left_anti")


def run_once(spark: SparkSession, folder: str, ledger_path: str, run: str, job, pattern: str = "*") -> int:
    """Give ``job`` the lines (value, file) of the files not yet read and put
    them into the ledger afterwards; returns their number.

    A run that fails leaves the ledger as it was; its files are new to the
    next one.  The paths pass through the driver, as in any file listing.
    """
    found = unread(spark, folder, ledger_path, pattern).collect()
    if not found:
        return 0
    lines = spark.read.text([r["path"] for r in found]).select("value", F.col("_metadata.file_path").alias("file"))
    job(lines)
    (spark.createDataFrame([(r["path"], r["length"], r["changed"], run) for r in found], LEDGER_SCHEMA)
     .write.mode("append").parquet(ledger_path))
    return len(found)
