"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.session import work_path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark application, as
    ``spark-submit --py-files`` would (the driver serves the archive)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="py-files-"), "windowlens_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed ``c0, c1, ...`` so that neither names
    an operator adds nor names differing only in case can clash, and the
    original names."""
    names = list(df.columns)
    return df.toDF(*[f"c{i}" for i in range(len(names))]), names


def place(names: list[str], wanted: str) -> str:
    """The positional name of column ``wanted``: an exact match first, else
    the first match that differs in case only."""
    if wanted in names:
        return f"c{names.index(wanted)}"
    lowered = [n.lower() for n in names]
    if wanted.lower() in lowered:
        return f"c{lowered.index(wanted.lower())}"
    raise ValueError(f"no column {wanted!r} among {names}")


def take(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns: ``take(docs, doc_id="doc_id", text="body")``.
    Everything else is pruned at the scan."""
    plain, names = positional(df)
    return plain.select(*[F.col(place(names, source)).alias(alias) for alias, source in wanted.items()])


def documents_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string) of a table, extra columns left behind."""
    ship(df.sparkSession)
    d = take(df, doc_id=id_col, text=text_col)
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def keep_rows(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text passes:
    ``keep`` maps the texts of a batch (None for null) to booleans."""
    ship(docs.sparkSession)
    plain, names = positional(docs)
    text = place(names, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(b[text].cast(pa.string()).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    back: later steps read it instead of recomputing it, whichever executors
    are lost."""
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def byte_values(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(binary).to_pylist()]


def same(a: Column, b: Column) -> Column:
    """Equality under which null equals null."""
    return a.eqNullSafe(b)


class ByteCache(dict):
    """A dict that starts anew once its keys and values hold ``limit`` bytes;
    keys of over ``longest`` characters (text without blanks) are not kept."""

    ENTRY = 100    # bytes of a slot in the table, about

    def __init__(self, limit: int, longest: int = 256):
        super().__init__()
        self.limit, self.longest, self.held = limit, longest, 0

    def put(self, key, value) -> None:
        if len(key) > self.longest or key in self:
            return
        size = sys.getsizeof(key) + sys.getsizeof(value) + self.ENTRY
        if self.held + size > self.limit:
            self.clear()
            self.held = 0
        self[key] = value
        self.held += size


def batches_of(schema: pa.Schema, rows: Iterator[tuple], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(schema, held)
            held = []
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)], schema=schema)
