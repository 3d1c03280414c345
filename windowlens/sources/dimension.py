"""Endpoint dimension from any Spark reader, with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DIMENSION_SCHEMA = ("endpoint STRING NOT NULL, service_owner STRING NOT NULL, "
                    "expected_avg_response_size BIGINT NOT NULL")


def read_dimension(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                   options: dict[str, str] | None = None,
                   schema: str = DIMENSION_SCHEMA) -> DataFrame:
    """Read the endpoint dimension (key ``endpoint``) with a fixed schema.

    ``fmt`` is any Spark source: ``parquet``, ``csv`` (pass
    ``{"header": "true"}``), ``json``, or ``jdbc`` (pass ``url`` and
    ``dbtable`` in ``options`` and no path).  The explicit schema avoids an
    inference pass.  File sources ignore NOT NULL and read an absent column as
    NULL, so a NULL in a NOT NULL column fails the job here.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "jdbc":
        reader = reader.schema(schema)
    df = reader.load(path) if path is not None else reader.load()
    required = [f.name for f in StructType.fromDDL(schema).fields if not f.nullable]
    return df.select(*[
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"dimension column {c} is NULL or absent")).cast(t))
        .otherwise(F.col(c)).alias(c) if c in required else F.col(c) for c, t in df.dtypes])
