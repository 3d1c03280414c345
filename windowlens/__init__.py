"""windowlens: windowed log features, labels and anomaly scores on Spark.

Layout: ``sources`` (text lines, tables, dimension, fixture), ``operators``
(parse, clean, enrich, features, labels, quality, sink, ranking, split,
evaluate, drift, traffic, model, runlog), ``streaming`` (the same features
as a Structured Streaming job), ``plans`` (ETL stage functions, registered
queries and their SQL twins), ``functions`` (fixed values and column
expressions).  Every operator takes and returns DataFrames.
"""

__version__ = "0.1.0"
