"""A training corpus from raw documents, in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read back as the next
one's ``docs``.  All but the last return the columns of ``documents``.

Every stage works on all rows it is given and handles nulls, empty tables,
repeated rows and extra columns as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windowlens.llm import decontaminate, exact, langid, packing, simhash
from windowlens.llm.common import place, positional, same
from windowlens.llm.queries import TOKENIZER
from windowlens.session import work_path
from windowlens.sources.tables import read_table


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (doc_id, text_hash), with the
    columns of ``docs``; a document that repeats (same id and text) is
    returned once.  Join and dropping of repeats share one partitioning of
    the texts, so ids that are null are spelt out."""
    plain, names = positional(docs)

    def keys(doc_id, text_hash):
        return {"_no_id": doc_id.isNull(), "_id": F.coalesce(doc_id, F.lit(0)), "_hash": text_hash}

    text = F.col(place(names, "text")).cast("string")
    plain = plain.withColumns(keys(F.col(place(names, "doc_id")).cast("long"), F.xxhash64(text)))
    k = kept.withColumns(keys(F.col("doc_id"), F.col("text_hash"))).select("_no_id", "_id", "_hash")
    out = plain.join(k, ["_no_id", "_id", "_hash"], "left_semi").dropDuplicates(["_no_id", "_id", "_hash"])
    return out.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is identified, mixed ones too; ``und`` goes."""
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id; of rows that share it
    (or have none) but differ in case, the one with the largest text hash."""
    kept = exact.exact_duplicates(docs).where("kept")
    return _only(docs, kept.groupBy("text_sha256", "doc_id").agg(F.max("text_hash").alias("text_hash")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component the document with the smallest doc_id; of rows that
    share it (or have none), the one with the smallest fingerprint, then text
    hash."""
    found = simhash.near_duplicates(docs, shingle=3, max_bits=3)
    heads = found.where(same(F.col("doc_id"), F.col("component_id")) & (F.col("fp") == F.col("root_fp")))
    return _only(docs, heads.groupBy("doc_id", "root_fp").agg(F.min("text_hash").alias("text_hash")))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark: the coverage limit is
    0, so a document with any hit word goes."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences; doc_id
    and text_hash name the document's row in the stage before, whose text
    has the ids from ``start`` on."""
    return packing.pack_documents(docs, TOKENIZER).select(
        "doc_id", "text_hash", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: A conditional random field has no SQL twin; tests/llm compares every stage
#: with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
