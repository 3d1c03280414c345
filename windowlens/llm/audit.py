"""Filter interaction audit over failing-id tables.

Every filter is a table of the ids that fail it.  What a sequence of filters
removes depends on its prefix as a set only, so all orders share the lattice
of prefixes:

* survivors of a prefix plus one filter: survivors LEFT ANTI its ids;
* removals by a filter after a prefix: survivors LEFT SEMI its ids;
* redundant failures (removed earlier): its ids LEFT ANTI the survivors;
* unique failures: removals after all other filters;
* label losses: the labels of the removals.

Documents that fail nothing survive every prefix; an anti join counts them
once and the lattice holds the others only.  A level of the lattice (all
prefixes of one length) is one table, joined by id: its rows are dealt out by
id once, before they are multiplied by the filters still to come.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import byte_values, shuffle_partitions, ship, staged, take
from windowlens.session import work_path

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_INSIDE = bytes(range(0x80, 0xC0))      # UTF-8 bytes that don't begin a character
_BASE = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()),
                   ("fails", pa.list_(pa.string()))])


def _without(text: bytes, dropped: bytes) -> int:
    return len(text.translate(None, dropped))


def text_filters(text: bytes) -> list[str]:
    """Names of the filters that a text (UTF-8) fails by itself."""
    words = text.split()                # ASCII white space
    fails = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * (len(text) - _without(text, _CAPITALS)) > 2 * _without(text, _INSIDE),
        "D": _without(text, _MARKS) < len(text),
    }
    return [name for name, failed in fails.items() if failed]


# --- failing-id tables -------------------------------------------------------

def failing_ids(docs: DataFrame, filters=text_filters, repeated: str | None = "E", id_col: str = "doc_id",
                text_col: str = "text", part_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, part) and the id tables (row, part,
    filter), stored as one folder a filter.

    ``filters`` names the filters a text fails; ``repeated`` names the filter that fails a text identical to that of any
    smaller doc_id.  ``row`` numbers the rows, so that ids that repeat or are
    null stay apart; a null id is neither smaller nor larger than others.
    """
    spark = docs.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = byte_values(b["text"])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["part"], pa.array([sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([filters(t) for t in texts], pa.list_(pa.string()))], schema=_BASE)

    plain = take(docs, doc_id=id_col, text=text_col, part=part_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"))
    base = staged(plain.mapInArrow(run, "doc_id long, part string, digest binary, fails array<string>")
                  .withColumn("row", F.monotonically_increasing_id()), "audit-documents")
    tables = base.select("row", "part", F.explode("fails").alias("filter"))
    if repeated:
        first = (base.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                 .where("n > 1").drop("n"))
        tables = tables.unionByName(base.join(first, "digest").where("doc_id > first")
                                    .select("row", "part", F.lit(repeated).alias("filter")))
    path = work_path(spark, "llm-audit-failing")
    tables.write.partitionBy("filter").parquet(path)
    schema = "row long, part string, filter string"
    return base.select("row", "doc_id", "part"), spark.read.schema(schema).parquet(path)


def label_flags(base: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality",
                toxic_col: str = "toxic") -> DataFrame:
    """``base`` with ``good`` and ``toxic`` (0 or 1); an id labelled more than
    once has a flag if any of its labels sets it."""
    marks = take(labels, doc_id=id_col, good=good_col, toxic=toxic_col).where("doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c) for c in ("good", "toxic")])
    return base.join(marks, "doc_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")}).drop("doc_id")


# --- lattice of prefixes -----------------------------------------------------

def prefix_counts(base: DataFrame, failing: DataFrame, names: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``base`` (row, part, good, toxic), ``failing`` (row, part, filter) ->

    * kept (part, prefix, kept), for every prefix;
    * removed (part, prefix, bit, removed, good_lost, toxic_lost);
    * redundant (part, prefix, bit, redundant).

    Prefixes and filters are bits in the order of ``names``; groups without
    rows have no row.
    """
    m, n = len(names), shuffle_partitions(base)
    bit_of = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(names) for x in (f, 1 << i)]), F.col("filter"))
    failing = failing.select("row", F.col("part").alias("of_part"), bit_of.alias("of_bit"))
    ids = failing.select("row", "of_bit").repartition(n, "row")
    alive = staged(base.join(failing.select("row"), "row", "left_semi").withColumn("prefix", F.lit(0)), "audit-level")
    clean = (base.join(failing.select("row"), "row", "left_anti").groupBy("part").agg(F.count("*").alias("kept"))
             .select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << m) - 1))).alias("prefix"), "kept"))
    bits = F.array(*[F.lit(1 << i) for i in range(m)])
    kept, removed, redundant = [clean], [], []
    for size in range(m + 1):
        kept.append(alive.groupBy("part", "prefix").agg(F.count("*").alias("kept")))
        if size == m:
            break
        dealt = alive.repartition(n, "row")
        steps = dealt.withColumn("bit", F.explode(F.filter(bits, lambda b: b.bitwiseAND(F.col("prefix")) == 0)))
        # the bits meet in a residual condition, so that the rows stay dealt out by id alone
        fails = (steps["row"] == ids["row"]) & (steps["bit"].bitwiseXOR(ids["of_bit"]) == 0)
        removed.append(steps.join(ids, fails, "left_semi").groupBy("part", "prefix", "bit").agg(
            F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")))
        sets = F.array(*[F.lit(p) for p in range(1 << m) if p.bit_count() == size])
        asked = failing.repartition(n, "row").withColumn(
            "of_prefix", F.explode(F.filter(sets, lambda p: p.bitwiseAND(F.col("of_bit")) == 0)))
        still = (asked["row"] == dealt["row"]) & (asked["of_prefix"].bitwiseXOR(dealt["prefix"]) == 0)
        redundant.append(asked.join(dealt, still, "left_anti").groupBy(
            F.col("of_part").alias("part"), F.col("of_prefix").alias("prefix"), F.col("of_bit").alias("bit"))
            .agg(F.count("*").alias("redundant")))
        alive = staged(steps.where("bit > prefix").join(ids, fails, "left_anti")
                       .select("row", "part", "good", "toxic", F.col("prefix").bitwiseOR(F.col("bit")).alias("prefix")),
                       "audit-level")

    def all_of(tables):
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    kept = all_of(kept).groupBy("part", "prefix").agg(F.sum("kept").alias("kept"))
    return kept, all_of(removed), all_of(redundant)


def steps_of(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, bits before, bit) of every step of every order."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(names[x] for x in order), step, before, 1 << f))
            before |= 1 << f
    return out


# --- operator ----------------------------------------------------------------

def interactions(docs: DataFrame, labels: DataFrame, filters=text_filters, repeated: str | None = "E",
                 names: str = "ABCDE", id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """One row per (part, filter_order, step): kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley; zeros included.

    All ``len(names)!`` orders are listed, so there should be few filters.

    A null text counts as empty (no words, no failure but too few words); a
    null part as the empty string; a null doc_id has no labels and neither
    fails ``repeated`` nor makes others fail it; rows that repeat count
    singly; very long texts are judged whole; an empty table gives an empty
    result; other columns are ignored whatever their names.
    """
    base, failing = failing_ids(docs, filters, repeated, id_col, text_col, part_col)
    base = staged(label_flags(base, labels, id_col), "audit-labelled")
    counts = [staged(t, f"audit-{name}") for t, name in
              zip(prefix_counts(base, failing, names), ("kept", "removed", "redundant"))]
    kept, removed, redundant = counts
    m = len(names)
    others = F.lit((1 << m) - 1).bitwiseXOR(F.col("bit"))
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(m - 1 - k)) for k in range(m)]),
                          F.bit_count("prefix") + 1)
    of_filter = removed.groupBy("part", "bit").agg(
        F.sum(F.when(F.col("prefix") == others, F.col("removed"))).alias("unique_fails"),
        F.sum(weight * F.col("removed")).alias("shapley"))
    listed = F.array(*[F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"),
                                F.lit(prefix).alias("prefix"), F.lit(bit).alias("bit"))
                       for order, step, prefix, bit in steps_of(names)])
    grid = base.select("part").distinct().select("part", F.inline(listed))
    after = kept.select("part", F.col("prefix").alias("after"), "kept")
    out = (grid.withColumn("after", F.col("prefix").bitwiseOR(F.col("bit")))
           .join(removed, ["part", "prefix", "bit"], "left").join(redundant, ["part", "prefix", "bit"], "left")
           .join(after, ["part", "after"], "left").join(of_filter, ["part", "bit"], "left"))
    return out.select("part", "filter_order", "step", *[
        F.coalesce(c, F.lit(0)).cast("long").alias(c)
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])
