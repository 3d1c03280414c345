"""Connected components of a link table, as alternating star joins.

Every round replaces links by links to smaller neighbours (large star, then
small star), which halves the depth of the trees; a path of n nodes ends
after O(log n) rounds.  Links and labels stay in DataFrames: the driver sees
two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, root): ``root`` is the smallest node
    reachable; nodes that are their own root have no row.

    Self links are ignored, nulls are ignored, repeated links count once, an
    empty table gives an empty table.
    """
    small = (links.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    small = staged(small, "links")
    seen = _state(small)
    while True:
        both = small.unionByName(small.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = (large.join(root, "u").where(F.col("v") != F.col("m"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = staged(rest.unionByName(root.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _state(small)
        if now == seen:
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
