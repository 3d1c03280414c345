"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A topology is a list of ``(region, rack, shard, weight)``.  A document
descends from the root: at every level each child draws ``-ln(u) / w`` with
``u`` from a hash of the document's id and the child's name and ``w`` the
weight of the child's subtree, and the smallest draw wins.  A child's draw
depends on nothing but its own name and weight, so a change of one weight
moves documents only into or out of that child's subtree; all other choices
stay as they are.  A new shard is added as a subtree of its own below the
root (``grown``), so it takes documents only into itself.

``slot`` numbers the documents of a shard without gaps: shards are cut into
256 parts by a hash, parts are numbered inside, and a table of at most
256 rows a shard gives each part its offset.  No task sees a whole shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.llm.common import documents_of, staged

Topology = list[tuple[str, str, int, float]]
LAW = "key"


def even_topology(regions: int = 2, racks: int = 2, shards: int = 4) -> Topology:
    """``regions * racks * shards`` shards of weight 1, numbered from 0."""
    return [(f"region{r}", f"rack{r}.{k}", (r * racks + k) * shards + s, 1.0)
            for r in range(regions) for k in range(racks) for s in range(shards)]


def grown(topology: Topology, weight: float = 1.0) -> Topology:
    """One more shard, numbered next, in a region and rack of its own."""
    n = max((s for *_, s, _ in topology), default=-1) + 1
    return topology + [(f"added{n}", f"added{n}", n, weight)]


def _uniform(doc: Column, child: str) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of id and child."""
    digits = F.substring(F.md5(F.concat(doc, F.lit("/" + child))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _draw(doc: Column, children: list[tuple[str, float]]) -> Column:
    """Position of the child with the smallest draw."""
    if len(children) == 1:
        return F.lit(0)
    costs = [F.struct((-F.ln(_uniform(doc, name)) / weight).alias("c"), F.lit(i).alias("i"))
             for i, (name, weight) in enumerate(children)]
    return F.array_min(F.array(*costs))["i"]


def shard_of(doc: Column, topology: Topology) -> Column:
    """The shard of a document id (a string column)."""
    used = [t for t in topology if t[3] > 0]
    if not used:
        raise ValueError("a topology needs a shard with a positive weight")
    return _descend(doc, used, 0)


def _descend(doc: Column, rows: Topology, level: int) -> Column:
    """``level`` 0: regions, 1: racks, 2: shards."""
    children: dict[str, Topology] = {}
    for t in rows:
        children.setdefault(str(t[level]) if level < 2 else f"shard{t[2]}", []).append(t)
    names = [(name, float(sum(t[3] for t in below))) for name, below in children.items()]
    inside = [F.lit(below[0][2]) if level == 2 else _descend(doc, below, level + 1) for below in children.values()]
    if len(inside) == 1:
        return inside[0]
    picked = _draw(doc, names)
    # the draw is taken once, inside a one-element transform
    out = F.transform(F.array(picked), lambda i: _case(i, inside))
    return F.element_at(out, 1)


def _case(i: Column, options: list[Column]) -> Column:
    c = F.when(i == 0, options[0])
    for k, o in enumerate(options[1:], 1):
        c = c.when(i == k, o)
    return c


def shard_documents(docs: DataFrame, topology: Topology | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, size, text_crc32, law, shard, slot,
    grown_shard).

    ``size`` is the UTF-8 length of the text plus 1; null texts are empty.
    The id alone decides the shard (law ``key``), so rows that repeat an id
    share a shard and have slots of their own; null ids are treated as the
    text "null"; an empty table gives an empty result; other columns are
    ignored whatever their names.
    """
    topology = topology or even_topology()
    d = documents_of(docs, id_col, text_col)
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = d.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(doc, topology).alias("shard"), shard_of(doc, grown(topology)).alias("grown_shard"),
        F.substring(F.md5(F.concat(doc, F.lit("/slot"))), 1, 2).alias("part"))
    rows = staged(rows, "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
               .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (rows.withColumn("r", F.row_number().over(inside))
            .join(F.broadcast(offsets), ["shard", "part"])   # at most 256 rows a shard
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("offset") + F.col("r") - 1).alias("slot"), "grown_shard"))
