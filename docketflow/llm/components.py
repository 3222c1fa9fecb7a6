"""Connected components of a stored edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _edges(rows: DataFrame) -> DataFrame:
    return rows.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _followed(p: DataFrame) -> DataFrame:
    """Each node's parent's parent."""
    q = p.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
    return p.join(q, F.col("parent") == F.col("_n")).select("node", F.col("_p").alias("parent"))


def components(links: DataFrame) -> DataFrame:
    """node, root of every node of ``links`` (a, b).  In each round a node
    takes its least neighbour as parent, chains are shortened, and the edges
    are contracted to the parents; the smaller graph goes on.  Nodes only move
    as rows of stored tables; the driver sees a count."""
    edges, maps = stored(_edges(links), "components"), []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        p = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        p = stored(p.select("node", F.least("node", "parent").alias("parent")), "components")
        p = stored(_followed(_followed(p)), "components")
        maps.append(p)
        a = p.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = p.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = stored(_edges(edges.join(a, "a").join(b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))), "components")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].withColumnRenamed("parent", "root")
    for p in maps[1:]:
        q = p.select(F.col("node").alias("_n"), "parent")
        out = out.join(q, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("parent", "root").alias("root"))
    return stored(out, "components")
