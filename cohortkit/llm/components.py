"""Connected components of an edge table, by alternating large and small stars.

Every round links each vertex's neighbours to the smallest vertex around it,
until each component is a star around its smallest vertex.  A round is two
partial-aggregated minima and two joins (which Spark splits at a hub), is
written to the shared folder, and replaces the round before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tables import split_join, write_seen
from cohortkit.session import drop_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return split_join(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    inner = split_join(down, least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is the
    smallest node that links reach.  Loops and repeated edges do no harm;
    edges with a null end are left out."""
    edges = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    loops = edges.where("u = v").select("u").distinct()
    seen = {"n": F.count(F.lit(1)), "s": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    edges, path, mark = write_seen(_small_star(edges), "components", **seen)
    edge_paths, before = [path], None
    while mark != before and mark["n"]:
        before = mark
        edges, path, mark = write_seen(_small_star(_large_star(edges)), "components", **seen)
        edge_paths.append(path)
        if len(edge_paths) > 2:
            drop_path(edges.sparkSession, edge_paths.pop(0))
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.join(edges.select("u"), "u", "left_anti").select(F.col("u").alias("node"))
    alone = alone.join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return stars.unionByName(roots).unionByName(alone)
