"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per vertex (combined map-side) and a join of the edges
with those minima; no neighbourhood is gathered in one place, so a vertex with
a third of all edges is as cheap as any other. The edges of each round are
written to the shared folder; the number of rounds grows with the logarithm
of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands the least of its neighbourhood to its larger neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"),
                                                           F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex joins its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(vertex, component) of the undirected edges (a, b): component is the least
    vertex that can be reached. Vertices without edges are not returned."""
    now = stage.write(edges.select("a", "b").where("a != b").distinct(), "edges")
    state = _state(now)
    while True:
        new = stage.write(_small_star(_large_star(now).distinct()).distinct(), "star")
        new_state = _state(new)
        if new_state == state:
            break
        stage.release(now)
        now, state = new, new_state
    # now every edge leads from a vertex to the least of its component
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("vertex"), F.col("b").alias("component"))).distinct()


def contracted(edges: DataFrame, stage: Stage) -> DataFrame:
    """(vertex, component) after one step: vertices of one component may still have different
    names, those with one name (a vertex not returned has its own) are of one component. Stars,
    the usual shape of links to pivots, are done after it."""
    step = _small_star(_large_star(edges.select("a", "b").where("a != b")))
    return stage.write(step.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("component")), "contracted")
