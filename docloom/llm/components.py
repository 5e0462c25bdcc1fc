"""Connected components of an edge table by alternating large and small stars.

Both steps keep every component connected and pull its vertices towards its least vertex; the number
of rounds grows with the square of the logarithm of the largest component at most. Each step is one
partial-aggregated minimum per vertex and one join, so neighbours of a hub are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = _least(down)
    return down.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(vertex, root) for every vertex that has an edge to another and is not its component's least vertex.

    ``edges`` has long columns ``u`` and ``v``; loops and repeated edges are allowed; no edges give no rows.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    for _ in range(most_rounds):
        new = materialize(_small_star(_large_star(now)), "edges")
        got = new.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        remove(now.sparkSession, now._docloom_path)
        now = new
        if tuple(got) == sign or got[0] == 0:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        sign = tuple(got)
    raise RuntimeError("components did not settle")
