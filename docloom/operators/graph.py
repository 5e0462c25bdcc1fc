"""Connected components of edges between numbered rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.ingest import scratch


def cut(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again: its lineage ends there, and a lost executor loses nothing."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, keys: tuple[str, ...] = ("page_id",), most_rounds: int = 60) -> DataFrame:
    """(keys, u, root): the least vertex that each vertex of an edge reaches, for edges (keys, u, v) in either direction.

    Every round a vertex takes the least root among its neighbours, then that root's own root, so long chains shrink by
    jumps; only one least root for each vertex is shuffled. Loops and repeated edges are allowed.
    """
    keys = list(keys)
    both = cut(edges.select(*keys, "u", "v").unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    now = both.groupBy(*keys, "u").agg(F.least(F.col("u"), F.min("v")).alias("root"))
    total = None
    for _ in range(most_rounds):
        now = cut(now, "roots")
        met = both.join(now.select(*keys, F.col("u").alias("v"), F.col("root").alias("near")), [*keys, "v"]).groupBy(*keys, "u").agg(F.min("near").alias("near"))
        nearer = now.join(met, [*keys, "u"], "left").select(*keys, "u", F.least("root", F.coalesce("near", "root")).alias("root"))
        # where the root itself already has a smaller one, follow it
        jump = now.select(*keys, F.col("u").alias("root"), F.col("root").alias("far"))
        new = nearer.join(jump, [*keys, "root"], "left").select(*keys, "u", F.least("root", F.coalesce("far", "root")).alias("root"))
        state = now.agg(F.sum(F.xxhash64(*keys, "u", "root").cast("decimal(38,0)"))).first()[0]
        if state == total:
            return now
        total, now = state, new
    raise RuntimeError("components did not settle")


def least_roots(n: int, u: np.ndarray, v: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """For the vertices 0 to n - 1 the least one that each reaches over the edges (u, v), on top of what ``root`` already joins."""
    root = np.arange(n) if root is None else root
    while True:
        a, b = root[u], root[v]
        new = root.copy()
        np.minimum.at(new, np.maximum(a, b), np.minimum(a, b))
        while (far := new[new]).tobytes() != new.tobytes():
            new = far
        if (new == root).all():
            return root
        root = new


def page_components(edges: DataFrame, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``components`` of numbered vertices where all edges of one key are a page's: each page is done by itself, after one exchange."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(group[["u", "v"]].to_numpy(), return_inverse=True)
        at = at.reshape(-1, 2)
        root = ids[least_roots(len(ids), at[:, 0], at[:, 1])]
        return pd.DataFrame({**{k: group[k].iloc[0] for k in keys}, "u": ids, "root": root})

    types = dict(edges.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in (*keys, "u")) + f", root {types['u']}"
    return edges.select(*keys, "u", "v").groupBy(*keys).applyInPandas(run, schema)
