"""Parent-child references, deletion, and revision state, as semi, anti and equi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def referenced(areas: DataFrame, refs: DataFrame, area: str = "area_id") -> DataFrame:
    """Areas that some parent refers to."""
    return areas.join(refs.select(F.col("child_id").alias(area)), area, "left_semi")


def delete(areas: DataFrame, refs: DataFrame, gone: DataFrame, area: str = "area_id") -> tuple[DataFrame, DataFrame]:
    """Areas and references without the deleted ids, as child or as parent."""
    kept = refs
    for side in ("child_id", "parent_id"):
        kept = kept.join(gone.select(F.col(area).alias(side)), side, "left_anti")
    return areas.join(gone.select(area), area, "left_anti"), kept.select("parent_id", "child_id", *[c for c in refs.columns if c not in ("parent_id", "child_id")])


def cleanup(refs: DataFrame, areas: DataFrame, area: str = "area_id") -> DataFrame:
    """References without dangling children; parents that have none left vanish with them."""
    return refs.join(areas.select(F.col(area).alias("child_id")), "child_id", "left_semi")


def value_or_children(areas: DataFrame, refs: DataFrame, value: str, area: str = "area_id") -> DataFrame:
    """An area's own value as a one-element list, else its children's values in reference order."""
    child = areas.select(F.col(area).alias("child_id"), F.col(value).alias("v"))
    lists = refs.join(child, "child_id").where("v IS NOT NULL").groupBy("parent_id").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("vs"))
    out = areas.join(lists, F.col(area) == F.col("parent_id"), "left")
    empty = F.array().cast("array<string>")
    return out.select(area, F.when(F.col(value).isNotNull(), F.array(F.col(value))).otherwise(F.coalesce(F.transform("vs", lambda x: x["v"]), empty)).alias("vals"))


def replace_area(refs: DataFrame, old, new) -> DataFrame:
    return refs.withColumn("child_id", F.when(F.col("child_id") == old, F.lit(new)).otherwise(F.col("child_id")))


def revision_state(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Objects whose last log entry (op 'add' or 'del') adds them."""
    last = log.groupBy(key).agg(F.max(F.struct(*order, "op")).alias("m"))
    return last.where("m.op = 'add'").select(key, *[F.col(f"m.{c}").alias(c) for c in order])
