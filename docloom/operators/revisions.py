"""Changes to documents as table operations: areas, references, links, pages, layout and revisions.

Tables: ``areas`` (doc_id, page_id, area_id, category, ...), ``refs`` (parent_id, child_id, pos), ``revisions`` (doc_id,
rev, area_id, op). Every change gives new tables; nothing is changed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def area_ids(areas: DataFrame, taken: DataFrame, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """New areas with ids that no area has: numbers after the largest of their key, in the order of their boxes."""
    top = taken.groupBy(*keys).agg(F.max("area_id").alias("top"))
    w = Window.partitionBy(*keys).orderBy("y1", "x1", "x2", "y2", "category")
    return areas.drop("area_id").withColumn("k", F.row_number().over(w)).join(top, list(keys), "left").withColumn("area_id", F.coalesce("top", F.lit(0).cast("long")) + F.col("k")).drop("k", "top")


def add_areas(areas: DataFrame, refs: DataFrame, new: DataFrame, parents: DataFrame | None = None, rev: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Areas and references with the new areas added: each is referred to by its page and by its ``parents`` (parent_id, child_id)."""
    own = new if rev is None or "rev" not in areas.columns else new.withColumn("rev", F.lit(rev))
    page = new.select(F.col("page_id").alias("parent_id"), F.col("area_id").alias("child_id"))
    more = page if parents is None else page.unionByName(parents.select("parent_id", "child_id"))
    last = refs.groupBy("parent_id").agg(F.max("pos").alias("last"))
    w = Window.partitionBy("parent_id").orderBy("child_id")
    placed = more.withColumn("k", F.row_number().over(w)).join(last, "parent_id", "left").select("parent_id", "child_id", (F.coalesce("last", F.lit(-1)) + F.col("k")).cast(refs.schema["pos"].dataType).alias("pos"))
    return areas.unionByName(own.select(*areas.columns)), refs.select("parent_id", "child_id", "pos").unionByName(placed)


def replace_areas(areas: DataFrame, refs: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Areas ``old`` replaced by ``new`` ones (already in areas): references go to the new area, the old one goes.

    Both must have the same category, else the query fails when it runs.
    """
    kind = lambda side: areas.select(F.col("area_id").alias(side), F.col("category").alias(f"c_{side}"))
    checked = pairs.join(kind("old"), "old").join(kind("new"), "new")
    same = F.assert_true(F.col("c_old") == F.col("c_new"), F.lit("an area is replaced by one of its category"))
    checked = checked.where(same.isNull()).select("old", "new")
    moved = refs.join(checked, F.col("child_id") == F.col("old"), "left").withColumn("child_id", F.coalesce("new", "child_id")).drop("old", "new")
    return areas.join(checked.select(F.col("old").alias("area_id")), "area_id", "left_anti"), moved


def add_links(links: DataFrame, new: DataFrame) -> DataFrame:
    """Links (source_id, target_id, kind) with new ones, each once."""
    return links.unionByName(new.select(*links.columns)).distinct()


def add_pages(pages: DataFrame, new: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Pages with new ones numbered on after their document's last."""
    last = pages.groupBy(doc).agg(F.max("number").alias("last"))
    w = Window.partitionBy(doc).orderBy("page_id")
    own = new.withColumn("k", F.row_number().over(w)).join(last, doc, "left").withColumn("number", (F.coalesce("last", F.lit(-1)) + F.col("k")).cast(pages.schema["number"].dataType))
    return pages.unionByName(own.select(*pages.columns))


def delete_recent(areas: DataFrame, categories: list[str], last: int, doc: str = "doc_id") -> DataFrame:
    """Areas without those of the categories that the last so many revisions of their document added (0: all revisions)."""
    newest = F.max("rev").over(Window.partitionBy(doc))
    recent = F.lit(True) if not last else F.col("rev") > newest - last
    return areas.withColumn("_recent", recent).where(~(F.col("category").isin(*categories) & F.col("_recent"))).drop("_recent")


def page_of(areas: DataFrame, refs: DataFrame, pages: DataFrame) -> DataFrame:
    """Each area's page: the first by number that refers to it."""
    met = refs.join(pages.select(F.col("page_id").alias("parent_id"), "number"), "parent_id").groupBy("child_id").agg(F.min(F.struct("number", "parent_id")).alias("m"))
    return areas.select("area_id").join(met, F.col("area_id") == F.col("child_id"), "left").select("area_id", F.col("m.parent_id").alias("page_id"))


def by_ids(areas: DataFrame, ids: DataFrame) -> DataFrame:
    """The areas with the ids; ids that no area has give no row."""
    return areas.join(ids.select("area_id").distinct(), "area_id", "left_semi")


def partition(rows: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass a test, and all others (null counts as failing)."""
    passed = F.coalesce(test, F.lit(False))
    return rows.where(passed), rows.where(~passed)


def is_rotated(rotation: Column) -> Column:
    return F.coalesce(rotation, F.lit(0)) != 0


def set_layout(pages: DataFrame, rotation: Column | None = None, division: Column | None = None, layout: Column | None = None) -> DataFrame:
    """Pages with new layout values; rotations other than quarter turns and divisions beyond 0 to 1 fail when the query runs."""
    out = pages
    if rotation is not None:
        out = out.withColumn("rotation", F.when(rotation.isin(0, 90, 180, 270), rotation).otherwise(F.raise_error(F.lit("a rotation is 0, 90, 180 or 270"))))
    if division is not None:
        out = out.withColumn("division", F.when(division.between(0, 1), division).otherwise(F.raise_error(F.lit("a division lies between 0 and 1"))))
    if layout is not None:
        out = out.withColumn("typographic_columns", F.when(layout.isin("one", "two", "mixed"), layout).otherwise(F.raise_error(F.lit("a layout is one, two or mixed"))))
    return out


def same_space(a: Column, b: Column) -> Column:
    """True where two boxes are in the same space; a query that reads it fails where they are not."""
    return F.when(a.eqNullSafe(b), F.lit(True)).otherwise(F.raise_error(F.lit("boxes of different spaces")))


def predecessor(values: DataFrame, numbers: DataFrame, key: str = "page_id") -> DataFrame:
    """For each value ``x`` the largest number ``n`` of its key that is smaller; 0 where there is none."""
    both = values.select(key, F.col("x").alias("v"), F.lit(1).alias("k"), "x").unionByName(numbers.select(key, F.col("n").alias("v"), F.lit(2).alias("k"), F.lit(None).cast(values.schema["x"].dataType).alias("x")))
    w = Window.partitionBy(key).orderBy("v", "k").rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("n", F.last(F.when(F.col("k") == 2, F.col("v")), ignorenulls=True).over(w))
    return found.where("k = 1").select(key, "x", F.coalesce("n", F.lit(0)).alias("n"))


def children_text(refs: DataFrame, areas: DataFrame) -> DataFrame:
    """(parent_id, content): texts of each parent's children in order, one after the other."""
    met = refs.join(areas.select(F.col("area_id").alias("child_id"), "content"), "child_id").where("content IS NOT NULL")
    return met.groupBy("parent_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]), " ").alias("content"))
