"""Extraction records and their schema as triples (subject, predicate, object, source), and what follows from them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import knowledge
from .graph import cut

#: Classes, and properties with the class they belong to and their range; functional ones have one value at most.
CLASSES = ("Patent", "Glass", "Attribute", "Property", "Unit")
PROPERTIES = {
    "has_title": ("Patent", "str", True), "has_applicant": ("Patent", "str", False), "has_inventor": ("Patent", "str", False), "has_assignee": ("Patent", "str", False),
    "date_of_patent": ("Patent", "str", True), "has_glass": ("Patent", "Glass", False), "has_abbrv": ("Property", "str", False), "has_value": ("Attribute", "str", True),
    "has_unit": ("Attribute", "Unit", True), "has_attribute": ("Glass", "Attribute", False),
}
TRIPLE = "subject string, predicate string, object string, source string"


def schema(spark: SparkSession) -> DataFrame:
    """Classes, properties and the units with their synonyms as triples of source ``schema``."""
    rows = [(c, "subclass_of", "Thing") for c in CLASSES]
    for name, (own, to, one) in PROPERTIES.items():
        rows += [(name, "domain", own), (name, "range", to)] + [(name, "type", "FunctionalProperty")] * one
    rows += [row for unit, synonyms in knowledge.UNITS.items() for row in [(f"unit/{unit}", "type", "Unit"), *((f"unit/{unit}", "has_synonym", s) for s in synonyms)]]
    return spark.createDataFrame([(*r, "schema") for r in rows], TRIPLE)


def _told(rows: DataFrame, source: Column, *triples: tuple[Column, str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """Triples of rows; a fourth entry of a triple tells which rows say it."""
    one = lambda s, p, o: F.struct(s.alias("subject"), F.lit(p).alias("predicate"), o.cast("string").alias("object"))
    each = F.explode(F.array(*[F.when(t[3], one(*t[:3])) if len(t) > 3 else one(*t) for t in triples]))
    return rows.select(*keep, each.alias("t"), source.cast("string").alias("source")).select(*keep, "t.*", "source").where("subject IS NOT NULL AND object IS NOT NULL AND object <> ''")


def told_triples(points: DataFrame, once: bool = False) -> DataFrame:
    """Triples of setpoints (doc_id, glass_id, property, value, unit) with their doc_id and source, as often as a setpoint says them.

    With ``once`` a document's first setpoint, the first of a glass and the first with a property alone say what belongs to those.
    """
    if dict(points.dtypes)["doc_id"] == "string":  # a null and an empty one are one document
        points = points.withColumn("doc_id", F.coalesce("doc_id", F.lit("")))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    patent, glass = F.concat(F.lit("patent/"), doc), F.concat_ws("/", F.lit("glass"), doc, F.col("glass_id"))
    attribute, prop = F.concat_ws("/", F.lit("attribute"), doc, F.col("glass_id"), F.col("property")), F.concat(F.lit("property/"), F.col("property"))
    kind = lambda s, c: (s, "type", F.lit(c))
    unit = F.when(F.col("unit").isin(*knowledge.UNITS), F.concat(F.lit("unit/"), F.col("unit")))
    say = {"document": (), "glass": (), "property": ()}
    if once:  # points in the order of setpoints are sorted again for the properties only
        orders = {"document": (("doc_id",), ("glass_id", "property")), "glass": (("doc_id", "glass_id"), ("property",)), "property": (("doc_id", "property"), ("glass_id",))}
        for name, (keys, by) in orders.items():
            points = points.withColumn(f"_{name}", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)) == 1)
        say = {name: (F.col(f"_{name}"),) for name in orders}
    of_document, of_glass, of_property = say.values()
    triples = [(*kind(patent, "Patent"), *of_document), (patent, "has_glass", glass, *of_glass), (*kind(glass, "Glass"), *of_glass), (glass, "has_attribute", attribute), kind(attribute, "Attribute"), (attribute, "has_value", F.col("value")), (attribute, "has_unit", unit), (attribute, "of_property", prop), (*kind(prop, "Property"), *of_property), (prop, "has_abbrv", F.col("property"), *of_property)]
    return _told(points, doc, *triples, keep=("doc_id",))


def record_triples(points: DataFrame, written_once: bool = False) -> DataFrame:
    """Triples of setpoints (doc_id, glass_id, property, value, unit), their document as source: patents have glasses, those have attributes with value, unit and property.

    Repeated ones are found inside a document, where points dealt by document are. ``written_once`` says that there is one point
    for a glass and property of a document, and no slash that could blur two glasses' names, as ``setpoints`` gives them: then no
    triple has to be looked up among the others.
    """
    if written_once and dict(points.dtypes)["doc_id"] != "string":
        return told_triples(points, once=True).drop("doc_id")
    return told_triples(points).distinct().drop("doc_id")


def metadata_triples(records: DataFrame) -> DataFrame:
    """Triples of document records (doc_id, title, applicant, inventors, assignee, publication_date)."""
    doc = F.col("doc_id").cast("string")
    patent = F.concat(F.lit("patent/"), doc)
    return _told(records, doc, (patent, "type", F.lit("Patent")), (patent, "has_title", F.col("title")), (patent, "has_applicant", F.col("applicant")), (patent, "has_inventor", F.col("inventors")), (patent, "has_assignee", F.col("assignee")), (patent, "date_of_patent", F.col("publication_date")))


def entities(rows: DataFrame, column: str = "json") -> DataFrame:
    """Entity records (head, relation, tail, source, flags) from their JSON; an end may be an object, which counts by its id. Those without a head are left out."""
    end = lambda name: F.coalesce(F.get_json_object(column, f"$.{name}.oid"), F.get_json_object(column, f"$.{name}"))
    told = rows.select(end("head").alias("head"), end("relation").alias("relation"), end("tail").alias("tail"), F.get_json_object(column, "$.source").alias("source"), F.from_json(F.get_json_object(column, "$.flags"), "map<string,string>").alias("flags"))
    return told.where("head IS NOT NULL")


def entity_triples(found: DataFrame) -> DataFrame:
    """Entity records as triples; without a relation they are ``related_to``."""
    return found.select(F.col("head").alias("subject"), F.coalesce("relation", F.lit("related_to")).alias("predicate"), F.col("tail").alias("object"), "source").where("object IS NOT NULL")


def above(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """(class, above): every class with itself and all it is a subclass of, by a recursive query over the schema's triples."""
    return spark.sql(
        """WITH RECURSIVE up(class, above) AS (
             SELECT DISTINCT subject, subject FROM {t} WHERE predicate = 'subclass_of'
             UNION ALL
             SELECT up.class, t.object FROM up JOIN {t} t ON t.subject = up.above AND t.predicate = 'subclass_of'
           ) SELECT DISTINCT class, above FROM up""",
        t=classes,
    )


def types(triples: DataFrame, classes: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """(entity, class): what entities are, said or following from a property's class or range, with all classes above.

    All three follow from a triple at once. Repeated ones are left out inside the keys of ``within`` first, then over all.
    """
    rules = classes.where("predicate = 'domain' OR predicate = 'range' AND object <> 'str'").groupBy(F.col("subject").alias("predicate"))
    rules = rules.agg(*[F.collect_set(F.when(F.col("predicate") == p, F.col("object"))).alias(p) for p in ("domain", "range")])
    pair = lambda e, c: F.struct(e.alias("entity"), c.alias("class"))
    s, o = F.col("subject"), F.col("object")
    said = F.when(F.col("predicate") == "type", F.array(pair(s, o)))
    follow = [F.transform("domain", lambda c: pair(s, c)), F.transform("range", lambda c: pair(o, c))]
    none = F.array().cast("array<struct<entity:string,class:string>>")
    every = triples.join(F.broadcast(rules), "predicate", "left").select(*within, F.explode(F.concat(*[F.coalesce(x, none) for x in (said, *follow)])).alias("e")).select(*within, "e.*")
    if within:
        every = every.distinct()
    every = every.select("entity", "class").repartition("entity").distinct()
    up = above(triples.sparkSession, classes)
    return every.join(F.broadcast(up), "class", "left").select("entity", F.coalesce("above", "class").alias("class")).distinct()


def closure(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(subject, object): all pairs joined by a chain of edges; every round joins what is known with itself, so chains double in length."""
    now = cut(edges.select("subject", "object").where("subject IS NOT NULL AND object IS NOT NULL").distinct(), "closure")
    n = now.count()
    for _ in range(most_rounds):
        longer = now.join(now.select(F.col("subject").alias("object"), F.col("object").alias("far")), "object").select("subject", F.col("far").alias("object"))
        now = cut(now.unionByName(longer).distinct(), "closure")
        if (more := now.count()) == n:
            return now
        n = more
    raise RuntimeError("the closure did not settle")


def reached(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the vertices 0 to n - 1 that a chain of the edges (a, b) joins; what a round finds is led on by one edge in the next."""
    new = seen = np.unique(a.astype(np.int64) * n + b)
    to, first = seen % n, np.searchsorted(seen // n, np.arange(n + 1))
    while len(new):
        size = np.diff(first)[new % n]
        at = np.repeat(first[new % n] - np.cumsum(size) + size, size) + np.arange(size.sum())
        new = np.setdiff1d(np.repeat(new // n, size) * n + to[at], seen)
        seen = np.union1d(seen, new)
    return seen // n, seen % n


def document_closure(edges: DataFrame, key: str = "doc_id") -> DataFrame:
    """``closure`` of edges with a key where all chains of a subject lie inside one key's edges, as those of a document do: each is done by itself, without an exchange if the edges are dealt by it."""

    def run(group: pa.Table) -> pa.Table:
        names = pa.concat_arrays([c for side in ("subject", "object") for c in group[side].chunks]).dictionary_encode()
        code = names.indices.to_numpy()
        a, b = reached(len(names.dictionary), *np.split(code, 2))
        return pa.table({"subject": names.dictionary.take(pa.array(a)), "object": names.dictionary.take(pa.array(b))})

    return edges.where("subject IS NOT NULL AND object IS NOT NULL").select(key, "subject", "object").groupBy(key).applyInArrow(run, "subject string, object string")
