"""Queries over triples of extraction records, layout tokens and title pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import knowledge
from ..operators import ontology, titlepage
from ..sources import spans
from .fixtures import BOXES_SQL, boxes, table
from .registry import query
from .table_queries import _SET, _points

_UNITS = ", ".join(f"'{u}'" for u in knowledge.UNITS)
_TRIPLES = (
    _SET
    + f""", n AS (SELECT 'patent/' || coalesce(CAST(doc_id AS VARCHAR), '') AS patent, 'glass/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || glass_id AS glass, 'attribute/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || glass_id || '/' || property AS attribute, 'property/' || property AS prop, * FROM sp),
t AS (
  SELECT patent AS subject, 'type' AS predicate, 'Patent' AS object, doc_id FROM n UNION SELECT patent, 'has_glass', glass, doc_id FROM n UNION SELECT glass, 'type', 'Glass', doc_id FROM n
  UNION SELECT glass, 'has_attribute', attribute, doc_id FROM n UNION SELECT attribute, 'type', 'Attribute', doc_id FROM n UNION SELECT attribute, 'has_value', value, doc_id FROM n WHERE value <> ''
  UNION SELECT attribute, 'has_unit', 'unit/' || unit, doc_id FROM n WHERE unit IN ({_UNITS}) UNION SELECT attribute, 'of_property', prop, doc_id FROM n UNION SELECT prop, 'type', 'Property', doc_id FROM n UNION SELECT prop, 'has_abbrv', property, doc_id FROM n
)
"""
)


@query("ontology_triples", _TRIPLES + "SELECT subject, predicate, object, coalesce(CAST(doc_id AS VARCHAR), '') AS source FROM t")
def ontology_triples(spark, d):
    """Extraction records of all tables as triples."""
    return ontology.record_triples(_points(spark, d), written_once=True)


_CLASSES = ", ".join(f"('{c}', '{u}')" for c in ontology.CLASSES for u in (c, "Thing"))
_DOMAINS = ", ".join(f"('{p}', '{a}', '{b}')" for p, (a, b, _) in ontology.PROPERTIES.items())


@query("ontology_types", _TRIPLES + f", up(class, above) AS (VALUES {_CLASSES}), ps(predicate, own, too) AS (VALUES {_DOMAINS}), e AS (SELECT subject AS entity, object AS class FROM t WHERE predicate = 'type' UNION SELECT subject, own FROM t JOIN ps USING (predicate) UNION SELECT object, too FROM t JOIN ps USING (predicate) WHERE too <> 'str') SELECT DISTINCT entity, above AS class FROM e JOIN up USING (class)")
def ontology_types(spark, d):
    """What every entity is: said, by properties' classes and ranges, and by the classes above."""
    return ontology.types(ontology.told_triples(_points(spark, d)), ontology.schema(spark), ("doc_id",))


@query("ontology_closure", _TRIPLES.replace("WITH ", "WITH RECURSIVE ", 1) + ", e AS (SELECT DISTINCT subject, object FROM t WHERE predicate IN ('has_glass', 'has_attribute', 'has_unit', 'of_property')), r AS (SELECT subject, object FROM e UNION SELECT r.subject, e.object FROM r JOIN e ON e.subject = r.object) SELECT subject, object FROM r")
def ontology_closure(spark, d):
    """All that every entity leads to over glasses, attributes, units and properties."""
    links = ontology.told_triples(_points(spark, d)).where("predicate IN ('has_glass', 'has_attribute', 'has_unit', 'of_property')")
    return ontology.document_closure(links)  # only units and properties are shared by documents, and they lead to nothing


_TOKENS = f"""WITH b AS ({BOXES_SQL}), w AS (SELECT page_id, area_id, 'w ' || area_id AS content, x1, y1, x2, y2 FROM b WHERE category = 'String'),
c AS (SELECT page_id, area_id * 10 + i AS char_id, 'F' || ((area_id * 7 + i * i) % 3) AS font, x1 + (x2 - x1) * i / 5 + area_id % 4 * 0.25 AS x1, y1 + area_id % 3 * 0.3 AS y1, x1 + (x2 - x1) * (i + 1) / 5 + area_id % 4 * 0.25 AS x2, y2 + area_id % 3 * 0.3 AS y2 FROM w, (SELECT unnest(range(0, 5)) AS i)),
m AS (SELECT w.page_id, w.area_id, c.font, count(*) AS n, min(c.char_id) AS f FROM w JOIN c ON w.page_id = c.page_id AND least(w.x2, c.x2) >= greatest(w.x1, c.x1) AND least(w.y2, c.y2) >= greatest(w.y1, c.y1) AND (least(w.x2, c.x2) - greatest(w.x1, c.x1)) * (least(w.y2, c.y2) - greatest(w.y1, c.y1)) > 0.95 * ((c.x2 - c.x1) * (c.y2 - c.y1)) GROUP BY ALL),
f AS (SELECT page_id, area_id, font FROM (SELECT *, row_number() OVER (PARTITION BY page_id, area_id ORDER BY n DESC, f) AS j FROM m) WHERE j = 1),
t AS (
  SELECT w.page_id, 0 AS kind, w.area_id AS id, replace(content, ' ', '') AS token, x1 / 612 AS a, y1 / 840 AS b, x2 / 612 AS c, y2 / 840 AS d, coalesce(font, 'default') AS font FROM w LEFT JOIN f USING (page_id, area_id)
  UNION ALL SELECT page_id, 1, area_id, '##LTFigure##', x1 / 612, y1 / 612, x2 / 612, y2 / 612, 'default' FROM b WHERE category = 'TableCell' AND area_id % 5 = 0
  UNION ALL SELECT page_id, 2, area_id, '##LTLine##', x1 / 612, y1 / 612, x2 / 612, y2 / 612, 'default' FROM b WHERE category = 'DrawnLine'
)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY kind, id) - 1 AS place, token, least(1000, greatest(0, CAST(trunc(a * 1000) AS INTEGER))) AS x1, least(1000, greatest(0, CAST(trunc(b * 1000) AS INTEGER))) AS y1, least(1000, greatest(0, CAST(trunc(c * 1000) AS INTEGER))) AS x2, least(1000, greatest(0, CAST(trunc(d * 1000) AS INTEGER))) AS y2, font FROM t"""


@query("layout_tokens", _TOKENS)
def layout_tokens(spark, d):
    """Words with the fonts of the characters inside them, pictures and lines of all pages."""
    b, i = boxes(spark, d), F.col("area_id")
    words = b.where("category = 'String'")
    k = F.col("i")
    chars = words.withColumn("i", F.explode(F.array(*map(F.lit, range(5))))).select("page_id", (i * 10 + k).alias("char_id"), F.concat(F.lit("F"), ((i * 7 + k * k) % 3).cast("string")).alias("font"), (F.col("x1") + (F.col("x2") - F.col("x1")) * k / 5 + i % 4 * 0.25).alias("x1"), (F.col("y1") + i % 3 * 0.3).alias("y1"), (F.col("x1") + (F.col("x2") - F.col("x1")) * (k + 1) / 5 + i % 4 * 0.25).alias("x2"), (F.col("y2") + i % 3 * 0.3).alias("y2"))
    pages = b.select("page_id").distinct().select("page_id", F.lit(612.7).alias("xml_width"), F.lit(840.0).alias("xml_height"))
    named = words.select("page_id", i.alias("word_id"), F.concat(F.lit("w "), i.cast("string")).alias("content"), "x1", "y1", "x2", "y2")
    of = lambda c: b.where(c).select("page_id", "area_id", "x1", "y1", "x2", "y2")
    return spans.layout_tokens(named, chars, of("category = 'TableCell' AND area_id % 5 = 0"), of("category = 'DrawnLine'"), pages)


def title_pages(spark, d: str) -> tuple[DataFrame, DataFrame]:
    """A title page for every customer: codes on the left of each column, texts beside them or behind them."""
    fields = {54: "Glass of customer", 72: "A. Inventor", 71: "Applicant Ltd.", 43: "Mar. 5, 2019", 51: "C03C 3/091 (2006.01)", 57: "An abstract"}
    one = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), "c_name")
    rows = [F.struct(F.lit(code).alias("code"), F.lit(text).alias("text"), F.lit(100.0 + 40 * i).alias("y"), F.lit(50.0 if i % 2 == 0 else 350.0).alias("x")) for i, (code, text) in enumerate(fields.items())]
    each = one.withColumn("f", F.explode(F.array(*rows))).where((F.col("doc_id") + F.col("f.code")) % 7 != 0)
    text = F.when(F.col("f.code") == 54, F.concat("f.text", F.lit(" "), "c_name")).otherwise(F.col("f.text"))
    inside = (F.col("doc_id") + F.col("f.code")) % 3 == 0  # the text stands behind the code, in its own area
    label = F.struct(F.lit(0).alias("k"), F.when(inside, F.concat(F.lit("("), F.col("f.code"), F.lit(") "), text)).otherwise(F.concat(F.lit("("), F.col("f.code"), F.lit(")"))).alias("content"), F.col("f.x").alias("x1"), (F.col("f.x") + 30).alias("x2"))
    beside = F.when(~inside, F.struct(F.lit(1).alias("k"), text.alias("content"), (F.col("f.x") + 60).alias("x1"), (F.col("f.x") + 200).alias("x2")))
    areas = each.select("doc_id", "f.code", "f.y", F.explode(F.array_compact(F.array(label, beside))).alias("a"))
    areas = areas.select("doc_id", F.col("doc_id").alias("page_id"), (F.col("doc_id") * 1000 + F.col("code") * 10 + F.col("a.k")).alias("area_id"), F.lit("Line").alias("category"), "a.content", "a.x1", F.col("y").alias("y1"), "a.x2", (F.col("y") + 10).alias("y2"))
    return areas, one.select("doc_id", F.col("doc_id").alias("page_id"), F.lit(600.0).alias("img_width"), F.lit(0.5).alias("division"))



@query("title_page_records", "SELECT c_custkey AS doc_id, " + ", ".join(f"CASE WHEN (c_custkey + {c}) % 7 <> 0 THEN {t} END AS {n}" for n, c, t in (("title", 54, "'Glass of customer ' || c_name"), ("inventors", 72, "'A. Inventor'"), ("applicant", 71, "'Applicant Ltd.'"), ("publication_date", 43, "'2019-03-05'"), ("abstract", 57, "'An abstract'"))) + " FROM customer WHERE " + " OR ".join(f"(c_custkey + {c}) % 7 <> 0" for c in (54, 72, 71, 43, 51, 57)))
def title_page_records(spark, d):
    """Records read off the title pages of all customers."""
    return titlepage.from_title_page(*title_pages(spark, d)).select("doc_id", "title", "inventors", "applicant", "publication_date", "abstract")
