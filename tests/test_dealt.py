"""What is dealt once stays where it is: plans without further exchanges, and the work inside documents."""

import numpy as np
import pytest
from docloom import catalogue
from docloom.functions import knowledge
from docloom.operators import ontology, tables
from pyspark.sql import functions as F


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["setpoint_last_wins", "component_count", "setpoints_wide", "extraction_records", "ontology_triples", "ontology_closure"])
def test_points_are_exchanged_once(spark, sf, name):
    assert exchanges(catalogue.queries()[name](spark, sf)) == 1


def test_document_closure_is_the_closure(spark):
    """Three documents with branches, a circle and a node that leads to nothing in common."""
    rng = np.random.default_rng(3)
    rows = [(d, f"{d}/{a}", f"{d}/{b}") for d in range(3) for a, b in rng.integers(0, 9, (12, 2)).tolist()] + [(d, f"{d}/1", "end") for d in range(3)] + [(0, None, "0/1")]
    edges = spark.createDataFrame(rows, "doc_id long, subject string, object string")
    want = {tuple(r) for r in ontology.closure(edges).collect()}
    got = [tuple(r) for r in ontology.document_closure(edges).collect()]
    assert set(got) == want and len(got) == len(want)


def test_types_follow_in_one_pass(spark):
    triples = spark.createDataFrame([("p", "has_glass", "g", "1"), ("g", "has_value", "3", "1"), ("x", "type", "Own", "1"), ("p", "type", "Patent", "2"), ("p", "has_glass", "g", "2")], ontology.TRIPLE)
    got = sorted(map(tuple, ontology.types(triples, ontology.schema(spark)).collect()))
    assert got == sorted([("p", "Patent"), ("p", "Thing"), ("g", "Glass"), ("g", "Thing"), ("g", "Attribute"), ("x", "Own")])
    assert got == sorted(map(tuple, ontology.types(triples.withColumn("doc_id", F.col("source")), ontology.schema(spark), ("doc_id",)).collect()))


def test_null_and_empty_document_are_one(spark):
    points = spark.createDataFrame([(None, "g", "p", "1", "C"), ("", "g", "p", "1", "C")], "doc_id string, glass_id string, property string, value string, unit string")
    got = [tuple(r) for r in ontology.record_triples(points).collect()]
    assert len(got) == len(set(got)) and ("patent/", "has_glass", "glass//g", "") in got


def test_title_pages_are_not_sent_to_all_tasks(spark, sf):
    """A small file of customers makes many areas: Spark's guess from the file's size must not decide."""
    assert "BroadcastExchange" not in catalogue.queries()["title_page_records"](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["numbering_runs", "table_orientation"])
def test_cells_of_tables_are_not_exchanged(spark, sf, name):
    """Only lines are dealt, once for each axis at most; cells stay where their table is."""
    plan = catalogue.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 0 and plan.count("ENSURE_REQUIREMENTS") == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_made_in_compiled_code(spark, sf):
    """A lambda over the array of a line's cells would have Spark interpret all that builds them."""
    assert "lambda" not in plan_of(catalogue.queries()["cell_spans"](spark, sf))


def test_last_writes_are_found_by_one_sort(spark, sf):
    """No sets or structs carried through two aggregations of strings; heads and widths share a sort."""
    plan = plan_of(catalogue.queries()["setpoint_last_wins"](spark, sf))
    assert "ObjectHashAggregate" not in plan and plan.count("Sort [") <= 4


def test_last_write_wins_with_all_tables(spark):
    """Two tables name a glass; one says a property twice, and one head has an empty twin."""
    rows = [("d", 1, 0, 1, "Ex. 1"), ("d", 1, 0, 2, "Ex. 2"), ("d", 1, 1, 0, "B2O3"), ("d", 1, 1, 1, "4"), ("d", 1, 1, 2, "5"), ("d", 1, 2, 0, "B2O3"), ("d", 1, 2, 1, "6 %"), ("d", 2, 0, 2, "Ex. 1"), ("d", 2, 0, 2, None), ("d", 2, 1, 0, "MgO"), ("d", 2, 1, 2, "7"), ("d", 2, 2, 0, "B2O3"), ("d", 2, 2, 2, None), ("d", 3, 0, 2, "Ex. 1"), ("d", 3, 1, 0, "B2O3"), ("d", 3, 1, 2, "8"), ("d", 3, 2, 2, "9")]
    cells = spark.createDataFrame([(*r, False) for r in rows], "doc_id string, table_id long, r int, c int, content string, transposed boolean")
    got = {(r.glass_id, r.property): (r.value, r.unit, list(r.tables)) for r in tables.setpoints(cells, knowledge.DEFAULT).collect()}
    assert got == {("Ex-1", "B₂O₃"): ("8", "", [1, 3]), ("Ex-2", "B₂O₃"): ("5", "", [1]), ("Ex-1", "MgO"): ("7", "", [2])}


def test_triples_of_points_written_once_are_not_looked_up(spark, sf):
    points = spark.createDataFrame([(d, f"g{g}", f"p{p}", str(p), "wt%" if p % 2 else "C") for d in (1, 2, None) for g in range(3) for p in range(g, 4)] + [(1, "g0", "", "", "C")], "doc_id long, glass_id string, property string, value string, unit string")
    got = [tuple(r) for r in ontology.record_triples(points, written_once=True).collect()]
    assert len(got) == len(set(got)) and set(got) == {tuple(r) for r in ontology.record_triples(points).collect()}
    keys = [x.split("]")[0] for x in plan_of(catalogue.queries()["ontology_triples"](spark, sf)).split("keys=[")[1:]]
    assert keys and not any("subject" in k for k in keys)


@pytest.mark.parametrize("name", ["table_html", "table_csv", "table_markdown"])
def test_tables_are_filled_without_a_join(spark, sf, name):
    df = catalogue.queries()[name](spark, sf)
    assert exchanges(df) == 1 and "Join" not in plan_of(df)


def test_dense_is_the_joined_rectangle(spark):
    """Holes, a place taken twice, cells without a place, a table of one place and one whose cells have none."""
    rng = np.random.default_rng(5)
    rows = [(t, r, c, f"{t} {r} {c}") for t in range(6) for r, c in rng.integers(0, 6, (7, 2)).tolist()]
    rows += [(0, 3, 3, None), (1, None, 2, "x"), (1, None, 1, "x"), (2, 8, None, "y"), (3, -1, 2, "z"), (7, 0, 0, "one"), (8, 1, None, "a"), (8, None, 1, "b"), (9, 0, 4, "end"), (10, None, 1, "none")]
    cells = spark.createDataFrame(rows, "table_id long, r int, c int, content string")
    size = cells.groupBy("table_id").agg(F.max("r").alias("mr"), F.max("c").alias("mc"))
    places = size.select("table_id", "mc", F.explode(F.expr("sequence(0, mr)")).alias("r")).select("table_id", "r", F.explode(F.expr("sequence(0, mc)")).alias("c"))
    want = places.join(cells, ["table_id", "r", "c"], "left")
    got = tables.dense(cells)
    assert got.dtypes == want.dtypes
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
