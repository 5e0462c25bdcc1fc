"""Table structure and extraction: gaps and parts, grids, spans, header logic, setpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .dictionary import BROADCAST_ROWS, first_match
from .graph import cut


def gaps(values: DataFrame, threshold: float, key: str = "page_id") -> DataFrame:
    """Middles of gaps above the threshold between a key's sorted distinct values ``v``."""
    w = Window.partitionBy(key).orderBy("v")
    near = values.select(key, "v").distinct().withColumn("n", F.lead("v").over(w))
    return near.where(F.col("n") - F.col("v") > threshold).select(key, ((F.col("v") + F.col("n")) / 2).alias("gap"))


def split_parts(boxes: DataFrame, parts: int) -> DataFrame:
    """Nearly equal buckets of boxes by vertical middle, with the whole-number range of each."""
    m = (F.col("y1") + F.col("y2")) * 0.5
    t = boxes.select("page_id", m.alias("m"), F.ntile(parts).over(Window.partitionBy("page_id").orderBy(m, "area_id")).alias("part"))
    return t.groupBy("page_id", F.col("part").cast("long").alias("part")).agg(F.min("m").cast("long").alias("lo"), F.max("m").cast("long").alias("hi"), F.count("*").alias("n"))


def modal_width(rows: DataFrame, key: str) -> DataFrame:
    """The largest among the three most frequent row sizes ``n``."""
    often = rows.groupBy(key, "n").agg(F.count("*").alias("k"))
    top = often.withColumn("j", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("k"), F.desc("n")))).where("j <= 3")
    return top.groupBy(key).agg(F.max("n").alias("width"))


def upright(cells: DataFrame, *extra: str) -> DataFrame:
    """Rows and columns of transposed tables swapped; ``extra`` columns are kept."""
    return cells.select(*extra, "table_id", F.when(F.col("transposed"), F.col("c")).otherwise(F.col("r")).alias("r"), F.when(F.col("transposed"), F.col("r")).otherwise(F.col("c")).alias("c"), "content")


def dense(cells: DataFrame) -> DataFrame:
    """Every place of every table's rectangle, empty ones with null content.

    Cells are not joined with the places: each one gives its own place and the empty ones up to the next cell, the first one
    also those before it. Cells dealt by table stay where they are.
    """
    kinds, table = dict(cells.dtypes), Window.partitionBy("table_id")
    r, c, wide = F.col("r"), F.col("c"), F.col("mc") + F.lit(1).cast("long")
    sized = cells.select("table_id", "r", "c", "content", F.max("r").over(table).alias("mr"), F.max("c").over(table).alias("mc")).where("mr >= 0 AND mc >= 0")
    placed = sized.withColumn("at", F.when((r >= 0) & (c >= 0), r * wide + c).otherwise(F.lit(-1)))  # no place of its own
    w = table.orderBy("at")
    placed = placed.withColumns({"first": F.row_number().over(w) == 1, "next": F.coalesce(F.lead("at").over(w), (F.col("mr") + F.lit(1).cast("long")) * wide)})
    lo = F.when(F.col("first"), F.lit(0).cast("long")).otherwise(F.greatest("at", F.lit(0).cast("long")))
    part = placed.withColumns({"lo": lo, "hi": F.greatest("at", F.col("next") - 1)}).where("lo <= hi")
    rows = part.withColumn("y", F.explode(F.expr("sequence(lo div (mc + 1L), hi div (mc + 1L))")))
    places = rows.withColumn("x", F.explode(F.expr("sequence(greatest(lo - y * (mc + 1L), 0L), least(hi - y * (mc + 1L), CAST(mc AS BIGINT)))")))
    return places.select("table_id", F.col("y").cast(kinds["r"]).alias("r"), F.col("x").cast(kinds["c"]).alias("c"), F.when(F.col("y") * wide + F.col("x") == F.col("at"), F.col("content")).alias("content"))


def previous_nonempty(cells: DataFrame, along: str = "r", name: str = "above") -> DataFrame:
    """For every cell the nearest non-empty cell above in its column (along r) or left in its row (along c), and how many empty places lie between."""
    across = "c" if along == "r" else "r"
    w = Window.partitionBy("table_id", across).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("content").isNotNull(), F.struct(along, "content")), ignorenulls=True).over(w)
    out = dense(cells).withColumn("p", last).where("content IS NOT NULL AND p IS NOT NULL")
    return out.select("table_id", "r", "c", F.col("p.content").alias(name), (F.col(along) - F.col(f"p.{along}") - 1).alias("skipped"))


def header_paths(cells: DataFrame) -> DataFrame:
    """Data cells of labelled cells (see ``label_flags``) with all column labels above and row labels at the left, outermost first."""
    above = Window.partitionBy("table_id", "c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    left = Window.partitionBy("table_id", "r").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    out = cells.repartition("table_id").withColumns({"up": F.collect_list(F.when(F.col("column_label"), F.col("content"))).over(above), "side": F.collect_list(F.when(F.col("row_label"), F.col("content"))).over(left)})
    return out.where("NOT column_label AND NOT row_label").select("table_id", "r", "c", F.array_join("up", " | ").alias("column_path"), F.array_join("side", " | ").alias("row_path"))


def spans(cells: DataFrame) -> DataFrame:
    """Extent of equal texts in a table."""
    return cells.groupBy("table_id", "content").agg(F.min("r").alias("r1"), F.max("r").alias("r2"), F.min("c").alias("c1"), F.max("c").alias("c2"), F.count("*").alias("n"))


def numbering_runs(cells: DataFrame) -> DataFrame:
    """Rows and columns at least half of whose consecutive labels count up by one."""
    number = F.regexp_extract("content", r"(\d+)$", 1).try_cast("long")
    out, cells = None, cells.select("table_id", "r", "c", "content")  # cells dealt by table serve both axes as they are
    for axis, along, across in (("row", "r", "c"), ("column", "c", "r")):
        w = Window.partitionBy("table_id", along).orderBy(across)
        step = (F.lead("v").over(w) - F.col("v") == 1).cast("int")
        rows = cells.select("table_id", along, across, number.alias("v")).where("v IS NOT NULL").withColumn("s", step)
        part = rows.groupBy("table_id", F.col(along).alias("line")).agg(F.count("*").alias("n"), F.coalesce(F.sum("s"), F.lit(0)).alias("ups")).where("n >= 2").select("table_id", F.lit(axis).alias("axis"), "line", "n", (2 * F.col("ups") >= F.col("n") - 1).alias("numbered"))
        out = part if out is None else out.unionByName(part)
    return out


def orientation(runs: DataFrame) -> DataFrame:
    """A table is transposed if it has numbered columns and no numbered rows."""
    return runs.groupBy("table_id").agg((F.coalesce(F.bool_or((F.col("axis") == "column") & F.col("numbered")), F.lit(False)) & ~F.coalesce(F.bool_or((F.col("axis") == "row") & F.col("numbered")), F.lit(False))).alias("transposed"))


def label_flags(cells: DataFrame, header_rows: int = 1, label_columns: int = 1) -> DataFrame:
    """column_label and row_label per cell: rows whose first text was already seen in the header rows are headers too."""
    first = cells.where("c = 0").select("table_id", "r", F.col("content").alias("stub"))
    full = cells.select("table_id", "r").distinct().join(first, ["table_id", "r"], "left")
    stubs = full.where(F.col("r") < header_rows).select("table_id", F.coalesce("stub", F.lit("\x00")).alias("key")).distinct()
    heads = full.withColumn("key", F.coalesce("stub", F.lit("\x00"))).join(stubs, ["table_id", "key"], "left_semi").select("table_id", "r", F.lit(True).alias("head"))
    out = cells.join(heads, ["table_id", "r"], "left")
    return out.select("table_id", "r", "c", "content", F.coalesce("head", F.lit(False)).alias("column_label"), (F.col("head").isNull() & (F.col("c") < label_columns)).alias("row_label"))


def starting_rows(cells: DataFrame) -> DataFrame:
    """Last header row of a table: the first completely filled one, or the second before the first row up to it most of whose
    texts are numbers; null where no row is full, negative where a table begins with numbers."""
    number = F.coalesce(T.is_number(F.trim("content")), F.lit(False)).cast("int")
    rows = cells.groupBy("table_id", "r").agg(F.count("content").alias("n"), F.sum(number).alias("k"), F.max("c").alias("c"))
    width = F.max("c").over(Window.partitionBy("table_id")) + 1
    rows = rows.withColumn("w", width).withColumn("full", F.min(F.when(F.col("n") == F.col("w"), F.col("r"))).over(Window.partitionBy("table_id")))
    plain = F.min(F.when((F.col("r") <= F.col("full")) & (2 * F.col("k") > F.col("n")), F.col("r") - 2))
    return rows.groupBy("table_id").agg(F.least(F.first("full"), F.coalesce(plain, F.first("full"))).alias("last_header"))


def table_counts(tables: DataFrame, keys: tuple[str, ...] = ("doc",)) -> DataFrame:
    """Per document the number of tables (a number counts once, and a continued table not at all), and the column counts of all
    in order, -1 for those without cells. ``tables`` has the keys, table_id, number, continued and n_columns."""
    first = F.row_number().over(Window.partitionBy(*keys, "number").orderBy("table_id")) == 1
    listed = F.transform(F.sort_array(F.collect_list(F.struct("table_id", F.coalesce("n_columns", F.lit(-1)).alias("n")))), lambda x: x["n"])
    return tables.withColumn("first", first).groupBy(*keys).agg(F.count_if(F.col("first") & ~F.col("continued")).alias("n_tables"), listed.alias("widths"))


def carry_prefix(tables: DataFrame, doc: str, order: str, prefix: str) -> DataFrame:
    """The last known prefix of earlier tables of a document where a table has none."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return tables.withColumn("carried", F.last(prefix, ignorenulls=True).over(w))


def fill_span_row(cells: DataFrame) -> DataFrame:
    """Empty places of the first two rows take the other row's text."""
    two = dense(cells).where("r <= 1").groupBy("table_id", "c").agg(F.max(F.when(F.col("r") == 0, F.col("content"))).alias("a"), F.max(F.when(F.col("r") == 1, F.col("content"))).alias("b"))
    return two.select("table_id", "c", F.coalesce("a", "b").alias("row0"), F.coalesce("b", "a").alias("row1"))


def claims(cells: DataFrame) -> DataFrame:
    """Rows of two-column tables as compound and amount."""
    wide = upright(cells)
    two = wide.groupBy("table_id").agg(F.max("c").alias("m")).where("m = 1").select("table_id")
    rows = wide.join(two, "table_id", "left_semi").groupBy("table_id", "r").agg(F.max(F.when(F.col("c") == 0, F.col("content"))).alias("compound"), F.max(F.when(F.col("c") == 1, F.col("content"))).alias("amount"))
    return rows.select("table_id", "r", F.replace(F.replace("compound", F.lit(" ι "), F.lit(" + ")), F.lit(" t "), F.lit(" + ")).alias("compound"), "amount")


def property_names(labels: DataFrame, knowledge: dict[str, list[str]]) -> DataFrame:
    """Distinct label texts with property name, unit and comment.

    The unit is the first bracketed text after bracket repair. A name without a plus sign is looked up
    whole and marked if it is a total amount; one with several summands is looked up summand by summand;
    one with a plus sign and a single summand stays as it is.
    """
    own = labels.select("content").where("content IS NOT NULL").distinct()
    parsed = own.select("content", T.fix_brackets(F.col("content")).alias("fixed")).select("content", T.name_of(F.col("fixed")).alias("name"), T.unit_of(F.col("fixed")).alias("unit"))
    plus = F.contains("name", F.lit("+"))
    summands = F.filter(F.transform(F.split("name", r"\+"), lambda x: F.trim(x)), lambda x: x != "")
    terms = parsed.select("content", "name", "unit", F.when(~plus, F.array("name")).otherwise(summands).alias("terms"))
    hits = F.transform("terms", lambda x: F.struct(x.alias("term"), first_match(x, knowledge).alias("hit")))
    found = terms.select("content", "name", "unit", (plus & (F.size("terms") > 1)).alias("many"), F.when(~plus | (F.size("terms") > 1), hits).alias("hits"))
    one = F.get("hits", F.lit(0))
    arrow = lambda x: F.concat(x["term"], F.lit(" -> "), x["hit"]["pattern"])
    total = F.when(F.contains("name", F.lit("total amount")), " [total]").otherwise("")
    several = F.array_join(F.transform("hits", lambda x: F.coalesce(x["hit"]["canonical"], x["term"])), " + ")
    name = F.when(F.col("many"), several).when(one["hit"]["canonical"].isNotNull(), F.concat(one["hit"]["canonical"], total)).otherwise(F.col("name"))
    comment = F.when(F.col("many"), F.array_join(F.transform(F.filter("hits", lambda x: x["hit"].isNotNull()), lambda x: F.concat(arrow(x), F.lit("  "))), "")).when(one["hit"]["canonical"].isNotNull(), arrow(one)).otherwise("new")
    out = found.select("content", name.alias("property"), "unit", comment.alias("comment"))
    return out.select("content", "property", F.when(F.col("unit") != "", T.guard_unit(F.col("unit"), F.col("property"))).alias("unit"), "comment")


def setpoints(cells: DataFrame, knowledge: dict[str, list[str]]) -> DataFrame:
    """(doc_id, glass_id, property, value, unit, comment, tables): the last write of a document's glass and property wins.

    Tables with two columns are claims and left out. Glasses are the numbered heads of columns; tables
    of one document that name the same glass add to one record, whose ``tables`` are all that name it with
    the property. Cells without a doc_id column count as one document's.
    """
    # heads, labels and widths are windows inside a document's table: cells dealt by document need no exchange for them, nor for the last writes
    over = lambda *keys: Window.partitionBy("doc_id", "table_id", *keys)
    if "doc_id" not in cells.columns:
        cells = cells.withColumn("doc_id", F.lit(None).cast("long"))
    upright_cells = upright(cells, "doc_id")
    names = cut(property_names(upright_cells.where("c = 0 AND r > 0").select("content"), knowledge), "names").withColumnRenamed("content", "label")
    # a head's number is read where the head is, and rows of a sort that serves two windows are thinned before the next one
    number = F.when((F.col("r") == 0) & (F.col("c") > 0), F.struct("content", T.example_id(F.col("content")).alias("id")))
    whole = over().orderBy("c").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wide = upright_cells.withColumn("number", number).withColumn("m", F.max("c").over(whole)).withColumn("head", F.max("number").over(over("c")))
    wide = wide.where("m > 1 AND r > 0 AND content IS NOT NULL AND (c = 0 OR c > 0 AND head.id IS NOT NULL)").select("doc_id", "table_id", "r", "c", "content", F.col("head.id").alias("glass_id"))
    body = wide.withColumn("label", F.max(F.when(F.col("c") == 0, F.col("content"))).over(over("r"))).where("c > 0 AND label IS NOT NULL")
    few = names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    data = body.join(F.broadcast(names) if few else names, "label")
    data = data.withColumns({"value": T.clean_value(F.col("content")), "unit": T.value_unit(F.col("content"), F.col("unit"))})
    data = data.select("doc_id", "glass_id", "property", "table_id", "r", "c", "value", F.coalesce("unit", F.lit("")).alias("unit"), "comment")
    write = Window.partitionBy("doc_id", "glass_id", "property").orderBy(*[F.desc(c) for c in ("table_id", "r", "c", "value", "unit", "comment")])
    every = F.sort_array(F.collect_set("table_id").over(write.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return data.withColumns({"tables": every, "write": F.row_number().over(write)}).where("write = 1").select("doc_id", "glass_id", "property", "value", "unit", "comment", "tables")


_GLASS = ("doc_id", "glass_id")


def _is_component(value, unit):
    return ~value.isin("N.A.", "0.0", "") & unit.isin("mol%", "wt%", "mass%")


def component_count(points: DataFrame) -> DataFrame:
    """Number of composition values per glass of a document."""
    return points.groupBy(*_GLASS).agg(F.count_if(_is_component(F.col("value"), F.col("unit"))).alias("n_components"), F.count("*").alias("n_properties"))


def column_keys(properties: list[str]) -> dict[str, str]:
    """A plain column name for every property: letters and digits in lower case, numbered where that isn't unique."""
    out: dict[str, str] = {}
    for p in properties:
        key = "".join(ch if ch.isascii() and ch.isalnum() else "_" for ch in p.translate({0x2080 + i: str(i) for i in range(10)})).lower()
        out[p] = key if key not in out.values() else f"{key}_{len(out)}"
    return out


def wide_table(points: DataFrame, properties: list[str]) -> DataFrame:
    """One row per glass of a document: value and unit columns for each of the properties, all others in ``others``.

    The columns are the dictionary's names, so the schema doesn't hang on the data; ``others`` is a list of
    ``name=value unit`` for properties found beyond it, by name.
    """
    entry = F.struct("property", F.struct("value", "unit").alias("s"))
    rows = points.groupBy(*_GLASS).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("m"))
    cols = [F.col("m")[p][c].alias(f"{key}_{c}") for p, key in column_keys(properties).items() for c in ("value", "unit")]
    rest = F.map_entries(F.map_filter("m", lambda k, v: ~k.isin(*properties)))
    return rows.select(*_GLASS, *cols, F.array_join(F.transform(rest, lambda x: F.concat(x["key"], F.lit("="), x["value"]["value"], F.lit(" "), x["value"]["unit"])), "; ").alias("others"))


def extraction(points: DataFrame) -> DataFrame:
    """Nested record of each glass of a document: identifier, components, tables that name it, properties as a map."""
    entry = F.struct("property", F.struct("value", "unit", "comment").alias("s"))
    out = points.groupBy(*_GLASS).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("setpoints"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tables")))).alias("tables"))
    return out.select(*_GLASS, F.concat_ws("-", F.col("doc_id").cast("string"), "glass_id").alias("generatedObjectIdentifier"), F.size(F.map_filter("setpoints", lambda k, v: _is_component(v["value"], v["unit"]))).alias("NumberOfComponent"), "tables", "setpoints")
