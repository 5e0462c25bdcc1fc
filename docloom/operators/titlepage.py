"""Title pages of patents: document numbers, labelled blocks, and bibliographic fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..functions.text import inid_hits, ipc_codes, month_date

# Fixed value: the pattern of a document number, and the suffixes tried in this order for one that has none.
NUMBER = r"(?:[A-Z]{2})?\s?((?:\d+)[ ,/]?)+\s?(?:[A-Z]\d)?"
SUFFIXES = ("A1", "B1", "B2")


def number_candidate(s: Column) -> Column:
    """First document number of a text without blanks and commas; null where it has at most five characters."""
    hit = F.regexp_extract(s, NUMBER, 0)
    return F.when(F.length(hit) > 5, F.translate(hit, " ,", ""))


def number_parts(number: Column) -> Column:
    """(prefix, digits, suffixes): the country is US and the suffixes all known ones where the number has none."""
    plain = F.translate(number, " ,/", "")
    prefix, suffix = F.regexp_extract(plain, "^[A-Z]{2}", 0), F.regexp_extract(plain, r"[A-Z]\d$", 0)
    every = F.array(*[F.lit(x) for x in SUFFIXES])
    return F.struct(F.when(prefix == "", "US").otherwise(prefix).alias("prefix"), F.regexp_extract(plain, r"\d+", 0).alias("digits"), F.when(suffix == "", every).otherwise(F.array(suffix)).alias("suffixes"))


def document_numbers(lines: DataFrame, doc: str = "doc_id", line: str = "line", by_id: bool = True) -> DataFrame:
    """The most frequent document number of each document's lines (the first met among equals); from the id itself if that is one and ids are names (``by_id``)."""
    own = number_candidate(F.col(doc).cast("string")) if by_id else F.lit(None).cast("string")
    ids = lines.select(doc).distinct().select(doc, own.alias("own"))
    seen = lines.select(doc, "line_no", number_candidate(F.col(line)).alias("number")).where("number IS NOT NULL")
    n = seen.groupBy(doc, "number").agg(F.count("*").alias("n"), F.min("line_no").alias("f"))
    best = n.groupBy(doc).agg(F.max(F.struct("n", (-F.col("f")).alias("f"), "number")).alias("m")).select(doc, F.col("m.number").alias("best"))
    out = (ids.join(best, doc, "left") if by_id else best.withColumn("own", own)).select(doc, F.coalesce("own", "best").alias("number")).where("number IS NOT NULL")
    return out.select(doc, "number", number_parts(F.col("number")).alias("p")).select(doc, "number", "p.*")


def first_labels(areas: DataFrame, codes=(10, 11, 43, 45, 51, 54, 57, 71, 72, 73, 75, 76), keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, code, area_id): the area that carries each code of a title page.

    Areas whose blank-free text holds the bracketed code come first, shortest text first; where there are none,
    those that begin with it.
    """
    plain = F.translate("content", " ", "")
    bracketed = lambda c: F.contains(plain, F.concat(F.lit("("), c, F.lit(")"))) | F.contains(plain, F.concat(F.lit("["), c, F.lit("]")))
    hit = areas.select(*keys, "area_id", "content", F.explode(inid_hits(F.col("content"), codes)).alias("code"))
    ranked = F.struct(F.when(bracketed(F.col("code")), 0).otherwise(1).alias("k"), F.length("content").alias("n"), "area_id")
    return hit.groupBy(*keys, "code").agg(F.min(ranked).alias("m")).select(*keys, "code", F.col("m.area_id").alias("area_id"))


def page_middle(pages: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The most frequent page middle (width times division, two digits) of each document, the smaller among equals."""
    m = pages.select(*keys, F.round(F.col("img_width") * F.coalesce("division", F.lit(0.0)), 2).alias("middle"))
    n = m.groupBy(*keys, "middle").agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("middle")).alias("k"))).alias("m")).select(*keys, (-F.col("m.k")).alias("middle"))


def right_blocks(labels: DataFrame, areas: DataFrame, middles: DataFrame) -> DataFrame:
    """Text right of each label: areas on its side of the page's middle whose heights meet its own, top to bottom.

    Paragraphs are taken if there are any, else lines. A middle of 0 means no sides. ``labels`` and ``areas`` have
    page_id, area_id, a box and (areas) category and content; ``middles`` has page_id and middle.
    """
    a, b = Box.of("a"), Box.of("b")
    side = F.coalesce(F.col("middle"), F.lit(0.0))
    same = (side == 0) | ((a.middle[0] < side) == (b.middle[0] < side))
    met = labels.join(middles.hint("merge"), "page_id", "left").alias("a").join(areas.where(F.col("category").isin("Paragraph", "Line")).alias("b").hint("merge"), (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.area_id") != F.col("b.area_id")) & a.meets_y(b) & same)
    rows = met.select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("label"), F.when(F.col("b.category") == "Paragraph", 0).otherwise(1).alias("kind"), F.struct("b.y1", "b.x1", "b.area_id", "b.content").alias("x"))
    lists = rows.groupBy("page_id", "label", "kind").agg(F.sort_array(F.collect_list("x")).alias("l"))
    best = lists.groupBy("page_id", "label").agg(F.min(F.struct("kind", "l")).alias("m"))
    return best.select("page_id", "label", F.when(F.col("m.kind") == 0, "Paragraph").otherwise("Line").alias("category"), F.array_join(F.transform("m.l", lambda x: x["content"]), " ").alias("content"))


def any_date(s: Column) -> Column:
    """Day of a publication date in one of the usual notations; null where none is found."""
    pick = lambda pattern, form: F.date_format(F.try_to_timestamp(F.nullif(F.regexp_extract(s, pattern, 0), F.lit("")), F.lit(form)), "yyyy-MM-dd")
    return F.coalesce(pick(r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), pick(r"\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy"), pick(r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"), month_date(s))


def bibliography(rows: DataFrame) -> DataFrame:
    """One record per patent number from bibliographic rows (patent_no, pos, inid, criterion, content).

    Later rows win; a title loses its language tag; dates that cannot be read are skipped. Records without a title
    or a publication date are left out, as the next candidate number would be tried.
    """
    last = lambda test, v: F.max(F.when(test & v.isNotNull(), F.struct("pos", v.alias("v"))))["v"]
    has = lambda code: F.contains("inid", F.lit(code))
    published = has("43") | has("45") | F.contains("criterion", F.lit("Veröffentlichungsdatum"))
    codes = F.flatten(F.collect_list(F.when(has("51"), ipc_codes(F.col("content")))))
    out = rows.groupBy("patent_no").agg(
        last(has("54"), F.regexp_replace("content", r"^(?:\[[A-Z]{2}\])\s", "")).alias("title"), last(has("72"), F.col("content")).alias("inventors"),
        last(has("71"), F.col("content")).alias("applicant"), last(has("73"), F.col("content")).alias("assignee"),
        last(published, any_date(F.col("content"))).alias("publication_date"), F.array_sort(F.array_distinct(codes)).alias("ipc"), last(has("57"), F.col("content")).alias("abstract"),
    )
    return out.where("title IS NOT NULL AND title <> 'nan' AND publication_date IS NOT NULL")


def metadata(numbers: DataFrame, records: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Each document's record: of its candidate numbers (prefix, digits and each suffix in order) the first that has one."""
    tried = numbers.select(doc, F.posexplode(F.transform("suffixes", lambda s: F.concat("prefix", "digits", s))).alias("k", "patent_no"))
    met = tried.join(records, "patent_no")
    first = met.withColumn("j", F.row_number().over(Window.partitionBy(doc).orderBy("k"))).where("j = 1")
    return first.drop("j", "k")


#: The codes that a field is taken from, the first that is there.
FIELDS = {"title": (54,), "inventors": (72, 75, 76), "applicant": (71, 75, 76), "assignee": (73, 76), "published": (45, 43), "classes": (51,), "abstract": (57,)}


def from_title_page(areas: DataFrame, pages: DataFrame) -> DataFrame:
    """Records (doc_id, title, inventors, applicant, assignee, publication_date, ipc, abstract) read off title pages.

    ``areas``: doc_id, page_id, area_id, category, content, box; ``pages``: doc_id, page_id, img_width, division. Each code's area is the one that carries it
    (``first_labels``); its text is what stands right of it on its side of the page (``right_blocks``), or what follows the code in the area itself. Documents without any are left out.
    """
    # areas may be many more bytes than the files they are made from, by whose size Spark would choose to send them to all tasks
    labels = first_labels(areas).join(areas.select("doc_id", "area_id", "page_id", "content", "x1", "y1", "x2", "y2").hint("merge"), ["doc_id", "area_id"])
    middles = pages.select("doc_id", "page_id").join(page_middle(pages).hint("merge"), "doc_id").select("page_id", "middle")
    text = areas.where(F.col("content").isNotNull())
    # a label is no text of another label
    others = text.join(labels.select("page_id", "area_id").distinct().hint("merge"), ["page_id", "area_id"], "left_anti")
    right = right_blocks(labels.select("page_id", "area_id", "x1", "y1", "x2", "y2").distinct(), others, middles).select("page_id", F.col("label").alias("area_id"), F.col("content").alias("beside"))
    own = F.nullif(F.trim(F.regexp_replace("content", r"^\s*[\[(]?\s*\d\d\s*[\])]?", "")), F.lit(""))
    told = labels.withColumn("own", own).join(right.hint("merge"), ["page_id", "area_id"], "left").withColumn("text", F.coalesce("own", "beside")).where("text IS NOT NULL")
    first = lambda codes: F.min(F.when(F.col("code").cast("int").isin(*codes), F.struct(F.array_position(F.array(*map(F.lit, codes)), F.col("code").cast("int")).alias("k"), "text")))["text"]
    out = told.groupBy("doc_id").agg(*[first(codes).alias(name) for name, codes in FIELDS.items()])
    return out.select("doc_id", F.regexp_replace("title", r"^(?:\[[A-Z]{2}\])\s", "").alias("title"), "inventors", "applicant", "assignee", any_date(F.col("published")).alias("publication_date"), F.array_sort(F.array_distinct(ipc_codes(F.col("classes")))).alias("ipc"), "abstract")


def documents_metadata(numbers: DataFrame, records: DataFrame, areas: DataFrame, pages: DataFrame) -> DataFrame:
    """Each document's bibliographic record, or where there is none what its title page says; ``patent_no`` is null then."""
    known = metadata(numbers, records)
    read = from_title_page(areas, pages).join(known.select("doc_id"), "doc_id", "left_anti")
    return known.select("doc_id", "patent_no", "title", "inventors", "applicant", "assignee", "publication_date", "ipc", "abstract").unionByName(read.withColumn("patent_no", F.lit(None).cast("string")))
