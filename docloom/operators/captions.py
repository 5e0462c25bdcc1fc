"""Captions of tables: the pattern of their first words, growth over neighbouring lines, numbers, and the area searched below."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..functions.text import roman

KEYWORDS, DELIMITERS, CONTINUED = ("Table", "TABLE", "Tab"), (":", "."), ("continued", "Continued")


def keyword_of(word: Column, keywords=KEYWORDS) -> Column:
    """Place of the first keyword that is a prefix of the word; null if none is."""
    return F.coalesce(*[F.when(F.startswith(word, F.lit(k)), F.lit(i)) for i, k in enumerate(keywords)], F.lit(None).cast("int"))


def caption_pattern(s: Column, keywords=KEYWORDS, delimiters=DELIMITERS, removal=CONTINUED) -> Column:
    """(delimiter, keyword place) of a text that begins like a caption; null for others.

    Of the first four words, empty ones and those of ``removal`` are left out. The first must begin with a keyword
    (an upper-case keyword alone is enough, with no delimiter), one of the last two with a capital. The delimiter
    is a line break where a later word ends in a digit, else the delimiter that ends a word.
    """
    words = F.filter(F.slice(F.split(s, " "), 1, 4), lambda w: (w != "") & ~w.isin(*removal))
    for r in removal:
        words = F.transform(words, lambda w, r=r: F.replace(w, F.lit(r), F.lit("")))
    first = F.get(words, F.lit(0))
    key = keyword_of(first, keywords)
    shout = F.when((F.upper(first) == first) & (F.lower(first) != first) & first.isin(*keywords), F.struct(F.lit("").alias("delimiter"), key.alias("keyword")))
    capital = F.exists(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), 2), lambda w: w.rlike(r"^\p{Lu}"))
    ends = F.transform(F.concat(F.slice(words, 2, 4), F.array(first)), lambda w: F.right(w, F.lit(1)))
    later = F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0)))
    stop = F.filter(later, lambda e: e.rlike(r"\d") | e.isin(*delimiters))
    end = F.coalesce(F.when(F.get(stop, F.lit(0)).rlike(r"\d"), "\n").otherwise(F.get(stop, F.lit(0))), F.when(F.element_at(ends, -1).isin(*delimiters), F.element_at(ends, -1)))
    usual = F.when(key.isNotNull() & capital & end.isNotNull(), F.struct(end.alias("delimiter"), key.alias("keyword")))
    return F.when(F.size(words) > 0, F.coalesce(shout, usual))


def captions(lines: DataFrame, keywords=KEYWORDS, delimiters=DELIMITERS, removal=CONTINUED, keep_most_common: bool = True, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Lines (keys, line_no, line) that begin like captions, with number and continued flag.

    With ``keep_most_common``, only those with the document's most frequent (delimiter, keyword) pair (the first
    among equals). The number is the first one in the text, arabic or roman, else the caption's place.
    """
    hit = lines.select(*keys, "line_no", "line", caption_pattern(F.col("line"), keywords, delimiters, removal).alias("p")).where("p IS NOT NULL").select(*keys, "line_no", "line", "p.*")
    if keep_most_common:
        n = hit.groupBy(*keys, "delimiter", "keyword").agg(F.count("*").alias("n"), F.min("line_no").alias("f"))
        best = n.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("f")).alias("f"), "delimiter", "keyword")).alias("m")).select(*keys, "m.delimiter", "m.keyword")
        hit = hit.join(best, [*keys, "delimiter", "keyword"], "left_semi")
    number = F.regexp_extract("line", r"\b(\d+|[IVX]+)\b", 1)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("line_no"))
    value = F.when(number == "", place.cast("long")).when(number.rlike(r"^\d"), number.try_cast("long")).otherwise(roman(number).cast("long"))
    continued = F.exists(F.array(*[F.lit(r.lower()) for r in removal]), lambda r: F.contains(F.lower("line"), r))
    return hit.select(*keys, "line_no", "line", "delimiter", "keyword", value.alias("number"), continued.alias("continued"))


def grown(captions: DataFrame, lines: DataFrame, drawn: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Captions grown by the lines right above or below: nearer than the threshold, meeting horizontally, and no horizontal
    drawn line in the hull of both. Returns page_id, area_id, the grown box and the lines taken."""
    a, b, d = Box.of("a"), Box.of("b"), Box.of("d")
    near = (F.abs(a.y1 - b.y2) < threshold) | (F.abs(b.y1 - a.y2) < threshold)
    met = captions.alias("a").join(lines.alias("b"), (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.area_id") != F.col("b.area_id")) & a.meets_x(b) & near)
    flat = drawn.where(F.col("x2") - F.col("x1") > F.col("y2") - F.col("y1"))
    met = met.join(flat.alias("d"), (F.col("a.page_id") == F.col("d.page_id")) & d.overlaps(a.union(b)), "left_anti")
    taken = met.select(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id"), F.struct(*[F.col(f"b.{c}").alias(c) for c in ("area_id", "x1", "y1", "x2", "y2")]).alias("l"))
    more = taken.groupBy("page_id", "area_id").agg(F.min("l.x1").alias("a1"), F.min("l.y1").alias("b1"), F.max("l.x2").alias("a2"), F.max("l.y2").alias("b2"), F.sort_array(F.collect_set("l.area_id")).alias("taken"))
    out = captions.join(more, ["page_id", "area_id"], "left")
    none = F.array().cast("array<long>")
    return out.select("page_id", "area_id", F.least("x1", F.coalesce("a1", "x1")).alias("x1"), F.least("y1", F.coalesce("b1", "y1")).alias("y1"), F.greatest("x2", F.coalesce("a2", "x2")).alias("x2"), F.greatest("y2", F.coalesce("b2", "y2")).alias("y2"), F.coalesce("taken", none).alias("taken"))


def limited(tokens: DataFrame, captions: DataFrame) -> DataFrame:
    """Tokens below each caption down to the next caption that meets it horizontally: (page_id, caption, area_id)."""
    a, b = Box.of("a"), Box.of("b")
    on = (F.col("a.page_id") == F.col("b.page_id")) & (b.y1 > a.y2) & a.meets_x(b)
    stop = captions.alias("a").join(captions.alias("b"), on, "left").groupBy(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("caption"), a.y2.alias("from_y")).agg(F.min(b.y1).alias("to_y"))
    met = tokens.join(stop, "page_id").where("y1 >= from_y AND (to_y IS NULL OR y2 <= to_y)")
    return met.select("page_id", "caption", "area_id")


def longest_lines(lines: DataFrame) -> DataFrame:
    """The longest horizontal line of each page, and its distance to the farthest line of about its width."""
    flat = lines.where(F.col("x2") - F.col("x1") > F.col("y2") - F.col("y1")).withColumn("width", F.col("x2") - F.col("x1"))
    top = flat.groupBy("page_id").agg(F.max(F.struct("width", (-F.col("area_id")).alias("k"), "x1", "y1", "x2", "y2")).alias("m")).select("page_id", (-F.col("m.k")).alias("area_id"), "m.width", "m.x1", "m.y1", "m.x2", "m.y2")
    a, b = Box.of("a"), Box.of("b")
    like = F.col("b.width").between(0.8 * F.col("a.width"), 1.2 * F.col("a.width")) & (F.col("a.area_id") != F.col("b.area_id"))
    far = top.alias("a").join(flat.alias("b"), (F.col("a.page_id") == F.col("b.page_id")) & like, "left")
    return far.groupBy(F.col("a.page_id").alias("page_id"), F.col("a.area_id").alias("area_id"), F.col("a.width").alias("width")).agg(F.max(a.diagonal_distance(b)).alias("gap"))
