"""Rules on the characters, spans, images and drawings of a page, as a text extractor hands them over.

Spans have page_id, line_id, pos, content, size and a box; everything here is Column expressions and
windows inside a line, so no PDF library and no Python worker is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box

_LINE = ("page_id", "line_id")
#: Pixels that a page image may have on a side; points to an inch; share of the previous size up to which a span is raised or lowered.
MOST_PIXELS, POINTS, SMALL = 9000, 72, 0.75


def raster_dpi(width: Column, height: Column, dpi: int = 200) -> Column:
    """Resolution at which a page of so many points has at most ``MOST_PIXELS`` pixels on a side."""
    side = F.greatest(width, height) * dpi / POINTS
    return F.when(side > MOST_PIXELS, F.floor(dpi * MOST_PIXELS / side)).otherwise(dpi).cast("int")


def char_words(chars: DataFrame) -> DataFrame:
    """Words of characters (page_id, line_id, pos, content, box): runs between blanks, with their hull."""
    w = Window.partitionBy(*_LINE).orderBy("pos")
    blank = F.trim("content") == ""
    marked = chars.withColumn("word_no", F.sum(blank.cast("int")).over(w)).where(~blank)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]), "")
    words = marked.groupBy(*_LINE, "word_no").agg(text.alias("content"), F.min("pos").alias("pos"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    return words.drop("word_no")


def fold_spans(spans: DataFrame) -> DataFrame:
    """Words of a line's spans: raised or lowered ones and ends of split umlauts join the word before them.

    A span of at most ``SMALL`` times the size of the one before is added as ``_{..}`` where it lies lower
    than the word and as ``^{..}`` otherwise; a word after a loose diaeresis is glued to it. The word keeps
    its top and bottom and grows to the right only.
    """
    w = Window.partitionBy(*_LINE).orderBy("pos")
    small = F.coalesce(F.col("size") <= SMALL * F.lag("size").over(w), F.lit(False))
    glued = F.coalesce(F.lag("content").over(w).endswith("¨"), F.lit(False)) & ~F.col("small")
    marked = spans.withColumn("small", small).withColumn("glued", glued)
    marked = marked.withColumn("word_no", F.sum((~(F.col("small") | F.col("glued"))).cast("int")).over(w))
    each = F.sort_array(F.collect_list(F.struct("pos", "content", "small", "x1", "y1", "x2", "y2", "size")))
    words = marked.groupBy(*_LINE, "word_no").agg(each.alias("l")).withColumn("h", F.get("l", F.lit(0)))
    low = lambda x: (x["y2"] > F.col("h.y2")) | (x["y1"] > F.col("h.y1"))
    part = lambda x: F.when(x["small"], F.concat(F.when(low(x), "_{").otherwise("^{"), F.trim(x["content"]), F.lit("}"))).otherwise(F.trim(x["content"]))
    text = F.concat(F.trim(F.col("h.content")), F.array_join(F.transform(F.slice("l", 2, F.size("l")), part), ""))
    return words.select(*_LINE, F.col("h.pos").alias("pos"), text.alias("content"), F.col("h.size").alias("size"), F.col("h.x1").alias("x1"), F.col("h.y1").alias("y1"), F.array_max(F.transform("l", lambda x: x["x2"])).alias("x2"), F.col("h.y2").alias("y2"))


def ordered_text(spans: DataFrame, keys: tuple[str, ...] = ("cell_id",), superscripts: bool = True) -> DataFrame:
    """Text of the spans of each key by block, line and span: blanks between spans, hyphens at line ends join words.

    Without ``superscripts``, raised whole numbers (bit 0 of ``flags``) are left out.
    """
    if not superscripts:
        spans = spans.where(~((F.col("flags").bitwiseAND(F.lit(1)) == 1) & F.col("content").rlike(r"^\s*\d+\s*$")))
    line = spans.groupBy(*keys, "block", "line").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("span", "content"))), lambda x: x["content"]), " ").alias("t"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "t"))), lambda x: x["t"])
    step = lambda a, t: F.when(a == "", t).when(a.rlike(r"\w-$"), F.concat(F.regexp_replace(a, "-$", ""), t)).otherwise(F.concat(a, F.lit(" "), t))
    return line.groupBy(*keys).agg(lines.alias("ls")).select(*keys, F.aggregate("ls", F.lit(""), step).alias("content"))


def distinct_images(images: DataFrame) -> DataFrame:
    """One row for each embedded image of a page, by its cross-reference number."""
    return images.dropDuplicates(["page_id", "xref"])


def drawn_items(items: DataFrame) -> DataFrame:
    """Lines, rectangles and curves of drawings (page_id, stroke_id, seq, kind, points) with their boxes.

    Kinds: ``l`` two points, ``re`` two corners, ``c`` the four points of a curve, ``qu`` four corners, which give
    four lines. ``points`` is an array of (x, y) structs; kinds beyond these are left out.
    """
    p = lambda i: F.get("points", F.lit(i))
    edge = lambda i, j: F.struct(F.lit("line").alias("shape"), F.array(p(i), p(j)).alias("ps"))
    whole = lambda name: F.array(F.struct(F.lit(name).alias("shape"), F.col("points").alias("ps")))
    shapes = F.when(F.col("kind") == "l", whole("line")).when(F.col("kind") == "re", whole("rect")).when(F.col("kind") == "c", whole("bezier")).when(F.col("kind") == "qu", F.array(edge(0, 1), edge(1, 3), edge(3, 2), edge(2, 0)))
    flat = items.select("page_id", "stroke_id", "seq", F.posexplode(shapes).alias("part", "s"))
    ends = lambda c, f: f(F.transform("s.ps", lambda q: q[c]))
    return flat.select("page_id", "stroke_id", "seq", "part", F.col("s.shape").alias("shape"), ends("x", F.array_min).alias("x1"), ends("y", F.array_min).alias("y1"), ends("x", F.array_max).alias("x2"), ends("y", F.array_max).alias("y2"))


def strokes(shapes: DataFrame) -> DataFrame:
    """Hull and number of shapes of each stroke."""
    return shapes.groupBy("page_id", F.col("stroke_id").alias("area_id")).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count("*").alias("n"))


def figures(drawn: DataFrame, least_area: float = 10.0) -> DataFrame:
    """Figures: hulls of strokes that overlap, directly or through others, with their strokes; small ones are left out."""
    from ..operators.cluster import merge_boxes

    hulls = merge_boxes(drawn, 0.0, 0.0, rounds=1000)
    return hulls.where((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= least_area).select("page_id", F.col("group_id").alias("figure_id"), "x1", "y1", "x2", "y2", "members")


def baseline_box(origin_y: Column, size: Column, ascender: Column, descender: Column) -> tuple[Column, Column]:
    """Top and bottom of a span from its baseline and the font's measures."""
    bottom = origin_y - size * descender / (ascender - descender)
    return bottom - size, bottom


def font_styles(flags: Column) -> Column:
    """Names of a font's style bits."""
    names = ("superscript", "italic", "serif", "monospace", "bold")
    return F.filter(F.array(*[F.when(F.bit_get(flags, F.lit(i)) == 1, F.lit(n)) for i, n in enumerate(names)]), lambda x: x.isNotNull())


def has_style(style: Column, name: str) -> Column:
    """Whether a list of styles has the name: ``superscript`` and ``subscript`` among them."""
    return F.coalesce(F.array_contains(style, name), F.lit(False))


def squeezed(token: Column) -> Column:
    """The token without white space."""
    return F.regexp_replace(token, r"\s+", "")


def majority_font(chars: DataFrame, keys: tuple[str, ...] = ("page_id", "word_id")) -> DataFrame:
    """The most frequent font of each word's characters; the first by name among equals."""
    n = chars.groupBy(*keys, "font").agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("k"), "font")).alias("m")).select(*keys, F.col("m.font").alias("font"))


#: Names of tokens that stand for pictures and lines, and the font where none is known.
PICTURE, LINE, NO_FONT = "##LTFigure##", "##LTLine##", "default"


def layout_tokens(words: DataFrame, chars: DataFrame, pictures: DataFrame, lines: DataFrame, pages: DataFrame, share: float = 0.95) -> DataFrame:
    """Tokens of pages for layout models: page_id, place, token, x1, y1, x2, y2 (0 to 1000), font.

    Words (page_id, word_id, content, box) come first, in the order of their ids, then pictures, then lines (page_id, area_id, box). A word's font is
    the most common of the characters (page_id, char_id, font, box) with over ``share`` of their area inside it, the first met among equals.
    Boxes are whole thousandths of the page's width and height (whole points); those of pictures and lines of its width on both axes. Blanks in words go.
    """
    a, b = Box.of("a"), Box.of("b")
    w, h = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    on = (F.col("a.page_id") == F.col("b.page_id")) & (w >= 0) & (h >= 0) & (b.area > 0) & (w * h > share * b.area)
    inside = words.alias("a").join(chars.alias("b"), on).groupBy("a.page_id", "a.word_id", "b.font").agg(F.count("*").alias("n"), F.min("b.char_id").alias("first"))
    fonts = inside.groupBy("page_id", "word_id").agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "font"))["font"].alias("font"))
    part = lambda c, size: F.least(F.lit(1000), F.greatest(F.lit(0), (F.col(c) / size * 1000).cast("int")))
    width, height = F.col("xml_width").cast("int"), F.col("xml_height").cast("int")
    box = lambda across, down: [part("x1", across).alias("x1"), part("y1", down).alias("y1"), part("x2", across).alias("x2"), part("y2", down).alias("y2")]
    told = words.join(fonts, ["page_id", "word_id"], "left").join(pages, "page_id").select("page_id", F.lit(0).alias("kind"), F.col("word_id").alias("id"), squeezed(F.col("content")).alias("token"), *box(width, height), F.coalesce("font", F.lit(NO_FONT)).alias("font"))
    for kind, (name, rows) in enumerate(((PICTURE, pictures), (LINE, lines)), 1):
        told = told.unionByName(rows.join(pages, "page_id").select("page_id", F.lit(kind).alias("kind"), F.col("area_id").alias("id"), F.lit(name).alias("token"), *box(width, width), F.lit(NO_FONT).alias("font")))
    order = Window.partitionBy("page_id").orderBy("kind", "id")
    return told.withColumn("place", F.row_number().over(order).cast("long") - 1).select("page_id", "place", "token", "x1", "y1", "x2", "y2", "font")
