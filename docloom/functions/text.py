"""Text rules of table cells, title pages and captions as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = r"[\[{(]([^\]\[\}\{\)\(]+)[\]})]"


def fix_brackets(s: Column) -> Column:
    """A one-sided square bracket gets its partner where a look-alike stands."""
    right = F.regexp_replace(s, r"^([^\[]*\[[^\\|1I]*)[\\|1I]", "$1]")
    left = F.regexp_replace(s, r"^([^\]]*)[/|IΓ]([^\]/|IΓ]*\])", "$1[$2")
    has_l, has_r = F.contains(s, F.lit("[")), F.contains(s, F.lit("]"))
    return F.when(has_l & ~has_r, right).when(has_r & ~has_l, left).otherwise(s)


def unit_of(s: Column) -> Column:
    """The first bracketed unit without brackets and blanks; empty if none."""
    return F.translate(F.regexp_extract(s, _UNIT, 1), "()[]{} ", "")


def name_of(s: Column) -> Column:
    """The text without its first bracketed unit."""
    return F.trim(F.replace(s, F.when(F.regexp_extract(s, _UNIT, 0) == "", F.lit("\x00")).otherwise(F.regexp_extract(s, _UNIT, 0)), F.lit("")))


def guard_unit(unit: Column, name: Column) -> Column:
    """Composition units don't go with names of several words."""
    return F.when(unit.isin("wt%", "mol%", "mass%") & F.contains(name, F.lit(" ")) & ~F.contains(name, F.lit("+")), F.lit("-")).otherwise(unit)


def clean_value(s: Column) -> Column:
    """Blanks, doubled points, percent signs and empty superscripts go."""
    v = F.replace(F.replace(s, F.lit(". ."), F.lit(".")), F.lit(" "), F.lit(""))
    v = F.replace(v, F.lit(".."), F.lit("."))
    return F.replace(F.replace(v, F.lit("%"), F.lit("")), F.lit("^{}"), F.lit(""))


def value_unit(s: Column, unit: Column) -> Column:
    return F.when(F.contains(s, F.lit("%")) & (F.coalesce(unit, F.lit("")) == ""), F.lit("%")).otherwise(unit)


def example_id(s: Column) -> Column:
    """Number of an example column: ``Ex. 12`` gives ``Ex-12``-like keys without blanks."""
    number = F.regexp_replace(F.regexp_extract(s, r"(?: |^|.)\d+\ *(\.|\,)?\ *\d*", 0), r"^\.", "")
    kind = F.when(F.contains(s, F.lit("Ex")), "Ex-").when(F.contains(s, F.lit("No")), "No-").otherwise("")
    return F.when(number == "", F.lit(None)).otherwise(F.concat(kind, F.regexp_replace(F.replace(number, F.lit(" "), F.lit("")), "^-", "")))


def line_key(s: Column) -> Column:
    return F.translate(F.lower(s), " ()", "")


def clean_ocr(s: Column) -> Column:
    return F.lower(F.translate(F.trim(s), "-–—'\"`", ""))


def ligatures(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))


def roman(s: Column) -> Column:
    """Value of a roman numeral; null if a letter is none."""
    v = F.create_map(*[x for k, n in zip("IVXLCDM", (1, 5, 10, 50, 100, 500, 1000)) for x in (F.lit(k), F.lit(n))])
    values = F.transform(F.split(F.reverse(F.upper(s)), ""), lambda c: v[c])
    start = F.struct(F.lit(0).alias("t"), F.lit(0).alias("p"))
    step = lambda a, x: F.struct((a["t"] + F.when(x < a["p"], -x).otherwise(x)).alias("t"), x.alias("p"))
    return F.when(F.upper(s).rlike("^[IVXLCDM]+$"), F.aggregate(values, start, step, lambda a: a["t"]))


def numbering(s: Column, prefixes: str = r"No\.|Ex\.|Number|Example") -> Column:
    """Digits after a numbering prefix; null otherwise."""
    hit = F.regexp_extract(s, rf"^(?:{prefixes})\s?(\d*(?:\.\d)?)$", 1)
    return F.when(hit == "", F.lit(None)).otherwise(hit)


def is_number(s: Column) -> Column:
    return s.rlike(r"^[+-]?(\d|[.,]\d)")


def patent_number(s: Column) -> Column:
    """Country code and digits, else digits in groups of three."""
    own = F.regexp_extract(s, r"[A-Z]{2}\s*\d[\d,/ ]*(\s*[A-Z]\d)?", 0)
    group = F.regexp_extract(s, r"\d{1,3}(,\d{3})+", 0)
    return F.coalesce(F.nullif(F.trim(own), F.lit("")), F.nullif(group, F.lit("")))


def inid_hits(s: Column, codes=(10, 11, 43, 45, 51, 54, 57, 71, 72, 73, 75, 76)) -> Column:
    """Title-page codes in brackets or at the start of a blank-free text."""
    plain = F.replace(s, F.lit(" "), F.lit(""))
    return F.filter(F.array(*[F.lit(str(c)) for c in codes]), lambda c: F.contains(plain, F.concat(F.lit("("), c, F.lit(")"))) | F.contains(plain, F.concat(F.lit("["), c, F.lit("]"))) | F.startswith(plain, c))


def month_date(s: Column) -> Column:
    """First ``Mon d, yyyy`` date as yyyy-MM-dd; null if none."""
    hit = F.regexp_extract(s, r"(?i)(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.? (\d{1,2}), (\d{4})", 0)
    norm = F.regexp_replace(hit, r"^([A-Za-z]{3})[a-z]*\.? ", "$1 ")
    return F.date_format(F.try_to_timestamp(F.initcap(norm), F.lit("MMM d, yyyy")), "yyyy-MM-dd")


def ipc_codes(s: Column) -> Column:
    """Classification codes split at closing brackets, else at double blanks."""
    parts = F.when(F.contains(s, F.lit(")")), F.split(s, r"\)")).when(F.contains(s, F.lit("  ")), F.split(s, "  ")).otherwise(F.array(s))
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: (x != "") & (x != "nan")))


def caption_like(s: Column, keywords: list[str]) -> Column:
    """Starts with a keyword and has a number or delimiter within the first four words."""
    first = F.slice(F.split(s, " "), 1, 4)
    key = F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.startswith(s, k))
    return key & F.exists(first, lambda w: w.rlike(r"\d") | w.rlike(r"[:.]$"))


def file_parts(name: Column) -> tuple[Column, Column]:
    """Document id (all dots dropped) and lower-case suffix of an upload's name."""
    parts = F.split(F.element_at(F.split(name, "/"), -1), r"\.")
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), ""), F.lower(F.element_at(parts, -1))
