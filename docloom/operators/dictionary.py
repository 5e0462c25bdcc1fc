"""Dictionary joins: first matching regular expression, contained synonyms, close words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a word list beyond which it isn't broadcast.
BROADCAST_ROWS = 100_000


def first_match(s: Column, knowledge: dict[str, list[str]]) -> Column:
    """(canonical, pattern) of the first name, in the dictionary's order, one of whose patterns matches at the start; null if none.

    The patterns are constants of the plan, compiled once; nothing is joined.
    """
    none = F.lit(None).cast("struct<canonical:string,pattern:string>")
    return F.coalesce(*[F.when(s.rlike(f"^(?:{p})"), F.struct(F.lit(name).alias("canonical"), F.lit(p).alias("pattern"))) for name, ps in knowledge.items() for p in ps], none)


def match_names(texts: DataFrame, knowledge: dict[str, list[str]], text: str = "content") -> DataFrame:
    """Distinct texts with their first canonical name and its pattern."""
    words = texts.select(text).where(F.col(text).isNotNull()).distinct()
    return words.select(text, first_match(F.col(text), knowledge).alias("m")).select(text, "m.canonical", "m.pattern")


def line_units(lines: DataFrame, units: DataFrame, text: str = "content") -> DataFrame:
    """Lines with the first unit one of whose synonyms their blank-free lower-case text contains."""
    keyed = lines.withColumn("_key", F.translate(F.lower(text), " ()", ""))
    small = units.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = keyed.join(F.broadcast(units) if small else units, F.contains(F.col("_key"), F.col("synonym")))
    return met.groupBy(*lines.columns).agg(F.min(F.struct("ord", "unit")).alias("m")).select(*lines.columns, F.col("m.unit").alias("unit"))


def shortened(text: Column, letters: int) -> Column:
    """The text and all that is left of it when up to so many letters are taken out, each once."""
    drop = lambda t: F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))))
    out = last = F.array(text)
    for _ in range(letters):
        last = F.array_distinct(F.flatten(F.transform(last, drop)))
        out = F.concat(out, last)
    return F.array_distinct(out)


def close_pairs(tokens: DataFrame, words: DataFrame, distance: int = 1, shared: int = 0) -> DataFrame:
    """(token, word, d) of all distinct tokens and words at most ``distance`` edits apart that share their first ``shared`` letters.

    Strings so close become equal when up to ``distance`` letters are taken out of each: an equi join on the hash of what
    is left, tested by the edit distance afterwards, finds all pairs, wherever the edits are. Tokens longer than any word
    by more than that are not taken apart.
    """
    most = words.agg(F.max(F.length("word"))).first()[0] or 0
    key = lambda c: F.explode(F.transform(shortened(F.col(c), distance), lambda v: F.xxhash64(F.substring(F.col(c), 1, shared), v))).alias("k")
    a = tokens.select("token").where(F.length("token") <= most + distance).distinct().select("token", key("token"))
    b = words.select("word").where("word IS NOT NULL").distinct().select("word", key("word"))
    return a.join(b, "k").select("token", "word").distinct().withColumn("d", F.levenshtein("token", "word", distance)).where("d >= 0")


def is_number(text: Column) -> Column:
    """Whether a text begins as a number does."""
    return text.rlike(r"^[+-]?(\d|[.,]\d)")


def corrections(tokens: DataFrame, words: DataFrame, distance: int = 1, shared: int = 1) -> DataFrame:
    """Close words (``word`` and, if there, count ``n``) of tokens that are neither numbers nor prefixes of a known word.

    A word shares its first ``shared`` letters with the token (0: none need agree) and is at most ``distance`` edits away. Among equally close words the most frequent one is taken, then the first by name.
    """
    count = F.col("n") if "n" in words.columns else F.lit(1)
    known = words.where("word IS NOT NULL").groupBy("word").agg(F.sum(count).alias("n"))
    prefixes = known.select(F.explode(F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.substring("word", F.lit(1), i))).alias("token")).distinct()
    asked = tokens.select("token").where(F.col("token").isNotNull() & ~is_number(F.col("token"))).distinct().join(prefixes, "token", "left_anti")
    near = close_pairs(asked, known, distance, shared).join(known, "word")
    best = near.groupBy("token").agg(F.min(F.struct("d", (-F.col("n")).alias("k"), "word")).alias("m"))
    return best.select("token", F.col("m.word").alias("word"), F.col("m.d").cast("long").alias("distance"))


def with_prefix(words: DataFrame, prefix: str, most: int | None = None) -> DataFrame:
    """Known words (word, n) that begin with a prefix, by falling frequency, then name; the first ``most`` of that order if given."""
    out = words.where(F.startswith("word", F.lit(prefix))).orderBy(F.desc("n"), "word")
    return out if most is None else out.limit(most)


def close_words(tokens: DataFrame, words: DataFrame, distance: int = 1, shared: int = 0) -> DataFrame:
    """Each token's closest dictionary word at most ``distance`` edits away; ties to the first word."""
    best = close_pairs(tokens, words, distance, shared).groupBy("token").agg(F.min(F.struct("d", "word")).alias("m"))
    return best.select("token", F.col("m.word").alias("word"), F.col("m.d").cast("long").alias("distance"))
