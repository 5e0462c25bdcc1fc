"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

An item is a set of windows (ten consecutive words, or the whole of a shorter item), a window a set
of five-word shingles. A document contains a window only if it contains all its shingles, so one of
them, the rarest in the corpus, is a sufficient prefix for containment 1.

1. The benchmark's shingles are counted over all documents, by task first; that orders them by rarity.
2. Every window keeps its rarest shingle as prefix. A window with a shingle that no document has occurs
   nowhere and goes.
3. The documents' shingles are joined with the prefixes only. The prefix's place in the window gives the
   window's start in the document (positional bound: not before the text; length bound: not past its
   end), and the words around the shingle come along, so the window is compared word by word at once:
   no document's words are moved or looked up again.

Both passes first test a shingle's hash against a bit map of bounded size made of the hashes sought, inside the
document's row; only what it lets through becomes a row. Hashes and prefixes are broadcast while there are at
most ``BROADCAST_ROWS`` of them and joined by shuffle beyond that.

Generators are the outer ones: for the others the optimiser infers a filter on the array, pushes it
below and so computes the words again for every shingle. They also keep a row for documents without hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_ALNUM, ascii_lower, doc_text, materialize, release, remove, table, word_array

WINDOW, SHINGLE = 10, 5
BROADCAST_ROWS = 500_000
#: Bits of the map for each hash, and its longs at most (a power of two).
MAP_BITS, MAP_LONGS = 32, 1 << 16


def _words(text):
    return word_array(ascii_lower(text), NOT_ALNUM)


def _shingles(words, width: int):
    """(pos, h) of ``width`` words in a row, by place."""
    n = F.size(words) - width + 1
    at = lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(width), F.get(words, i), *[F.get(words, i + k) for k in range(1, width)]).alias("h"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<struct<pos:int,h:bigint>>"))


def _bit_map(hashes: DataFrame, n: int) -> tuple[Column, int]:
    """A bit map of the ``n`` hashes in column ``h`` as a literal, and its number of longs: ``MAP_LONGS`` rows at most come to the driver."""
    size = min(MAP_LONGS, 1 << max(4, (n * MAP_BITS // 64).bit_length()))
    rows = hashes.groupBy(F.expr(f"shiftright(h, 6) & {size - 1}L").alias("k")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63L AS INT)))").alias("v")).collect()
    longs = dict.fromkeys(range(size), 0) | {r.k: r.v for r in rows}
    # one string, which is folded into an array: a list would be an expression for each long
    return F.split(F.lit(",".join(map(str, longs.values()))), ",").cast("array<bigint>"), size


def _marked(bits: Column, size: int, h: Column) -> Column:
    shift = lambda x, n: F.call_function("shiftright", x, n)
    long = F.get(bits, shift(h, F.lit(6)).bitwiseAND(F.lit(size - 1)).cast("int"))
    return shift(long, h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _hits(base: DataFrame, sought: DataFrame, n: int, widths: list[int], keep: list[str], reach: int = 0, ahead: int = 0) -> DataFrame:
    """The ``keep`` columns with (c: pos, h, lo, near) of shingles that may be sought; near are the words from ``reach``
    before the shingle to ``ahead`` after its start, lo the first one's place. A document without any keeps a row with null c."""
    bits, size = _bit_map(sought, n)
    found = F.concat(*[F.filter(_shingles(F.col("ws"), w), lambda x: _marked(bits, size, x["h"])) for w in widths])
    lo = lambda x: F.greatest(x["pos"] - reach, F.lit(0))
    around = lambda x: F.slice("ws", lo(x) + 1, F.least(x["pos"] + ahead, F.size("ws")) - lo(x))
    if ahead:
        found = F.transform(found, lambda x: F.struct(x["pos"].alias("pos"), x["h"].alias("h"), lo(x).alias("lo"), around(x).alias("near")))
    return base.select(*keep, F.explode_outer(found).alias("c")).select(*keep, "c.*")


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, ws, size, w): distinct windows of each item with their shingle width."""
    items = benchmark.select("item_id", _words(F.coalesce("text", F.lit(""))).alias("ws")).where(F.size("ws") > 0)
    items = items.withColumn("size", F.least(F.size("ws"), F.lit(window))).withColumn("w", F.least("size", F.lit(shingle)))
    return items.select("item_id", "size", "w", F.explode(F.expr("transform(sequence(1, size(ws) - size + 1), i -> slice(ws, i, size))")).alias("ws")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted item ids as strings) of every row of documents.

    Null and empty texts have no words and no hits; items without words match nothing; repeated items
    count by their ids, an item without an id hits words but isn't listed. Rows are judged each, whatever
    their doc_id: null and repeated ones are allowed. Columns beyond the named ones are ignored.
    """
    spark = docs.sparkSession
    items = materialize(item_windows(benchmark, window, shingle), "items")
    windows = materialize(items.select("ws", "size", "w").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    widths = sorted(r.w for r in windows.select("w").distinct().collect())
    base = doc_text(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("ws"))
    base = base.select("doc_id", "row", "ws", F.size("ws").cast("long").alias("n_words"))
    if not widths:
        return base.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    shingles = None
    for w in widths:
        one = windows.where(F.col("w") == w).select("win", "size", "ws", F.explode_outer(_shingles(F.col("ws"), w)).alias("s")).select("win", "size", "ws", F.col("s.pos").alias("off"), "s.h")
        shingles = one if shingles is None else shingles.unionByName(one)
    shingles = materialize(shingles, "shingles")
    sized = lambda t, n: F.broadcast(t) if n <= BROADCAST_ROWS else t
    wanted = materialize(shingles.select("h").distinct(), "wanted")
    n_wanted = wanted.count()
    rarity = materialize(_hits(base, wanted, n_wanted, widths, []).join(sized(wanted, n_wanted), "h").groupBy("h").agg(F.count("*").alias("n")), "rarity")
    prefix = (
        shingles.join(rarity, "h", "left")
        .groupBy("win", "size", "ws")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "h")).alias("p"))
        .where("p.n > 0")
        .select("win", "size", F.col("ws").alias("words"), F.col("p.off").alias("off"), F.col("p.h").alias("h"))
    )
    prefix = materialize(prefix, "prefix")
    n_prefix = prefix.count()
    hits = _hits(base, prefix.select("h"), n_prefix, widths, ["doc_id", "row", "n_words"], window - 1, window)
    whole = F.expr("pos >= off AND pos - off + size <= n_words AND slice(near, pos - off - lo + 1, size) = words")
    met = hits.join(sized(prefix, n_prefix), "h", "left").select("doc_id", "row", "n_words", F.when(whole, F.struct((F.col("pos") - F.col("off")).alias("a"), "size")).alias("span"), F.when(whole, F.col("win")).alias("win"))
    rows = materialize(met.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_set("span").alias("spans"), F.collect_set("win").alias("wins")), "hits")
    release(spark)
    named = items.join(windows, ["ws", "size", "w"]).where("item_id IS NOT NULL").select("win", F.col("item_id").cast("string").alias("item_id")).distinct()
    found = rows.select("row", F.explode("wins").alias("win")).join(named, "win").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = F.expr("aggregate(array_sort(spans), struct(0 AS n, 0 AS p), (x, s) -> struct(x.n + greatest(s.a + s.size - greatest(x.p, s.a), 0) AS n, greatest(x.p, s.a + s.size) AS p), x -> x.n)")
    remove(spark, shingles._docloom_path, wanted._docloom_path, rarity._docloom_path, prefix._docloom_path)
    out = rows.join(found, "row", "left")
    return out.select("doc_id", "n_words", covered.cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` inside windows of ``benchmark`` items."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[k : k + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS k FROM i)),
dw AS (SELECT doc_id, k, n, array_to_string(ws[k : k + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM i))),
m AS (SELECT doc_id, k, n, item_id FROM dw JOIN iw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',')) AS s FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

QUERIES = {"op10_benchmark_decontamination": op10_benchmark_decontamination}
ORACLE = {"op10_benchmark_decontamination": _SQL}
