"""Closed itemsets of baskets by counting inference over key sets.

A set is a key if each of its subsets is in more baskets than it is itself. Level by level, candidates are joined from
the frequent sets of the level before that share all but their last item, and dropped unless all their subsets are frequent.
Only candidates whose subsets are all keys are counted; any other has the least support of its subsets. A set is
closed if no set of the next level has its support.

Items stand in sets by rising support (then id), so a set begins with its rarest item and the hot ones come last:
the sets that share a beginning are as few as the rarest item's baskets allow.

Counting. A basket's pairs are emitted only where it has ``long_basket`` frequent items at most. Longer ones are asked for
candidates instead: pairs seen in the other baskets which the long ones could lift over the threshold, found by
two joins; and pairs of items which are frequent among the long baskets alone. From three items on, a
candidate is in a basket if its two generating sets are, so only baskets of frequent keys are joined.

All of it are joins and partial aggregates: no table is collected or sent to all tasks. The driver sees counts, and the
items that are in every basket (no more of them than the mean basket has items).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Frequent items of a basket up to which all its pairs are emitted.
LONG_BASKET = 64


@dataclass
class Itemsets:
    """``closed`` and ``frequent``: items (array, rarest first), support; ``everywhere``: items of all ``baskets``, which belong to
    every closed set and stand in none of these rows."""

    closed: DataFrame
    frequent: DataFrame
    baskets: int
    everywhere: list[int]


def _pairs(lists: DataFrame, most: int) -> DataFrame:
    """(basket, a, b) of short baskets, a rarer than b."""
    first = lists.select("basket", F.posexplode("list").alias("p", "a"), "list")
    return first.select("basket", "a", F.explode(F.slice("list", F.col("p") + 2, F.lit(most))).alias("b"))


def _without(items: Column, size: int) -> Column:
    """The subsets of a set of ``size`` items that lack one."""
    return F.array(*[F.concat(F.slice(items, 1, j), F.slice(items, j + 2, size)) for j in range(size)])


def _long_pairs(pairs: DataFrame, long: DataFrame) -> DataFrame:
    """(basket, a, b) of the given pairs in long baskets."""
    one = long.select("basket", F.col("it").alias("a"))
    two = long.select("basket", F.col("it").alias("b"))
    return pairs.select("a", "b").join(one.hint("merge"), "a").join(two.hint("merge"), ["basket", "b"]).select("basket", "a", "b")


def _counted_pairs(lists: DataFrame, long: DataFrame | None, least: int, most: int) -> DataFrame:
    """(a, b, support) of the pairs in at least so many baskets."""
    seen = _pairs(lists, most).groupBy("a", "b").agg(F.count("*").alias("n"))
    if long is None:
        return seen.select("a", "b", F.col("n").alias("support")).where(F.col("support") >= least)
    seen = materialize(seen, "seen")
    among = materialize(long.groupBy("it").agg(F.count("*").alias("h")), "among")
    of = lambda c: among.select(F.col("it").alias(c), F.col("h").alias(f"h_{c}")).hint("merge")
    could = seen.join(of("a"), "a", "left").join(of("b"), "b", "left").withColumn("h", F.coalesce(F.least("h_a", "h_b"), F.lit(0)))
    could = materialize(could.withColumn("h", F.when(F.col("h_a").isNull() | F.col("h_b").isNull(), 0).otherwise(F.col("h"))).where(F.col("n") + F.col("h") >= least).select("a", "b", "n", "h"), "could")
    lifted = _long_pairs(could.where("h > 0"), long)
    # pairs of items that are frequent among the long baskets by themselves, in blocks of a basket
    rich = long.join(among.where(F.col("h") >= least).hint("merge"), "it").select("basket", "it")
    blocks = rich.withColumn("block", F.pmod(F.xxhash64("it"), F.lit(1 << 20))).groupBy("basket", F.expr("block div 16384").alias("block")).agg(F.collect_list("it").alias("list"))
    left, right = blocks.select("basket", F.col("block").alias("x"), F.col("list").alias("xs")), blocks.select("basket", F.col("block").alias("y"), F.col("list").alias("ys"))
    met = left.join(right, "basket").where("x <= y").select("basket", F.explode("xs").alias("p"), "ys").select("basket", "p", F.explode("ys").alias("q"))
    met = met.select("basket", F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).where("a < b").distinct()
    alone = met.join(could.where("h > 0").select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    more = lifted.unionByName(alone).groupBy("a", "b").agg(F.count("*").alias("m"))
    both = could.select("a", "b", "n").join(more.hint("merge"), ["a", "b"], "full")
    return both.select("a", "b", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("support")).where(F.col("support") >= least)


def closed_itemsets(rows: DataFrame, least: int = 12, share: int = 10_000, long_basket: int = LONG_BASKET) -> Itemsets:
    """Closed sets in at least ``least`` baskets and at least every ``share``-th one.

    ``rows``: basket, item (long); repeated rows count once, rows with a null in either are left out, other columns are
    ignored. No rows give no sets. The work grows with the number of frequent sets, which is that of all subsets of the largest ones.
    """
    base = materialize(rows.select(F.col("basket").cast("long"), F.col("item").cast("long")).where("basket IS NOT NULL AND item IS NOT NULL").distinct(), "baskets")
    baskets = base.select("basket").distinct().count()
    least = max(least, -(-baskets // share), 1)
    items = materialize(base.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= least), "items")
    everywhere = sorted(r.item for r in items.where(F.col("n") == baskets).collect())
    items = items.where(F.col("n") < baskets)

    hits = materialize(base.join(items.hint("merge"), "item").select("basket", F.struct("n", "item").alias("it")), "hits")
    sizes = materialize(hits.groupBy("basket").agg(F.count("*").alias("k")).where("k > 1"), "sizes")
    short = hits.join(sizes.where(F.col("k") <= long_basket).hint("merge"), "basket")
    lists = materialize(short.groupBy("basket").agg(F.sort_array(F.collect_list("it")).alias("list")), "lists")
    long = None
    if sizes.where(F.col("k") > long_basket).limit(1).count():
        long = materialize(hits.join(sizes.where(F.col("k") > long_basket).hint("merge"), "basket").select("basket", "it"), "long")

    single = items.select(F.array("item").alias("items"), F.array().cast("array<long>").alias("pre"), F.struct("n", "item").alias("last"), F.col("n").alias("support"), F.lit(True).alias("key"))
    pairs = materialize(_counted_pairs(lists, long, least, long_basket), "pairs")
    level = pairs.select(F.array("a.item", "b.item").alias("items"), F.array("a.item").alias("pre"), F.col("b").alias("last"), "support", (F.col("support") < F.col("a.n")).alias("key"))
    levels, held, size = [single, level], None, 2
    while True:
        after, met = _next_level(level, held if held is not None else _pair_baskets(level, pairs, lists, long, long_basket), size, least)
        if after is None:
            break
        levels.append(after)
        level, size = after, size + 1
        held = met.join(after.where("key").select("items").hint("merge"), "items", "left_semi")
    frequent = closed = None
    for k, now in enumerate(levels, 1):
        own = now.select("items", "support")
        if k < len(levels):
            bigger = levels[k].select("support", F.explode(_without(F.col("items"), k + 1)).alias("items")).distinct()
            own_closed = own.join(bigger.hint("merge"), ["items", "support"], "left_anti")
        else:
            own_closed = own
        frequent = own if frequent is None else frequent.unionByName(own)
        closed = own_closed if closed is None else closed.unionByName(own_closed)
    return Itemsets(materialize(closed, "closed"), materialize(frequent, "frequent"), baskets, everywhere if baskets >= least else [])


def _pair_baskets(level: DataFrame, pairs: DataFrame, lists: DataFrame, long: DataFrame | None, most: int) -> DataFrame:
    """(basket, items) of the pairs that are keys."""
    keys = pairs.where(F.col("support") < F.col("a.n")).select("a", "b")
    there = _pairs(lists, most).join(keys.hint("merge"), ["a", "b"], "left_semi")
    if long is not None:
        there = there.unionByName(_long_pairs(keys, long))
    return there.select("basket", F.array("a.item", "b.item").alias("items"))


def _next_level(level: DataFrame, held: DataFrame, size: int, least: int) -> tuple[DataFrame | None, DataFrame | None]:
    """The frequent sets of ``size`` + 1 items, and (basket, items) of those that were counted; None where there is no candidate."""
    left, right = level.select("pre", F.col("items").alias("p"), F.col("last").alias("l")), level.select("pre", F.col("items").alias("q"), F.col("last").alias("last"))
    joined = left.join(right.hint("merge"), "pre").where("l < last").select(F.concat("p", F.array("last.item")).alias("items"), "p", "q", "last")
    parts = joined.withColumn("part", F.explode(_without(F.col("items"), size + 1)))
    known = level.select(F.col("items").alias("part"), "support", "key")
    met = parts.join(known.hint("merge"), "part").groupBy("items", "p", "q", "last").agg(F.count("*").alias("parts"), F.min("support").alias("most"), F.bool_and("key").alias("keys"))
    candidates = materialize(met.where(F.col("parts") == size + 1).drop("parts"), "candidates")
    if not candidates.limit(1).count():
        return None, None
    asked = candidates.where("keys").select("items", "p", "q")
    held = materialize(held, "held")
    one, two = held.select("basket", F.col("items").alias("p")), held.select("basket", F.col("items").alias("q"))
    there = materialize(asked.join(one.hint("merge"), "p").join(two.hint("merge"), ["basket", "q"]).select("basket", "items"), "there")
    counted = there.groupBy("items").agg(F.count("*").alias("support")).where(F.col("support") >= least)
    shape = ("items", F.col("p").alias("pre"), "last", "support")
    found = candidates.where("keys").join(counted.hint("merge"), "items").select(*shape, (F.col("support") < F.col("most")).alias("key"))
    inferred = candidates.where("NOT keys").withColumn("support", F.col("most")).select(*shape, F.lit(False).alias("key"))
    after = materialize(found.unionByName(inferred), "level")
    return (after, there) if after.limit(1).count() else (None, None)


def rules(sets: Itemsets, confidence: tuple[int, int] = (30, 100)) -> DataFrame:
    """Rules of closed sets: items (as in ``closed``), c (the item taken), a (support of the rest), s (support of c), support.

    A rule has at least this share of the rest's baskets and lifts c over its share of all baskets. An item of all baskets
    gives none, so leaving those out changes no rule.
    """
    taken = sets.closed.where(F.size("items") > 1).select("items", "support", F.explode("items").alias("c"))
    rest = sets.frequent.select(F.col("items").alias("rest"), F.col("support").alias("a"))
    one = sets.frequent.where(F.size("items") == 1).select(F.col("items")[0].alias("c"), F.col("support").alias("s"))
    met = taken.withColumn("rest", F.array_remove("items", F.col("c"))).join(rest.hint("merge"), "rest").join(one.hint("merge"), "c")
    enough, of = confidence
    return met.where((F.lit(of) * F.col("support") >= F.lit(enough) * F.col("a")) & (F.col("support") * F.lit(sets.baskets) > F.col("a") * F.col("s"))).select("items", "c", "a", "s", "support")


def op11_key_set_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed itemsets and their rules over the baskets of all ``sale_lines`` that were not returned."""
    lines = table(spark, sf_dir, "sale_lines").where(~F.col("flag").eqNullSafe("returned"))
    sets = closed_itemsets(lines.select(F.col("sale_id").alias("basket"), F.col("item_id").alias("item")))
    told = rules(sets).groupBy("items").agg(F.count("*").alias("n_rules"), F.min(F.struct("a", "c"))["c"].alias("best_item"), F.array_sort(F.collect_list(F.struct("c", "a", "s"))).alias("told"))
    everywhere = F.array(*map(F.lit, sets.everywhere)).cast("array<long>")
    rows = sets.closed.join(told.hint("merge"), "items", "left").withColumn("all", F.array_sort(F.concat("items", everywhere)))
    out = rows.select("all", "support", F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"), "best_item", "told")
    if sets.everywhere:
        out = out.unionByName(spark.range(1).select(everywhere.alias("all"), F.lit(sets.baskets).cast("long").alias("support"), F.lit(0).cast("long").alias("n_rules"), F.lit(None).cast("long").alias("best_item"), F.lit(None).cast(out.schema["told"].dataType).alias("told")))
    line = F.array_join(F.transform("told", lambda r: F.concat_ws(":", r["c"].cast("string"), r["a"].cast("string"), r["s"].cast("string"))), ";")
    return out.select(F.array_join(F.col("all").cast("array<string>"), ",").alias("items"), F.size("all").cast("long").alias("n_items"), "support", "n_rules", "best_item", F.sha2(F.coalesce(line, F.lit("")), 256).alias("rules_sha256"))


_SQL = """
WITH RECURSIVE b AS (SELECT DISTINCT sale_id AS s, item_id AS i FROM sale_lines WHERE flag IS DISTINCT FROM 'returned' AND sale_id IS NOT NULL AND item_id IS NOT NULL),
n AS (SELECT count(DISTINCT s) AS baskets FROM b),
one AS (SELECT i, list(s) AS held, count(*) AS k FROM b GROUP BY i HAVING count(*) >= 12 AND count(*) * 10000 >= (SELECT baskets FROM n)),
f AS (
  SELECT [i] AS x, i AS last, held, k FROM one
  UNION ALL
  SELECT list_append(x, i), i, held, len(held) FROM (
    SELECT f.x, o.i, list_intersect(f.held, o.held) AS held FROM f JOIN one o ON o.i > f.last
  ) WHERE len(held) >= 12 AND len(held) * 10000 >= (SELECT baskets FROM n)
),
sets AS (SELECT x, k FROM f),
closed AS (SELECT x, k FROM sets s WHERE NOT EXISTS (SELECT 1 FROM sets t WHERE t.k = s.k AND len(t.x) = len(s.x) + 1 AND list_has_all(t.x, s.x))),
taken AS (SELECT x, k, unnest(x) AS c FROM closed WHERE len(x) > 1),
rule AS (
  SELECT t.x, t.c, r.k AS a, o.k AS s FROM taken t JOIN sets r ON r.x = list_filter(t.x, lambda e: e <> t.c) JOIN one o ON o.i = t.c
  WHERE 100 * t.k >= 30 * r.k AND t.k::HUGEINT * (SELECT baskets FROM n) > r.k::HUGEINT * o.k
),
told AS (SELECT x, count(*) AS n_rules, arg_min(c, (a, c)) AS best_item, string_agg(c || ':' || a || ':' || s, ';' ORDER BY c) AS line FROM rule GROUP BY x)
SELECT array_to_string(c.x, ',') AS items, len(c.x)::BIGINT AS n_items, c.k::BIGINT AS support, coalesce(t.n_rules, 0)::BIGINT AS n_rules, t.best_item, sha256(coalesce(t.line, '')) AS rules_sha256
FROM closed c LEFT JOIN told t ON t.x = c.x
"""

QUERIES = {"op11_key_set_itemsets": op11_key_set_itemsets}
ORACLE = {"op11_key_set_itemsets": _SQL}
