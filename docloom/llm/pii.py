"""Personal data: four base rules and bootstrapped contextual extraction, with DataFrame functions only.

Base spans are the seeds. Seeds, other tokens with a digit or an at sign, and runs of digit groups parted
by single blanks are mentions, each with two lexical patterns: the two words before it, and the word on either side. Over the graph of
patterns and instances, scores go back and forth: a pattern's confidence for a kind is the share of its
mentions whose instances are of that kind, an instance's score is the noisy-or of its patterns'
confidences. Patterns need ``SUPPORT`` distinct known instances and ``PATTERN`` confidence; mentions of
them whose instance reaches ``INSTANCE`` become spans of that kind.

Places come from cutting a text at the matches: the lengths of pieces and matches add up to them. The
expressions match the same strings as the plain rules in linear time and without deep recursion:
repeated groups are written as one character with a look-ahead, and a match may only begin where a run
of its characters begins or the last match ended. Patterns and instances are counted before any
shuffle, so a phrase found in a third of all documents is one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, doc_text, materialize, remove, table

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++\.[{_LABEL}](?:(?=[{_LABEL}]|\.[{_LABEL}])[{_LABEL}.])*",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?=[0-9]|[ -][0-9])[0-9 -])*",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
TOKEN = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
GROUPS = rf"(?<![^{SPACE}])[0-9(][0-9().-]*+(?: [0-9(][0-9().-]*+)++"
ROUNDS, SUPPORT, PATTERN, INSTANCE = 3, 5, 0.8, 0.9
#: Least number of digits that an instance needs to be taken for a kind (an email needs an at sign instead).
DIGITS = {"ip": 4, "card": 6, "phone": 6}
#: Characters beside a mention that are looked at first for its context words; where they don't hold those whole, more and then all are.
_NEAR = (80, 4000)


#: Matches whose places are added up at once, and characters of a block of text.
_MATCHES, _BLOCK = 128, 1024
_SPANS = "array<struct<m:string,s:int,e:int>>"


def _matches(df: DataFrame, rules: dict) -> DataFrame:
    """The table with an array of (m, s, e) for each name: matches of a rule with code point places, where its guard holds.

    Places are sums of lengths, first inside groups of ``_MATCHES`` and then over groups: near linear in the number of matches.
    """
    names, none = list(rules), F.array().cast("array<struct<a:int,m:string>>")

    def cut(rule, guard):
        pieces, hits = F.split("text", rule, -1), F.regexp_extract_all("text", F.lit(rule), F.lit(0))
        both = F.filter(F.arrays_zip(pieces.alias("piece"), hits.alias("m")), lambda x: x["m"].isNotNull())
        return F.when(guard, F.transform(both, lambda x: F.struct(F.length(x["piece"]).alias("a"), x["m"].alias("m")))).otherwise(none)

    df = df.withColumns({f"_z_{n}": cut(*rules[n]) for n in names})

    def placed(z):
        step = lambda t, x: F.struct((t["p"] + x["a"] + F.length(x["m"])).alias("p"), F.concat(t["out"], F.array(F.struct(x["m"].alias("m"), (t["p"] + x["a"]).alias("s"), (t["p"] + x["a"] + F.length(x["m"])).alias("e")))).alias("out"))
        last = F.greatest(F.floor((F.size(z) - 1) / _MATCHES), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(F.slice(z, i * _MATCHES + 1, F.lit(_MATCHES)), F.struct(F.lit(0).alias("p"), F.array().cast(_SPANS).alias("out")), step))

    df = df.withColumns({f"_g_{n}": placed(F.col(f"_z_{n}")) for n in names})

    def moved(g):
        before = F.aggregate(g, F.struct(F.lit(0).alias("p"), F.array().cast("array<int>").alias("out")), lambda t, x: F.struct((t["p"] + x["p"]).alias("p"), F.concat(t["out"], F.array(t["p"])).alias("out")), lambda t: t["out"])
        return F.flatten(F.transform(F.arrays_zip(g.alias("g"), before.alias("o")), lambda x: F.transform(x["g"]["out"], lambda y: F.struct(y["m"].alias("m"), (y["s"] + x["o"]).alias("s"), (y["e"] + x["o"]).alias("e")))))

    return df.withColumns({n: moved(F.col(f"_g_{n}")) for n in names}).drop(*[f"_{k}_{n}" for k in "zg" for n in names])


def _blocks(text):
    """The text in blocks of ``_BLOCK`` characters, cut from larger ones: no place is looked for from the text's beginning."""
    wide = 64 * _BLOCK
    cut = lambda t, size: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length(t) - 1, F.lit(0)) / size).cast("int")), lambda i: F.substring(t, i * size + 1, F.lit(size)))
    return F.flatten(F.transform(cut(text, wide), lambda t: cut(t, _BLOCK)))


def _between(blocks, a, b):
    """The characters at places a to b of a text in blocks."""
    first, last = F.floor(a / _BLOCK).cast("int"), F.floor(F.greatest(b - 1, a) / _BLOCK).cast("int")
    some = F.when(last == first, F.get(blocks, first)).when(last == first + 1, F.concat(F.get(blocks, first), F.get(blocks, last))).otherwise(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""))
    return F.when(b > a, F.substring(some, a - first * _BLOCK + 1, b - a)).otherwise("")


def _digits(m):
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d):
    back = F.reverse(d)
    digit = lambda i: F.substring(back, i + 1, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 0, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str):
    if kind == "ip":
        return lambda x: F.forall(F.split(x["m"], r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return lambda x: F.when(F.length(_digits(x["m"])).between(16, 19), _luhn(_digits(x["m"]))).otherwise(False)
    if kind == "phone":
        return lambda x: F.length(_digits(x["m"])).between(8, 15)
    return lambda x: F.lit(True)


def base_spans(text: DataFrame) -> DataFrame:
    """doc_id, row (unique), text, base (array of rank, kind, s, e, m by kind, then place) of whole texts."""
    has = {"email": F.contains("text", F.lit("@")), "ip": F.col("text").rlike(r"[0-9]\.[0-9]"), "card": F.col("text").rlike(r"[0-9](?:[ -]?[0-9]){15}"), "phone": F.col("text").rlike(r"\+[0-9]")}
    out = _matches(text.select("doc_id", F.monotonically_increasing_id().alias("row"), "text"), {f"r_{k}": (RULES[k], has[k]) for k in KINDS})
    tag = lambda k, n: F.transform(F.filter(f"r_{k}", _valid(k)), lambda x: F.struct(F.lit(n).alias("rank"), F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))
    return out.select("doc_id", "row", "text", F.concat(*[tag(k, n) for n, k in enumerate(KINDS)]).alias("base"))


_TWO = rf"([^{SPACE}]+[{SPACE}]+[^{SPACE}]+)[{SPACE}]*[\"'(\[<]*$"
_ONE = rf"^[^A-Za-z0-9{SPACE}]*[{SPACE}]+([^{SPACE}]+)"


def _words_before(s, n):
    """The two words before place ``s`` if they stand whole within ``n`` characters, else empty."""
    near = _between(F.col("blocks"), F.greatest(s - n, F.lit(0)), s)
    return F.when(s <= n, F.regexp_extract(near, rf"(?:^|[{SPACE}]){_TWO}", 1)).otherwise(F.regexp_extract(near, rf"[{SPACE}]{_TWO}", 1))


def _word_after(e, n):
    """The word after place ``e`` if it stands whole within ``n`` characters, else empty."""
    near = _between(F.col("blocks"), e, F.least(e + n, F.col("n")))
    return F.when(F.col("n") - e <= n, F.regexp_extract(near, _ONE, 1)).otherwise(F.regexp_extract(near, rf"{_ONE}[{SPACE}]", 1))


def _merged(items, marks):
    """Items and marks (places) in one order, an item before a mark at its own place."""
    return F.sort_array(F.concat(F.transform(items, lambda x: F.struct(x["s"].alias("p"), F.lit(0).alias("mark"), x["e"].alias("e"))), F.transform(marks, lambda p: F.struct(p.alias("p"), F.lit(1).alias("mark"), p.alias("e")))))


def _marked(merged):
    """For each item, in order, whether a mark lies in it. Items are apart, so that is so if what comes next is a mark before its end."""
    told = F.transform(merged, lambda x, i: F.struct(x["mark"].alias("mark"), F.coalesce((F.get(merged, i + 1)["mark"] == 1) & (F.get(merged, i + 1)["p"] < x["e"]), F.lit(False)).alias("hit")))
    return F.transform(F.filter(told, lambda x: x["mark"] == 0), lambda x: x["hit"])


def _parts(x):
    """Places where the blank-separated parts of a match begin."""
    at = F.filter(F.sequence(F.lit(0), F.length(x["m"]) - 1), lambda i: (F.substring(x["m"], i + 1, F.lit(1)) != " ") & ((i == 0) | (F.substring(x["m"], i, F.lit(1)) == " ")))
    return F.transform(at, lambda i: i + x["s"])


def _mentions(found: DataFrame) -> DataFrame:
    """doc_id, row, base without texts, and mentions (kind or null, s, e, inst, at, digits, pats)."""
    found = _matches(found.select("doc_id", "row", "text", "base"), {"tokens": (TOKEN, F.col("text").rlike("[0-9@]")), "groups": (GROUPS, F.col("text").rlike("[0-9).-] [0-9(]"))})
    # what could never be taken for any kind is no mention; a group of few digits inside a run is none by itself
    digits = lambda x: F.length(_digits(x["m"]))
    able = lambda x: F.contains(x["m"], F.lit("@")) | (digits(x) >= min(DIGITS.values()))
    found = found.withColumns({"tokens": F.filter("tokens", able), "based": F.flatten(F.transform("base", _parts)), "grouped": F.flatten(F.transform("groups", _parts))})
    # a span of any kind that meets a token or a run of groups has a part that begins in it
    found = found.withColumns({"t_base": _merged(F.col("tokens"), F.col("based")), "t_group": _merged(F.col("tokens"), F.col("grouped")), "g_base": _merged(F.col("groups"), F.col("based"))})
    found = found.withColumns({c: _marked(F.col(c)) for c in ("t_base", "t_group", "g_base")})
    # token punctuation at the ends is no part of the identifier
    head = lambda x: F.length(F.regexp_extract(x["m"], "^[\"'(\\[<{:=,;]*", 0))
    tail = lambda x: F.length(F.regexp_extract(x["m"], "[^A-Za-z0-9]*$", 0))
    trimmed = lambda c: F.transform(c, lambda x: F.struct(F.substring(x["m"], head(x) + 1, F.length(x["m"]) - head(x) - tail(x)).alias("m"), (x["s"] + head(x)).alias("s"), (x["e"] - tail(x)).alias("e")))
    zipped = lambda x, **marks: F.arrays_zip(F.col(x).alias("x"), *[F.col(c).alias(n) for n, c in marks.items()])
    single = F.transform(F.filter(zipped("tokens", based="t_base", grouped="t_group"), lambda z: ~z["based"] & ((digits(z["x"]) >= min(DIGITS["card"], DIGITS["phone"])) | ~z["grouped"])), lambda z: z["x"])
    several = F.transform(F.filter(zipped("groups", based="g_base"), lambda z: ~z["based"]), lambda z: z["x"])
    found = found.select("doc_id", "row", "base", F.length("text").alias("n"), _blocks(F.col("text")).alias("blocks"), F.filter(F.concat(trimmed(single), trimmed(several)), lambda x: x["s"] < x["e"]).alias("other"))
    other = F.col("other")
    every = F.concat(F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["s"].alias("s"), b["e"].alias("e"), b["m"].alias("m"))), F.transform(other, lambda x: F.struct(F.lit(None).cast("string").alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"))))
    # one step for the usual mentions, another for those whose words reach farther
    first, far = _NEAR
    keep = lambda x: [x[c].alias(c) for c in ("kind", "s", "e", "m")]
    found = found.select("doc_id", "row", "base", "blocks", "n", F.transform(every, lambda x: F.struct(*keep(x), _words_before(x["s"], first).alias("two"), _word_after(x["e"], first).alias("right"))).alias("mentions"))

    def reach(x):
        all_before = F.regexp_extract(_between(F.col("blocks"), F.lit(0), x["s"]), rf"(?:^|[{SPACE}]){_TWO}", 1)
        all_after = F.regexp_extract(_between(F.col("blocks"), x["e"], F.col("n")), _ONE, 1)
        two = F.when((x["s"] <= first) | (x["two"] != ""), x["two"]).otherwise(F.coalesce(F.nullif(_words_before(x["s"], far), F.lit("")), all_before))
        right = F.when((F.col("n") - x["e"] <= first) | (x["right"] != ""), x["right"]).otherwise(F.coalesce(F.nullif(_word_after(x["e"], far), F.lit("")), all_after))
        return F.struct(*keep(x), F.lower(two).alias("two"), F.lower(right).alias("right"))

    found = found.select("doc_id", "row", "base", F.transform("mentions", reach).alias("mentions"))

    def context(x):
        left = F.regexp_extract(x["two"], rf"([^{SPACE}]+)$", 1)
        plain = lambda c: F.regexp_replace(F.regexp_replace(c, "[0-9]", "0"), rf"[{SPACE}]+", " ")
        pats = F.array(F.when(x["two"] != "", F.concat(F.lit("2:"), plain(x["two"]))), F.when((left != "") & (x["right"] != ""), F.concat(F.lit("b:"), plain(left), F.lit("_"), plain(x["right"]))))
        return F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.sha2(F.lower(x["m"]), 256).alias("inst"), F.contains(x["m"], F.lit("@")).alias("at"), F.length(_digits(x["m"])).alias("digits"), F.array_compact(pats).alias("pats"))

    return found.select("doc_id", "row", "base", F.transform("mentions", context).alias("mentions"))


def find_pii(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, pattern: float = PATTERN, instance: float = INSTANCE) -> DataFrame:
    """doc_id, base and spans (arrays of rank, kind, s, e by kind, then place; code points, end exclusive).

    Null and empty texts have no spans. Without seeds nothing is learned and spans equal base. Equal
    texts get equal spans; rows are judged each, whatever their doc_id: null and repeated ones are
    allowed. Columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    seen = materialize(_mentions(base_spans(doc_text(docs))), "mentions")
    flat = seen.select("row", F.explode("mentions").alias("x")).select("row", "x.*")
    edges = materialize(flat.select("inst", "kind", "at", "digits", F.explode("pats").alias("pat")).groupBy("pat", "inst", "kind").agg(F.count("*").alias("n"), F.max("at").alias("at"), F.max("digits").alias("digits")), "edges")
    # only patterns that seeds support can ever be accepted in the first round; later rounds widen from them
    scores = materialize(edges.where("kind IS NOT NULL").select("inst", "kind", F.lit(1.0).alias("score")).distinct(), "scores")
    good = None
    for _ in range(rounds):
        total = edges.groupBy("pat").agg(F.sum("n").alias("total"))
        hit = edges.select("pat", "inst", "n").join(scores, "inst").groupBy("pat", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("w"), F.approx_count_distinct("inst", 0.02).alias("known"))
        new = materialize(hit.where(F.col("known") >= support).join(total, "pat").withColumn("conf", F.col("w") / F.col("total")).where(F.col("conf") >= pattern).select("pat", "kind", "conf"), "patterns")
        if good is not None:
            remove(docs.sparkSession, good._docloom_path)
        good = new
        unknown = edges.where("kind IS NULL").drop("kind").join(good, "pat")
        unknown = unknown.where(F.when(F.col("kind") == "email", F.col("at")).when(F.col("kind") == "ip", F.col("digits") >= DIGITS["ip"]).when(F.col("kind") == "card", F.col("digits") >= DIGITS["card"]).otherwise(F.col("digits") >= DIGITS["phone"]))
        learned = unknown.groupBy("inst", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("conf", F.lit(0.999999)))))).alias("score"))
        seeds = edges.where("kind IS NOT NULL").select("inst", "kind", F.lit(1.0).alias("score")).distinct()
        old, scores = scores, materialize(seeds.unionByName(learned.where(F.col("score") >= instance)).groupBy("inst", "kind").agg(F.max("score").alias("score")), "scores")
        remove(docs.sparkSession, old._docloom_path)
    found = flat.where("kind IS NULL").drop("kind").withColumn("pat", F.explode("pats")).join(good.select("pat", "kind"), "pat").join(scores.select("inst", "kind"), ["inst", "kind"])
    rank = F.create_map(*[x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))])
    extra = found.select("row", F.struct(rank[F.col("kind")].alias("rank"), "kind", "s", "e").alias("x")).groupBy("row").agg(F.collect_set("x").alias("extra"))
    none = F.array().cast("array<struct<rank:int,kind:string,s:int,e:int>>")
    base = F.transform("base", lambda b: F.struct(b["rank"].alias("rank"), b["kind"].alias("kind"), b["s"].alias("s"), b["e"].alias("e")))
    out = seen.join(extra, "row", "left").select("doc_id", F.sort_array(base).alias("base"), F.coalesce("extra", none).alias("extra"))
    # extra spans are apart from base spans, and each is there once
    return out.select("doc_id", "base", F.sort_array(F.concat("base", "extra")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The table with every span (``spans``) of its ``text``, overlapping ones as one, replaced by its kind in brackets."""
    ordered = F.sort_array(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    some = F.size("spans") > 0
    cut = docs.withColumn("_blocks", F.when(some, _blocks(F.col("text"))))
    start = F.struct(F.lit(0).alias("p"), F.array().cast("array<string>").alias("out"))
    put = lambda a, x: F.when(x["s"] >= a["p"], F.struct(x["e"].alias("p"), F.concat(a["out"], F.array(_between(F.col("_blocks"), a["p"], x["s"]), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))).alias("out"))).otherwise(F.struct(F.greatest(a["p"], x["e"]).alias("p"), a["out"].alias("out")))
    whole = F.aggregate(ordered, start, put, lambda a: F.concat(F.array_join(a["out"], ""), _between(F.col("_blocks"), a["p"], F.length("text"))))
    return cut.withColumn("text", F.when(some, whole).otherwise(F.col("text"))).drop("_blocks")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[n(k) for k in KINDS], F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``."""
    return digest(find_pii(table(spark, sf_dir, "documents")))


QUERIES = {"op5_pii": op5_pii}
ORACLE: dict[str, str] = {}
