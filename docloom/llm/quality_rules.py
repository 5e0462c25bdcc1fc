"""Quality rules: base rules and minimum-covariance-determinant outliers, with DataFrame functions only.

Every text becomes a vector of five transformed statistics. Per language and source, a robust centre
and scatter come from concentration steps of the minimum-covariance-determinant estimator: keep the
``SUBSET`` share of rows nearest in Mahalanobis distance, refit mean and covariance on them, and repeat
until no group's determinant changes any more (``STEPS`` at most). There are two starts, medians with
median absolute deviations, and the correlations of the squashed deviations; the one that ends with the
lesser determinant is taken. One reweighting step refits on all rows within the usual chi-square
quantile. Rows beyond a high quantile are rejected.

Fits are mergeable aggregates (quantile sketches, means of products), combined before the shuffle, so
a source that holds a third of all rows costs its tasks no more than others. They are few (one for each
language and source) and broadcast while there are at most ``BROADCAST_FITS``. Groups below ``LEAST_ROWS``
rows have too few for five dimensions and use their language's fit, and languages below it the fit of
all rows; the column ``level`` tells which (2 own, 1 language, 0 all). ``FLOOR`` is a least standard
deviation per statistic: where nearly all rows agree (no symbols, say) the covariance would be singular
and the smallest deviation an outlier.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, doc_text, materialize, remove, table, word_array

SUBSET, STEPS, LEAST_ROWS, CUTOFF = 0.75, 12, 200, 0.999999
#: Change of a log determinant below which a group has settled; quantile of the reweighting step.
SETTLED, REWEIGHT = 1e-2, 0.975
BROADCAST_FITS = 100_000
STATS = ("x_length", "x_word", "x_symbol", "x_line", "x_repeat")
FLOOR = (0.5, 0.6, 0.35, 0.35, 0.5)
_P = len(STATS)


def _chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def _chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def _without(text, chars: str):
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def statistics(docs: DataFrame) -> DataFrame:
    """Base statistics of every whole text: doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = doc_text(docs, "lang", "source").select("doc_id", "lang", "source", "text", word_array(F.col("text"), SPACE).alias("ws"))
    t = t.select(
        "doc_id", "lang", "source", "text",
        F.size("ws").cast("long").alias("n_words"),
        F.expr("CASE WHEN size(ws) >= 5 THEN transform(sequence(0, size(ws) - 5), i -> xxhash64(ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4])) ELSE array() END").cast("array<bigint>").alias("h"),
        F.filter(F.split("text", "\n", -1), lambda s: s.rlike(f"[^{SPACE}]")).alias("lines"),
    )
    # windows found twice: hashes that equal a neighbour in sorted order; only texts with such get their places
    t = t.withColumn("repeats", F.size("h") > F.size(F.array_distinct("h")))
    t = t.withColumn("s", F.expr("CASE WHEN repeats THEN sort_array(transform(h, (x, i) -> struct(x, i))) END"))
    t = t.withColumn("at", F.expr("sort_array(transform(filter(s, (e, k) -> (k > 0 AND s[k - 1].x = e.x) OR (k + 1 < size(s) AND s[k + 1].x = e.x)), e -> e.i))"))
    covered = F.expr("aggregate(at, struct(0 AS n, -5 AS p), (a, i) -> struct(a.n + least(5, i - a.p) AS n, i AS p), a -> a.n)")
    return t.select(
        "doc_id", "lang", "source", "n_words",
        F.length(_without(F.col("text"), " \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), "#*$%&|<>"))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _vectors(stats: DataFrame) -> DataFrame:
    share = lambda a, b: F.log1p(100 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return stats.select(
        "*",
        F.log1p("n_words").alias("x_length"),
        (F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).alias("x_word"),
        share("n_symbols", "word_chars").alias("x_symbol"),
        share("n_dup_lines", "n_words").alias("x_line"),
        share("n_repeat_words", "n_words").alias("x_repeat"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    )


def _distance(fit: str):
    """Squared Mahalanobis distance to the fit in struct column ``fit``: forward substitution on a Cholesky factor."""
    y = []
    for i in range(_P):
        v = F.col(STATS[i]) - F.col(f"{fit}.m{i}")
        for j in range(i):
            v = v - F.col(f"{fit}.l{i}{j}") * y[j]
        y.append(v / F.col(f"{fit}.l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _factor(moments: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """Cholesky factor columns of the scaled covariances c_ij, variances at least the floors, and the log determinant."""
    out = moments
    for i in range(_P):
        for j in range(i + 1):
            v = F.greatest(F.col(f"c{i}{j}") * scale, F.lit(FLOOR[i] ** 2)) if i == j else F.col(f"c{i}{j}") * scale
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(FLOOR[i] ** 2 / 16))) if i == j else v / F.col(f"l{j}{j}"))
    det = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(1, _P)), 2 * F.log("l00"))
    return out.select(*keys, F.struct(*[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i in range(_P) for j in range(i + 1)], det.alias("det")).alias("fit"))


def _few(small: DataFrame) -> DataFrame:
    """A table of groups, broadcast if there are few."""
    return F.broadcast(small) if small.limit(BROADCAST_FITS + 1).count() <= BROADCAST_FITS else small


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Means m_i and covariances c_ij of the rows of each group."""
    return rows.groupBy(*keys).agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)],
        *[F.covar_pop(STATS[i], STATS[j]).alias(f"c{i}{j}") for i in range(_P) for j in range(i + 1)],
    )


def robust_fits(rows: DataFrame, subset: float = SUBSET, steps: int = STEPS) -> DataFrame:
    """(g, fit) of every group ``g`` of rows with the statistics; fits are written, so their table is exact when joined."""
    spark = rows.sparkSession
    middle = materialize(rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 2000).alias(f"m{i}") for i, x in enumerate(STATS)]), "middle")
    spread = rows.join(_few(middle), "g").groupBy("g").agg(*[F.first(f"m{i}").alias(f"m{i}") for i in range(_P)], *[F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 2000), F.lit(FLOOR[i])).alias(f"s{i}") for i, x in enumerate(STATS)])
    spread = materialize(spread, "spread")
    z = [F.tanh((F.col(x) - F.col(f"m{i}")) / F.col(f"s{i}")) for i, x in enumerate(STATS)]
    r = rows.join(_few(spread), "g").groupBy("g").agg(*[F.try_divide(F.covar_pop(z[i], z[j]), F.stddev_pop(z[i]) * F.stddev_pop(z[j])).alias(f"r{i}{j}") for i in range(_P) for j in range(i)])
    both = spread.join(r, "g").withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    cov = [(F.pow(f"s{i}", 2) if i == j else F.when(F.col("start") == 1, F.coalesce(f"r{i}{j}", F.lit(0.0)) * F.col(f"s{i}") * F.col(f"s{j}")).otherwise(0.0)).alias(f"c{i}{j}") for i in range(_P) for j in range(i + 1)]
    keys = ["g", "start"]
    fit = materialize(_factor(both.select(*keys, *[f"m{i}" for i in range(_P)], *cov), keys, 1.0), "mcd")
    remove(spark, middle._docloom_path, spread._docloom_path)
    scale = subset / _chi2_cdf(_chi2_quantile(subset, _P), _P + 2)
    for _ in range(steps):
        near = rows.join(_few(fit), "g").select(*keys, *STATS, _distance("fit").alias("d2"))
        bound = materialize(near.groupBy(*keys).agg(F.percentile_approx("d2", subset, 2000).alias("bound")), "bound")
        new = materialize(_factor(_moments(near.join(_few(bound), keys).where("d2 <= bound"), keys), keys, scale), "mcd")
        open_ = new.join(fit.select(*keys, F.col("fit.det").alias("before")), keys).where(F.abs(F.col("fit.det") - F.col("before")) > SETTLED).count()
        remove(spark, fit._docloom_path, bound._docloom_path)
        fit = new
        if not open_:
            break
    best = materialize(fit.groupBy("g").agg(F.min_by("fit", F.struct("fit.det", "start")).alias("fit")), "mcd")
    share = _chi2_cdf(_chi2_quantile(REWEIGHT, _P), _P + 2)
    inner = rows.join(_few(best), "g").where(_distance("fit") <= _chi2_quantile(REWEIGHT, _P))
    out = materialize(_factor(_moments(inner, ["g"]), ["g"], REWEIGHT / share), "mcd")
    remove(spark, fit._docloom_path, best._docloom_path)
    return out


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Statistics, base_failed, distance, level of the fit and kept of every document.

    Null and empty texts have no words and fail the base rules. A null language or source is a value
    like any other. Documents without any fit (all rows fail the base rules) get a null distance and
    level and keep the base verdict. A distance equal to the cut-off is kept. Repeated rows are judged
    each; an empty table gives no rows; extra columns are ignored.
    """
    named = {"g_lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")), "g_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))}
    rows = materialize(_vectors(statistics(docs)).withColumns(named), "stats")
    sizes = rows.where("NOT base_failed").groupBy("g_lang", "g_source").agg(F.count("*").alias("n"))
    langs = sizes.groupBy("g_lang").agg(F.sum("n").alias("n_lang"))
    groups = rows.select("g_lang", "g_source").distinct().join(sizes, ["g_lang", "g_source"], "left").join(langs, "g_lang", "left")
    own, wide = F.coalesce("n", F.lit(0)) >= least_rows, F.coalesce("n_lang", F.lit(0)) >= least_rows
    # three levels of fits; a group takes the narrowest that has enough rows, and feeds those that others take
    level = F.when(own, 2).when(wide, 1).otherwise(0)
    key = lambda n: F.to_json(F.array(F.lit(str(n)), *[F.col(c) for c in ("g_lang", "g_source")[:n]]))
    groups = materialize(groups.select("g_lang", "g_source", level.alias("level"), F.when(own, key(2)).when(wide, key(1)).otherwise(key(0)).alias("g")), "groups")
    taken = groups.select("g").distinct()
    feeds = groups.select("g_lang", "g_source", F.explode(F.array(key(0), key(1), key(2))).alias("g")).join(taken, "g", "left_semi")
    part = rows.where("NOT base_failed").select("g_lang", "g_source", *STATS).join(_few(materialize(feeds, "feeds")), ["g_lang", "g_source"]).select("g", *STATS)
    fits = materialize(groups.join(robust_fits(part), "g"), "fits")
    bound = _chi2_quantile(cutoff, _P)
    judged = rows.join(_few(fits), ["g_lang", "g_source"], "left").withColumn("distance", _distance("fit"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", F.when(F.col("fit").isNotNull(), F.col("level")).alias("level"), (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= bound)).alias("kept"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules on all ``documents``."""
    return quality_rules(table(spark, sf_dir, "documents"))


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLE: dict[str, str] = {}
