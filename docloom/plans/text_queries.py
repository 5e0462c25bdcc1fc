"""Queries over texts, pages, events and vectors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import references, structure
from .fixtures import table
from .registry import query

_LINES = "WITH l AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, ls[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)) "


def lines(spark, d):
    """Text lines of documents as positioned rows."""
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


@query("line_text", _LINES + "SELECT doc_id, line_no, length(line) AS n_chars, 6 * length(line) AS x2, 12 * line_no AS y1 FROM l")
def line_text(spark, d):
    n = F.length("line").cast("long")
    return lines(spark, d).select("doc_id", "line_no", n.alias("n_chars"), (n * 6).alias("x2"), (F.col("line_no") * 12).alias("y1"))


@query("word_segmentation", _LINES + ", w AS (SELECT doc_id, line_no, string_split(line, ' ') AS ws, unnest(range(1, len(string_split(line, ' ')) + 1)) AS i FROM l) SELECT doc_id, line_no, CAST(i - 1 AS INTEGER) AS word_no, ws[i] AS word, CAST(6 * (coalesce(list_sum(list_transform(ws[1 : i - 1], lambda x: length(x) + 1)), 0)) AS BIGINT) AS x1 FROM w WHERE ws[i] <> ''")
def word_segmentation(spark, d):
    words = lines(spark, d).select("doc_id", "line_no", F.posexplode(F.split("line", " ", -1)).alias("word_no", "word"))
    w = Window.partitionBy("doc_id", "line_no").orderBy("word_no").rowsBetween(Window.unboundedPreceding, -1)
    return words.withColumn("x1", 6 * F.coalesce(F.sum(F.length("word") + 1).over(w), F.lit(0))).where("word <> ''")


@query("reading_text", _LINES + "SELECT doc_id, string_agg(trim(line, ' '), chr(10) ORDER BY line_no) AS text FROM l WHERE trim(line, ' ') <> '' GROUP BY 1")
def reading_text(spark, d):
    own = lines(spark, d).withColumn("line", F.trim("line")).where("line <> ''")
    return own.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))


@query("inid_codes", "WITH t AS (SELECT l_orderkey, l_linenumber, concat('(', CAST(40 + min(l_partkey) % 40 AS VARCHAR), ') x ', CAST(min(l_suppkey) AS VARCHAR)) AS s FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, l_linenumber, array_to_string(list_filter(['10','11','43','45','51','54','57','71','72','73','75','76'], lambda k: contains(replace(s, ' ', ''), '(' || k || ')') OR contains(replace(s, ' ', ''), '[' || k || ']') OR starts_with(replace(s, ' ', ''), k)), ',') AS codes FROM t")
def inid_codes(spark, d):
    t = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    s = F.concat(F.lit("("), (40 + F.col("p") % 40).cast("string"), F.lit(") x "), F.col("s").cast("string"))
    return t.select("l_orderkey", "l_linenumber", F.array_join(T.inid_hits(s), ",").alias("codes"))


@query("patent_number", "SELECT s_suppkey, trim(regexp_extract(s_name || ' US ' || CAST(1000000 + s_suppkey * 7 AS VARCHAR) || ' B2', '[A-Z]{2}\\s*\\d[\\d,/ ]*(\\s*[A-Z]\\d)?', 0)) AS num FROM supplier")
def patent_number(spark, d):
    s = F.concat("s_name", F.lit(" US "), (F.col("s_suppkey") * 7 + 1000000).cast("string"), F.lit(" B2"))
    return table(spark, d, "supplier").select("s_suppkey", T.patent_number(s).alias("num"))


@query("majority_number", "WITH h AS (SELECT l_orderkey, l_suppkey, count(*) AS n, min(l_linenumber) AS f FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, l_suppkey AS num, n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f, l_suppkey) AS j FROM h) WHERE j = 1")
def majority_number(spark, d):
    h = table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("f"))
    best = h.groupBy("l_orderkey").agg(F.min(F.struct((-F.col("n")).alias("k"), "f", "l_suppkey")).alias("m"))
    return best.select("l_orderkey", F.col("m.l_suppkey").alias("num"), (-F.col("m.k")).alias("n"))


_ROMAN = "list_transform(string_split(s, ''), lambda c: CASE c WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 WHEN 'M' THEN 1000 END)"


@query("roman_numerals", "WITH p AS (SELECT p_partkey, p_partkey % 3999 + 1 AS k FROM part), r AS (SELECT p_partkey, repeat('M', CAST(k // 1000 AS INTEGER)) || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][k // 100 % 10 + 1] || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][k // 10 % 10 + 1] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][k % 10 + 1] AS s FROM p), v AS (SELECT *, " + _ROMAN + " AS vs FROM r) SELECT p_partkey, s, CAST(list_sum(list_transform(range(1, len(vs) + 1), lambda i: CASE WHEN vs[i] < coalesce(vs[i + 1], 0) THEN -vs[i] ELSE vs[i] END)) AS INTEGER) AS n FROM v")
def roman_numerals(spark, d):
    k = F.col("p_partkey") % 3999 + 1
    digit = lambda n, one, five, ten: F.element_at(F.array(*[F.lit(x) for x in ("", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten)]), (F.floor(k / n) % 10 + 1).cast("int"))
    s = F.concat(F.expr("repeat('M', cast(floor((p_partkey % 3999 + 1) / 1000) as int))"), digit(100, "C", "D", "M"), digit(10, "X", "L", "C"), digit(1, "I", "V", "X"))
    return table(spark, d, "part").select("p_partkey", s.alias("s")).select("p_partkey", "s", T.roman(F.col("s")).alias("n"))


@query("bracket_repair", "WITH t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_brand || ' [' || p_type || '|' WHEN 1 THEN p_brand || ' /' || p_type || ']' WHEN 2 THEN p_brand || ' [x]' WHEN 3 THEN p_type || ' [b' ELSE p_type END AS x FROM part) SELECT p_partkey, CASE WHEN contains(x, '[') AND NOT contains(x, ']') THEN regexp_replace(x, '^([^\\[]*\\[[^\\\\|1I]*)[\\\\|1I]', '\\1]') WHEN contains(x, ']') AND NOT contains(x, '[') THEN regexp_replace(x, '^([^\\]]*)[/|IΓ]([^\\]/|IΓ]*\\])', '\\1[\\2') ELSE x END AS fixed FROM t")
def bracket_repair(spark, d):
    k = F.col("p_partkey") % 5
    x = F.when(k == 0, F.concat("p_brand", F.lit(" ["), "p_type", F.lit("|"))).when(k == 1, F.concat("p_brand", F.lit(" /"), "p_type", F.lit("]"))).when(k == 2, F.concat("p_brand", F.lit(" [x]"))).when(k == 3, F.concat("p_type", F.lit(" [b"))).otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", T.fix_brackets(x).alias("fixed"))


@query("value_clean", "WITH v AS (SELECT DISTINCT l_quantity, CASE CAST(l_quantity AS BIGINT) % 4 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' %' WHEN 1 THEN '1..' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) WHEN 2 THEN '2. .' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '^{}' END AS s FROM lineitem) SELECT s, replace(replace(replace(replace(replace(s, '. .', '.'), ' ', ''), '..', '.'), '%', ''), '^{}', '') AS v FROM v")
def value_clean(spark, d):
    q = F.col("l_quantity").cast("long")
    s = F.when(q % 4 == 0, F.concat(q.cast("string"), F.lit(" %"))).when(q % 4 == 1, F.concat(F.lit("1.."), q.cast("string"))).when(q % 4 == 2, F.concat(F.lit("2. ."), q.cast("string"))).otherwise(F.concat(q.cast("string"), F.lit("^{}")))
    return table(spark, d, "lineitem").select(s.alias("s")).distinct().select("s", T.clean_value(F.col("s")).alias("v"))


@query("date_parse", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS any_day FROM orders")
def date_parse(spark, d):
    from ..operators.titlepage import any_date

    k = F.col("o_orderkey") % 4
    month = F.when(k == 0, F.date_format("o_orderdate", "MMMM d, yyyy")).when(k == 1, F.date_format("o_orderdate", "MMM. d, yyyy")).otherwise(F.upper(F.date_format("o_orderdate", "MMM dd, yyyy")))
    other = F.when(k == 0, F.date_format("o_orderdate", "d.M.yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 2, F.date_format("o_orderdate", "MMMM d, yyyy")).otherwise("no date")
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("Filed: "), month, F.lit(" x")).alias("m"), F.concat(F.lit("on "), other, F.lit(" x")).alias("a"))
    return o.select("o_orderkey", T.month_date(F.col("m")).alias("day"), any_date(F.col("a")).alias("any_day"))


@query("ipc_split", "SELECT p_brand, array_to_string(list_sort(list_filter(list_distinct(list_transform(string_split('C03C 3/091)' || p_brand || ') nan) C03C 3/091', ')'), lambda x: trim(x))), lambda x: x <> '' AND x <> 'nan')), ',') AS codes FROM (SELECT DISTINCT p_brand FROM part)")
def ipc_split(spark, d):
    b = table(spark, d, "part").select("p_brand").distinct()
    return b.select("p_brand", F.array_join(F.sort_array(T.ipc_codes(F.concat(F.lit("C03C 3/091)"), "p_brand", F.lit(") nan) C03C 3/091")))), ",").alias("codes"))


@query("caption_pattern", _LINES + "SELECT doc_id, line_no, line FROM l WHERE (starts_with(line, 'Table') OR starts_with(line, 'The')) AND len(list_filter(string_split(line, ' ')[1:4], lambda w: regexp_matches(w, '\\d') OR regexp_matches(w, '[:.]$'))) > 0")
def caption_pattern(spark, d):
    return lines(spark, d).where(T.caption_like(F.col("line"), ["Table", "The"]))


@query("file_parts", "SELECT url, regexp_replace(regexp_replace(string_split(url, '/')[-1], '\\.[^.]*$', ''), '\\.', '', 'g') AS name, lower(string_split(string_split(url, '/')[-1], '.')[-1]) AS suffix FROM pages")
def file_parts(spark, d):
    name, suffix = T.file_parts(F.col("url"))
    return table(spark, d, "pages").select("url", name.alias("name"), suffix.alias("suffix"))


@query("pages_nav_links", "SELECT page_id, len(regexp_extract_all(html, '<li[^>]*>')) AS n_items, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS title FROM pages")
def pages_nav_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<li[^>]*>"), F.lit(0))).cast("long").alias("n_items"), F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("title"))


@query("revision_state", "SELECT user_id, event_id FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS j FROM events) WHERE j = 1 AND event_type <> 'error'")
def revision_state(spark, d):
    log = table(spark, d, "events").withColumn("op", F.when(F.col("event_type") == "error", "del").otherwise("add"))
    return references.revision_state(log, "user_id", ["ts", "event_id"]).select("user_id", "event_id")


@query("sliding_metric", "SELECT event_id, round(avg(value) OVER w, 6) AS mean, max(value) OVER w AS top, round(median(value) OVER w, 6) AS mid FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def sliding_metric(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-19, 0)
    return table(spark, d, "events").select("event_id", F.round(F.avg("value").over(w), 6).alias("mean"), F.max("value").over(w).alias("top"), F.round(F.percentile("value", 0.5).over(w), 6).alias("mid"))


@query("sliding_stream", "SELECT user_id, event_id, round(avg(value) OVER w, 6) AS mean, max(value) OVER w AS top, round(median(value) OVER w, 6) AS mid, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 9) AS overall, count(*) OVER w AS n FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def sliding_stream(spark, d):
    """The sliding metric as a stream with state and timers."""
    from ..streaming.sliding import streamed

    found = streamed(spark, table(spark, d, "events"))
    return found.select("user_id", "event_id", F.round("mean", 6).alias("mean"), "top", F.round("mid", 6).alias("mid"), F.round("overall", 9).alias("overall"), "n")


@query("mode_value", "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS j FROM events GROUP BY 1, 2) WHERE j = 1")
def mode_value(spark, d):
    h = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("f"))
    return h.groupBy("user_id").agg(F.min(F.struct((-F.col("n")).alias("k"), "f", "event_type")).alias("m")).select("user_id", F.col("m.event_type").alias("event_type"), (-F.col("m.k")).alias("n"))


@query("softmax_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS label, round(1 / list_sum(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(embedding) AS DOUBLE)))), 6) AS score FROM embeddings")
def softmax_argmax(spark, d):
    top = structure.softmax_top(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", top.alias("m")).select("vec_id", "m.label", F.round("m.score", 6).alias("score"))


@query("class_threshold", "SELECT vec_id, label, score FROM (SELECT vec_id, label, list_max(embedding) AS score FROM embeddings) WHERE score >= CASE label WHEN 0 THEN 0.2 WHEN 1 THEN 0.25 WHEN 2 THEN 0.35 ELSE 0.3 END")
def class_threshold(spark, d):
    found = table(spark, d, "embeddings").select("vec_id", "label", F.array_max("embedding").alias("score"))
    return structure.above_thresholds(found, {0: 0.2, 1: 0.25, 2: 0.35}, 0.3)


@query("stream_ingest", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def stream_ingest(spark, d):
    from ..streaming.ingest import count_events

    return count_events(spark, f"{d}/events.parquet")


@query("event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    from ..streaming.ingest import windowed_counts

    return windowed_counts(table(spark, d, "events"))
