"""Queries over table cells: structure, header logic, extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import knowledge
from ..operators import dictionary, tables
from .fixtures import GRID_SQL, grid, table
from .registry import query

_G = f"WITH g AS ({GRID_SQL}) "
_U = f"WITH g0 AS ({GRID_SQL}), g AS (SELECT doc_id, table_id, CASE WHEN transposed THEN c ELSE r END AS r, CASE WHEN transposed THEN r ELSE c END AS c, content FROM g0) "
_VALUES = ", ".join("(" + ", ".join([str(i), "'" + n.replace("'", "''") + "'", str(j), "'" + p.replace("'", "''") + "'"]) + ")" for i, (n, ps) in enumerate(knowledge.DEFAULT.items()) for j, p in enumerate(ps))
_K = f", k(ord, canonical, pat_ord, pattern) AS (VALUES {_VALUES}) "


def _upright(spark, d):
    return tables.upright(grid(spark, d))


@query("grid_upright", _U + "SELECT table_id, r, c, content FROM g")
def grid_upright(spark, d):
    return _upright(spark, d)


@query("cell_spans", _U + "SELECT table_id, content, min(r) AS r1, max(r) AS r2, min(c) AS c1, max(c) AS c2, count(*) AS n FROM g GROUP BY 1, 2")
def cell_spans(spark, d):
    return tables.spans(_upright(spark, d))


_FLAGS = ", s AS (SELECT *, coalesce(max(content) FILTER (WHERE c = 0) OVER (PARTITION BY table_id, r), chr(1)) AS k FROM g), s0 AS (SELECT *, max(k) FILTER (WHERE r = 0) OVER (PARTITION BY table_id) AS k0 FROM s), fl AS (SELECT table_id, r, c, content, coalesce(k = k0, false) AS column_label, NOT coalesce(k = k0, false) AND c < 1 AS row_label FROM s0) "


@query("header_paths", _U + _FLAGS + ", p AS (SELECT *, string_agg(content, ' | ') FILTER (WHERE column_label) OVER (PARTITION BY table_id, c ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up, string_agg(content, ' | ') FILTER (WHERE row_label) OVER (PARTITION BY table_id, r ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS side FROM fl) SELECT table_id, r, c, coalesce(up, '') AS column_path, coalesce(side, '') AS row_path FROM p WHERE NOT column_label AND NOT row_label")
def header_paths(spark, d):
    return tables.header_paths(tables.label_flags(_upright(spark, d)))


@query("prev_nonempty_cell", _U + ", p AS (SELECT *, lag(r) OVER w AS pr, lag(content) OVER w AS above FROM g WINDOW w AS (PARTITION BY table_id, c ORDER BY r)) SELECT table_id, r, c, above, CAST(r - pr - 1 AS INTEGER) AS skipped FROM p WHERE above IS NOT NULL")
def prev_nonempty_cell(spark, d):
    return tables.previous_nonempty(_upright(spark, d))


@query("row_fill_patterns", _U + ", s AS (SELECT table_id, unnest(range(0, max(c) + 1)) AS c FROM g GROUP BY table_id) SELECT s.table_id, CAST(s.c AS INTEGER) AS c, coalesce(a.content, b.content) AS row0, coalesce(b.content, a.content) AS row1 FROM s LEFT JOIN g a ON a.table_id = s.table_id AND a.c = s.c AND a.r = 0 LEFT JOIN g b ON b.table_id = s.table_id AND b.c = s.c AND b.r = 1")
def row_fill_patterns(spark, d):
    return tables.fill_span_row(_upright(spark, d))


_RUN = "{0} AS line, count(*) AS n, 2 * coalesce(sum(s), 0) >= count(*) - 1 AS numbered FROM (SELECT table_id, {0}, CAST(lead(v) OVER (PARTITION BY table_id, {0} ORDER BY {1}) - v = 1 AS INTEGER) AS s FROM v) GROUP BY table_id, {0} HAVING count(*) >= 2"
_NUM = ", v AS (SELECT table_id, r, c, TRY_CAST(regexp_extract(content, '(\\d+)$', 1) AS BIGINT) AS v FROM {} WHERE regexp_matches(content, '\\d+$')), n AS (SELECT table_id, 'row' AS axis, " + _RUN.format("r", "c") + " UNION ALL SELECT table_id, 'column', " + _RUN.format("c", "r") + ") "


@query("numbering_runs", _U + _NUM.format("g") + "SELECT * FROM n")
def numbering_runs(spark, d):
    return tables.numbering_runs(_upright(spark, d))


@query("table_orientation", _G + _NUM.format("g") + "SELECT table_id, coalesce(bool_or(axis = 'column' AND numbered), false) AND NOT coalesce(bool_or(axis = 'row' AND numbered), false) AS transposed FROM n GROUP BY 1")
def table_orientation(spark, d):
    return tables.orientation(tables.numbering_runs(grid(spark, d)))


@query("repeated_stub", _U + ", f AS (SELECT DISTINCT a.table_id, a.r, coalesce(s.content, chr(1)) AS k FROM g a LEFT JOIN g s ON s.table_id = a.table_id AND s.r = a.r AND s.c = 0), h AS (SELECT DISTINCT f.table_id, f.r FROM f JOIN f z ON z.table_id = f.table_id AND z.r = 0 AND z.k = f.k) SELECT g.table_id, g.r, g.c, g.content, h.r IS NOT NULL AS column_label, h.r IS NULL AND g.c < 1 AS row_label FROM g LEFT JOIN h ON h.table_id = g.table_id AND h.r = g.r")
def repeated_stub(spark, d):
    return tables.label_flags(_upright(spark, d))


@query("starting_rows", _U + ", n AS (SELECT table_id, r, count(content) AS n, count(*) FILTER (WHERE regexp_matches(trim(content), '^[+-]?(\\d|[.,]\\d)')) AS k, max(c) AS c FROM g GROUP BY 1, 2), w AS (SELECT *, max(c) OVER (PARTITION BY table_id) + 1 AS w FROM n), f AS (SELECT *, min(r) FILTER (WHERE n = w) OVER (PARTITION BY table_id) AS fr FROM w) SELECT table_id, coalesce(least(any_value(fr), coalesce(min(r - 2) FILTER (WHERE r <= fr AND 2 * k > n), any_value(fr))), -9) AS last_header FROM f GROUP BY 1")
def starting_rows(spark, d):
    return tables.starting_rows(_upright(spark, d)).withColumn("last_header", F.coalesce("last_header", F.lit(-9)))


@query("prev_nonempty_left", _U + ", p AS (SELECT *, lag(c) OVER w AS pc, lag(content) OVER w AS before FROM g WINDOW w AS (PARTITION BY table_id, r ORDER BY c)) SELECT table_id, r, c, before, CAST(c - pc - 1 AS INTEGER) AS skipped FROM p WHERE before IS NOT NULL")
def prev_nonempty_left(spark, d):
    return tables.previous_nonempty(_upright(spark, d), "c", "before")


@query("numbered_tables", _U + ", w AS (SELECT doc_id AS doc, table_id, table_id % 4 AS number, table_id % 3 = 0 AS continued, CASE WHEN table_id % 5 = 0 THEN NULL ELSE max(c) + 1 END AS n FROM g GROUP BY 1, 2), f AS (SELECT *, row_number() OVER (PARTITION BY doc, number ORDER BY table_id) AS j FROM w) SELECT doc, count(*) FILTER (WHERE j = 1 AND NOT continued) AS n_tables, string_agg(CAST(coalesce(n, -1) AS VARCHAR), ',' ORDER BY table_id) AS widths FROM f GROUP BY 1")
def numbered_tables(spark, d):
    own = tables.upright(grid(spark, d), "doc_id").groupBy(F.col("doc_id").alias("doc"), "table_id").agg((F.max("c") + 1).alias("n"))
    own = own.select("doc", "table_id", (F.col("table_id") % 4).alias("number"), (F.col("table_id") % 3 == 0).alias("continued"), F.when(F.col("table_id") % 5 != 0, F.col("n")).alias("n_columns"))
    return tables.table_counts(own).withColumn("widths", F.array_join(F.transform("widths", lambda x: x.cast("string")), ","))


@query("carry_prefix", "SELECT l_orderkey, l_linenumber, l_partkey, last_value(CASE WHEN l_partkey % 3 = 0 THEN l_returnflag END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)")
def carry_prefix(spark, d):
    t = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_returnflag").alias("f"))
    t = t.withColumn("p", F.when(F.col("l_partkey") % 3 == 0, F.col("f")))
    return tables.carry_prefix(t, "l_orderkey", "l_linenumber", "p").select("l_orderkey", "l_linenumber", "l_partkey", "carried")


@query("claims_tables", _U + ", m AS (SELECT table_id FROM g GROUP BY 1 HAVING max(c) = 1) SELECT table_id, r, replace(replace(max(content) FILTER (WHERE c = 0), ' ι ', ' + '), ' t ', ' + ') AS compound, max(content) FILTER (WHERE c = 1) AS amount FROM g WHERE table_id IN (SELECT table_id FROM m) GROUP BY 1, 2")
def claims_tables(spark, d):
    return tables.claims(grid(spark, d))


_MATCH = ", t AS (SELECT DISTINCT content FROM g), f AS (SELECT content, canonical, pattern, row_number() OVER (PARTITION BY content ORDER BY ord, pat_ord) AS j FROM t JOIN k ON regexp_matches(content, '^(?:' || pattern || ')')) "


@query("regex_dictionary", _G + _K + _MATCH + "SELECT t.content, canonical, pattern FROM t LEFT JOIN f ON f.content = t.content AND j = 1")
def regex_dictionary(spark, d):
    return dictionary.match_names(grid(spark, d), knowledge.DEFAULT)


_UNITS = ", ".join(f"({i}, '{u}', '{s}')" for i, (u, ss) in enumerate(knowledge.UNITS.items()) for s in [u, *ss])


@query("unit_dictionary", _G + f", u(ord, unit, synonym) AS (VALUES {_UNITS}), t AS (SELECT DISTINCT content FROM g) SELECT content, unit FROM (SELECT content, unit, row_number() OVER (PARTITION BY content ORDER BY ord, unit) AS j FROM t JOIN u ON contains(replace(replace(replace(lower(content), ' ', ''), '(', ''), ')', ''), synonym)) WHERE j = 1")
def unit_dictionary(spark, d):
    return dictionary.line_units(grid(spark, d).select("content").distinct(), knowledge.units(spark))


_TOK = "WITH w AS (SELECT unnest(string_split(regexp_replace(text, '[^ -~]', '?', 'g'), ' ')) AS word FROM benchmark), dct AS (SELECT DISTINCT word FROM w WHERE length(word) >= 2), tok AS (SELECT DISTINCT 'x' AS z, substr(word, 1, length(word) - 1) AS token FROM dct) "


@query("fuzzy_dictionary", _TOK + "SELECT token, word, distance FROM (SELECT token, word, CAST(levenshtein(token, word) AS BIGINT) AS distance, row_number() OVER (PARTITION BY token ORDER BY levenshtein(token, word), word) AS j FROM tok JOIN dct ON levenshtein(token, word) <= 1) WHERE j = 1")
def fuzzy_dictionary(spark, d):
    words = table(spark, d, "benchmark").select(F.explode(F.split(F.regexp_replace("text", "[^ -~]", "?"), " ")).alias("word")).where(F.length("word") >= 2).distinct()
    return dictionary.close_words(words.select(F.expr("substring(word, 1, length(word) - 1)").alias("token")), words)


@query("component_count")
def component_count(spark, d):
    return tables.component_count(_points(spark, d))


@query("table_counts", _U + ", w AS (SELECT table_id, max(c) + 1 AS w, max(r) + 1 AS h, count(*) AS n FROM g GROUP BY 1) SELECT CAST(floor(table_id / 10.0) AS BIGINT) AS doc, count(*) AS n_tables, CAST(sum(n) AS BIGINT) AS n_cells, string_agg(CAST(w AS VARCHAR), ',' ORDER BY table_id) AS widths FROM w GROUP BY 1")
def table_counts(spark, d):
    w = _upright(spark, d).groupBy("table_id").agg((F.max("c") + 1).alias("w"), F.count("*").alias("n"))
    docs = w.groupBy(F.floor(F.col("table_id") / 10).alias("doc")).agg(F.count("*").alias("n_tables"), F.sum("n").alias("n_cells"), F.sort_array(F.collect_list(F.struct("table_id", "w"))).alias("l"))
    return docs.select("doc", "n_tables", "n_cells", F.array_join(F.transform("l", lambda x: x["w"].cast("string")), ",").alias("widths"))


def _points(spark, d):
    return tables.setpoints(grid(spark, d, "doc_id"), knowledge.DEFAULT)


_EXAMPLE = "CASE WHEN regexp_extract(content, '(?: |^|.)\\d+ *(\\.|,)? *\\d*', 0) = '' THEN NULL ELSE concat(CASE WHEN contains(content, 'Ex') THEN 'Ex-' WHEN contains(content, 'No') THEN 'No-' ELSE '' END, regexp_replace(replace(regexp_replace(regexp_extract(content, '(?: |^|.)\\d+ *(\\.|,)? *\\d*', 0), '^\\.', ''), ' ', ''), '^-', '')) END"
_FIX = "CASE WHEN contains(content, '[') AND NOT contains(content, ']') THEN regexp_replace(content, '^([^\\[]*\\[[^\\\\|1I]*)[\\\\|1I]', '\\1]') WHEN contains(content, ']') AND NOT contains(content, '[') THEN regexp_replace(content, '^([^\\]]*)[/|IΓ]([^\\]/|IΓ]*\\])', '\\1[\\2') ELSE content END"
_BR = "[\\[{(]([^\\]\\[\\}\\{\\)\\(]+)[\\]})]"
_SET = (
    _U + _K + f""", m AS (SELECT table_id FROM g GROUP BY 1 HAVING max(c) > 1), b AS (SELECT g.* FROM g JOIN m USING (table_id)),
gl AS (SELECT table_id, c, {_EXAMPLE} AS glass_id FROM b WHERE r = 0 AND c > 0),
lab AS (SELECT DISTINCT content, {_FIX} AS fixed FROM b WHERE c = 0 AND r > 0),
par AS (SELECT content, CASE WHEN regexp_extract(fixed, '{_BR}', 0) = '' THEN trim(fixed) ELSE trim(replace(fixed, regexp_extract(fixed, '{_BR}', 0), '')) END AS name, translate(regexp_extract(fixed, '{_BR}', 1), '()[]{{}} ', '') AS unit FROM lab),
tps AS (SELECT content, name, unit, contains(name, '+') AS plus, list_filter(list_transform(string_split(name, '+'), lambda x: trim(x)), lambda x: x <> '') AS ts FROM par),
trm AS (SELECT content, CASE WHEN NOT plus THEN [name] WHEN len(ts) > 1 THEN ts ELSE [] END AS ts FROM tps),
ter AS (SELECT content, unnest(ts) AS term, unnest(range(len(ts))) AS pos FROM trm),
hit AS (SELECT term, canonical, pattern, row_number() OVER (PARTITION BY term ORDER BY ord, pat_ord) AS j FROM (SELECT DISTINCT term FROM ter) JOIN k ON regexp_matches(term, '^(?:' || pattern || ')')),
agg AS (SELECT content, string_agg(coalesce(canonical, ter.term), ' + ' ORDER BY pos) AS joined, max(canonical) AS canonical, coalesce(string_agg(ter.term || ' -> ' || pattern || '  ', '' ORDER BY pos), '') AS arrows FROM ter LEFT JOIN hit ON hit.term = ter.term AND j = 1 GROUP BY content),
nam AS (SELECT t.content, CASE WHEN plus AND len(ts) > 1 THEN joined WHEN NOT plus AND canonical IS NOT NULL THEN canonical || CASE WHEN contains(name, 'total amount') THEN ' [total]' ELSE '' END ELSE name END AS property,
  CASE WHEN plus AND len(ts) > 1 THEN arrows WHEN NOT plus AND canonical IS NOT NULL THEN rtrim(arrows) ELSE 'new' END AS comment FROM tps t LEFT JOIN agg USING (content)),
lb AS (SELECT nam.content, property, comment, CASE WHEN unit = '' THEN NULL WHEN unit IN ('wt%', 'mol%', 'mass%') AND contains(property, ' ') AND NOT contains(property, '+') THEN '-' ELSE unit END AS unit FROM nam JOIN par USING (content)),
dat AS (SELECT d.doc_id, glass_id, property, comment, d.table_id, d.r, d.c, replace(replace(replace(replace(replace(d.content, '. .', '.'), ' ', ''), '..', '.'), '%', ''), '^{{}}', '') AS value, CASE WHEN contains(d.content, '%') AND coalesce(unit, '') = '' THEN '%' ELSE coalesce(unit, '') END AS unit
  FROM b d JOIN gl ON gl.table_id = d.table_id AND gl.c = d.c JOIN b l ON l.table_id = d.table_id AND l.r = d.r AND l.c = 0 JOIN lb ON lb.content = l.content WHERE d.r > 0 AND d.c > 0 AND glass_id IS NOT NULL),
tab AS (SELECT doc_id, glass_id, list_sort(list(DISTINCT table_id)) AS tables FROM dat GROUP BY 1, 2),
sp AS (SELECT doc_id, glass_id, property, value, unit, comment FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, glass_id, property ORDER BY table_id DESC, r DESC, c DESC) AS j FROM dat) WHERE j = 1) """
)


@query("setpoint_last_wins", _SET + "SELECT * FROM sp")
def setpoint_last_wins(spark, d):
    return _points(spark, d).drop("tables")


_KEYS = tables.column_keys(list(knowledge.DEFAULT))
_OTHERS = "coalesce(string_agg(property || '=' || value || ' ' || unit, '; ' ORDER BY property) FILTER (WHERE property NOT IN (" + ", ".join(f"'{p}'" for p in _KEYS) + ")), '') AS others"


@query("setpoints_wide", _SET + "SELECT doc_id, glass_id, " + ", ".join(f"max({c}) FILTER (WHERE property = '{p}') AS {k}_{c}" for p, k in _KEYS.items() for c in ("value", "unit")) + f", {_OTHERS} FROM sp GROUP BY 1, 2")
def setpoints_wide(spark, d):
    return tables.wide_table(_points(spark, d), list(knowledge.DEFAULT))


@query("extraction_records", _SET + "SELECT doc_id || '-' || glass_id AS id, count(*) FILTER (WHERE value NOT IN ('N.A.', '0.0', '') AND unit IN ('mol%', 'wt%', 'mass%')) AS n_components, any_value(array_to_string(tables, ',')) AS tables, string_agg(property || '=' || value || ' ' || unit || ' (' || comment || ')', '; ' ORDER BY property) AS record FROM sp JOIN tab USING (doc_id, glass_id) GROUP BY doc_id, glass_id")
def extraction_records(spark, d):
    out = tables.extraction(_points(spark, d))
    entry = lambda x: F.concat(x["key"], F.lit("="), x["value"]["value"], F.lit(" "), x["value"]["unit"], F.lit(" ("), x["value"]["comment"], F.lit(")"))
    return out.select(F.col("generatedObjectIdentifier").alias("id"), F.col("NumberOfComponent").cast("long").alias("n_components"), F.array_join(F.transform("tables", lambda x: x.cast("string")), ",").alias("tables"), F.array_join(F.transform(F.map_entries("setpoints"), entry), "; ").alias("record"))


from .registry import ORACLE  # noqa: E402

ORACLE["component_count"] = _SET + "SELECT doc_id, glass_id, count(*) FILTER (WHERE value NOT IN ('N.A.', '0.0', '') AND unit IN ('mol%', 'wt%', 'mass%')) AS n_components, count(*) AS n_properties FROM sp GROUP BY 1, 2"


@query("table_csv", _U + ", s AS (SELECT table_id, max(r) AS mr, max(c) AS mc FROM g GROUP BY 1), p AS (SELECT table_id, mc, unnest(range(0, mr + 1)) AS r FROM s), q AS (SELECT table_id, r, unnest(range(0, mc + 1)) AS c FROM p) SELECT q.table_id, CAST(q.r AS INTEGER) AS r, string_agg(CASE WHEN content IS NULL THEN '' WHEN q.r = 0 THEN '~' || content WHEN q.c = 0 THEN '^' || content ELSE content END, ',' ORDER BY q.c) AS line FROM q LEFT JOIN g ON g.table_id = q.table_id AND g.r = q.r AND g.c = q.c GROUP BY 1, 2")
def table_csv(spark, d):
    from ..sources.writers import table_lines

    return table_lines(_upright(spark, d), ",")


@query("table_markdown", _U + ", s AS (SELECT table_id, max(r) AS mr, max(c) AS mc FROM g GROUP BY 1), p AS (SELECT table_id, mc, unnest(range(0, mr + 1)) AS r FROM s), q AS (SELECT table_id, r, unnest(range(0, mc + 1)) AS c FROM p) SELECT q.table_id, CAST(q.r AS INTEGER) AS r, '| ' || string_agg(coalesce(content, ''), ' | ' ORDER BY q.c) || ' |' AS line FROM q LEFT JOIN g ON g.table_id = q.table_id AND g.r = q.r AND g.c = q.c GROUP BY 1, 2")
def table_markdown(spark, d):
    from ..sources.writers import markdown_lines

    return markdown_lines(_upright(spark, d))


@query("table_html", _U + ", s AS (SELECT table_id, max(r) AS mr, max(c) AS mc FROM g GROUP BY 1), p AS (SELECT table_id, mc, unnest(range(0, mr + 1)) AS r FROM s), q AS (SELECT table_id, r, unnest(range(0, mc + 1)) AS c FROM p), t AS (SELECT q.table_id, q.r, q.c, CASE WHEN q.r = 0 OR q.c = 0 THEN '<th>' ELSE '<td>' END || replace(replace(replace(coalesce(content, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || CASE WHEN q.r = 0 OR q.c = 0 THEN '</th>' ELSE '</td>' END AS h FROM q LEFT JOIN g ON g.table_id = q.table_id AND g.r = q.r AND g.c = q.c), l AS (SELECT table_id, r, '<tr>' || string_agg(h, '' ORDER BY c) || '</tr>' AS h FROM t GROUP BY 1, 2) SELECT table_id, '<table>' || string_agg(h, '' ORDER BY r) || '</table>' AS html FROM l GROUP BY 1")
def table_html(spark, d):
    from ..sources.writers import html_tables

    return html_tables(_upright(spark, d))
