"""Pieces of DuckDB SQL from which the catalogue's oracles are put together."""

from __future__ import annotations

READINGS = """readings AS (
  SELECT l_orderkey AS key, l_returnflag AS reader,
    row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate) AS ordinal,
    p_name AS title,
    CASE l_suppkey % 5 WHEN 0 THEN l_linenumber::VARCHAR WHEN 1 THEN '0' || l_linenumber WHEN 2 THEN ['i','ii','iii','iv','v','vi','vii'][l_linenumber] WHEN 3 THEN upper(['i','ii','iii','iv','v','vi','vii'][l_linenumber]) END AS page,
    l_linestatus = 'F' AS skip
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PERTURBED = """base AS (SELECT * FROM readings WHERE reader = 'A'), perturbed AS (
  SELECT * FROM base UNION ALL
  SELECT key, 'B', ordinal, CASE (key * 31 + ordinal * 7) % 20 WHEN 3 THEN '3 ' || title WHEN 7 THEN 'Chapter 4: ' || title WHEN 9 THEN 'I ' || title ELSE title END, CASE WHEN (key * 31 + ordinal * 7) % 20 <> 5 THEN page END, skip FROM base)"""


def entries(source: str = "readings") -> str:
    """entries: the source with page_val, and page_at, on which pages are equivalent; strict is the title for near identity."""
    return f"""entries AS (
  SELECT *, coalesce(page_val::VARCHAR, '-') AS page_at, lower(trim(regexp_replace(title, '^\\s*(?:(?:chapter|kapitel|chapitre|capítulo)\\s+)?\\d+(?:\\.\\d+)*\\s*[.:]?\\s+', '', 'i'))) AS strict
  FROM (SELECT *, coalesce(try_cast(page AS INTEGER), list_position(['i','ii','iii','iv','v','vi','vii'], lower(page))) AS page_val FROM {source}))"""


def common(a: str, b: str) -> str:
    """Length of the longest common subsequence: a row of the table for each character of a."""
    cell = f"greatest(r[j[1] + 1], acc[j[1]], r[j[1]] + CASE WHEN ord(substr({b}, j[1], 1)) = c[1] THEN 1 ELSE 0 END)"
    row = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j::INTEGER]), lambda acc, j: list_append(acc, {cell}), [0])"
    return f"list_extract(list_reduce(list_transform(string_split({a}, ''), lambda c: [ord(c)]), lambda r, c: {row}, list_transform(range(0, length({b}) + 1), lambda x: 0)), -1)"


def ratio(a: str, b: str) -> str:
    return f"(200.0 * {common(a, b)} / (length({a}) + length({b})))::DOUBLE"


def tokens(a: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split_regex({a}, '\\s+'), lambda t: t <> '')), ' ')"


def scored(pairs: str) -> str:
    """scores: for the distinct (ta, tb, sa, sb) of a relation, the title score and the strict score."""
    return f"""texts AS (SELECT DISTINCT ta, tb, sa, sb, CASE WHEN length(ta) <= length(tb) THEN lower(ta) ELSE lower(tb) END AS small, CASE WHEN length(ta) <= length(tb) THEN lower(tb) ELSE lower(ta) END AS large FROM {pairs}),
ways AS (SELECT DISTINCT small, large, small AS whole, large AS other FROM texts UNION SELECT DISTINCT small, large, large, small FROM texts WHERE length(small) = length(large)),
windows AS (SELECT DISTINCT small, large, whole, substr(other, greatest(1, k), least(k + length(whole), length(other) + 1) - greatest(1, k)) AS part FROM (SELECT *, unnest(range(2 - length(whole), length(other) + 1)) AS k FROM ways)),
parts AS (SELECT whole, part, {ratio('whole', 'part')} AS r FROM (SELECT DISTINCT whole, part FROM windows)),
partial AS (SELECT small, large, max(r) AS r FROM windows JOIN parts USING (whole, part) GROUP BY ALL),
sorted AS (SELECT DISTINCT {tokens('x')} AS x, x AS raw FROM (SELECT lower(ta) AS x FROM texts UNION SELECT lower(tb) FROM texts UNION SELECT sa FROM texts UNION SELECT sb FROM texts)),
scores AS (SELECT t.ta, t.tb, t.sa, t.sb, greatest({ratio('a.x', 'b.x')}, p.r) AS score, {ratio('c.x', 'd.x')} AS strict, p.r AS partial, {ratio('a.x', 'b.x')} AS sort_ratio
  FROM texts t JOIN partial p USING (small, large) JOIN sorted a ON a.raw = lower(t.ta) JOIN sorted b ON b.raw = lower(t.tb) JOIN sorted c ON c.raw = t.sa JOIN sorted d ON d.raw = t.sb)"""


ALIGNED = f"""met AS (SELECT a.key, a.reader AS side_a, b.reader AS side_b, a.ordinal AS i, b.ordinal AS j, a.title AS ta, b.title AS tb, a.strict AS sa, b.strict AS sb, a.page_at
  FROM left_side a JOIN right_side b ON a.key = b.key AND a.page_at = b.page_at AND (a.reader < b.reader OR a.fixed) AND a.reader <> b.reader),
{scored('met')},
cand AS MATERIALIZED (SELECT key, side_a, side_b, i, j, CASE WHEN page_at = '-' THEN strict ELSE score END AS score, strict >= 95 AS near FROM met JOIN scores USING (ta, tb, sa, sb) WHERE CASE WHEN page_at = '-' THEN strict >= 95 ELSE score >= 70 END),
steps AS (SELECT key, side_a, side_b, i, dense_rank() OVER (PARTITION BY key, side_a, side_b ORDER BY i) AS r FROM (SELECT DISTINCT key, side_a, side_b, i FROM cand)),
walk AS (SELECT DISTINCT key, side_a, side_b, 0::BIGINT AS r, 0::BIGINT AS last, NULL::BIGINT AS i, NULL::BIGINT AS j, NULL::BOOLEAN AS near FROM cand
  UNION ALL SELECT w.key, w.side_a, w.side_b, w.r + 1, coalesce(b.j, w.last), s.i, b.j, b.near FROM walk w JOIN steps s ON s.key = w.key AND s.side_a = w.side_a AND s.side_b = w.side_b AND s.r = w.r + 1
  LEFT JOIN LATERAL (SELECT c.j, c.near FROM cand c WHERE c.key = w.key AND c.side_a = w.side_a AND c.side_b = w.side_b AND c.i = s.i AND c.j > w.last ORDER BY c.score DESC, c.j DESC LIMIT 1) b ON true),
matched AS MATERIALIZED (SELECT key, side_a, side_b, i, j, near FROM walk WHERE j IS NOT NULL)"""

#: Reader B has the last word of a title, and the whole as its variant; met has a row for each pair of titles.
WRAPPED = """wrapped AS (SELECT *, []::VARCHAR[] AS variants FROM readings WHERE reader = 'A'
  UNION ALL SELECT * REPLACE ('B' AS reader, string_split(title, ' ')[-1] AS title), [title] FROM readings WHERE reader = 'A')"""
VARIANTS = """met AS (SELECT a.key, a.ordinal AS i, b.ordinal AS j, a.page_at, x.t AS ta, y.t AS tb, a.strict AS sa, b.strict AS sb
  FROM entries a JOIN entries b ON a.key = b.key AND a.page_at = b.page_at AND a.reader < b.reader, unnest(list_append(a.variants, a.title)) x(t), unnest(list_append(b.variants, b.title)) y(t))"""

SIDES = "left_side AS (SELECT *, false AS fixed FROM entries), right_side AS (SELECT * FROM entries)"

RATES = """sizes AS (SELECT key, reader, count(*) AS n FROM entries GROUP BY ALL),
pairs AS (SELECT a.key, a.reader AS side_a, b.reader AS side_b, a.n AS n_a, b.n AS n_b FROM sizes a JOIN sizes b ON a.key = b.key AND a.reader < b.reader),
hits AS (SELECT key, side_a, side_b, count(*) AS matched, bool_and(near) AS near FROM matched GROUP BY ALL),
rates AS (SELECT key, side_a, side_b, n_a, n_b, coalesce(matched, 0) AS matched, coalesce(near, true) AS near, coalesce(matched, 0) / greatest(n_a, n_b) AS rate FROM pairs LEFT JOIN hits USING (key, side_a, side_b))"""

TRUTH = "truth AS (SELECT o_orderkey AS key, CASE o_orderstatus WHEN 'F' THEN 'agent_arbitration' WHEN 'O' THEN 'bulk_gate' END AS source FROM orders WHERE o_orderstatus IN ('F', 'O'))"

GATE = """gated AS (SELECT *, rate >= 0.9 AND near AS passed FROM rates),
best AS MATERIALIZED (SELECT * FROM gated WHERE passed QUALIFY row_number() OVER (PARTITION BY key ORDER BY rate DESC, side_a, side_b) = 1)"""

#: What holds two readings that mostly agree against each other.
CLOSE_PARTS = (READINGS, PERTURBED, entries("perturbed"), SIDES, ALIGNED, RATES, GATE)

#: Reader A of arbitrated orders, page-sorted, is the truth that the other readers are held against.
GOLD = """gold AS (SELECT e.* REPLACE (row_number() OVER (PARTITION BY key ORDER BY page IS NULL, coalesce(page_val, 0), coalesce(page, ''), ordinal) AS ordinal) FROM entries e WHERE reader = 'A' AND key IN (SELECT key FROM truth WHERE source = 'agent_arbitration')),
others AS (SELECT e.* REPLACE (row_number() OVER (PARTITION BY key, reader ORDER BY page IS NULL, coalesce(page_val, 0), coalesce(page, ''), ordinal) AS ordinal) FROM entries e WHERE reader <> 'A'),
left_side AS (SELECT *, true AS fixed FROM gold), right_side AS (SELECT * FROM others)"""
GOLD_SCORES = """counted AS (SELECT o.key, o.reader AS model, coalesce(m.tp, 0) AS tp, o.n - coalesce(m.tp, 0) AS fp, g.n - coalesce(m.tp, 0) AS fn
  FROM (SELECT key, reader, count(*) AS n FROM others GROUP BY ALL) o JOIN (SELECT key, count(*) AS n FROM gold GROUP BY ALL) g ON o.key = g.key LEFT JOIN (SELECT key, side_b, count(*) AS tp FROM matched GROUP BY ALL) m ON m.key = o.key AND m.side_b = o.reader),
shares AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM counted),
evaluated AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM shares),
accuracy AS (SELECT model, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, count(*) AS n_books FROM evaluated GROUP BY ALL)"""


def query(*parts: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select
