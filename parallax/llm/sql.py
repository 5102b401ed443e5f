"""DuckDB SQL for those operators that SQL can express, from their contracts and by other means than the operators'.

The pairs and windows are all built here, so it is for small tables. The identifiers of a table are taken as unique.
"""

from __future__ import annotations

from parallax.llm.rules import LEAST_VALUES, METRICS, WHERE_ANY

WORD = r"[^\x20\x09-\x0D]+"

#: Every node of `links(a, b)`, both directions given, with all nodes it reaches.
REACH = """reach(a, b) AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

#: 100-byte windows as hexadecimal text; spans are joined runs of windows that start earlier, too.
REPEATS = """
WITH docs AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS i FROM docs)),
firsts AS (SELECT s, min({'d': doc_id, 'i': i}) AS f FROM windows GROUP BY s HAVING count(*) > 1),
later AS (SELECT w.doc_id, w.i FROM windows w JOIN firsts USING (s) WHERE {'d': w.doc_id, 'i': w.i} > f),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS lo, a AS hi FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * lo + 1, coalesce(2 * hi, len(h)) - 2 * lo), '' ORDER BY lo) AS k
  FROM gaps g JOIN docs USING (doc_id) GROUP BY g.doc_id),
counts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM docs LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

VECTORS = f"""
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
pairs AS MATERIALIZED (
  SELECT p.vec_id AS a, q.vec_id AS b FROM vectors p JOIN vectors q ON p.vec_id < q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.9),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{REACH},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN counts c ON c.a = vec_id LEFT JOIN least l ON l.a = vec_id
"""

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY ALL),
pairs AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{REACH},
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""


def rules(spread: float = 6.0) -> str:
    """Fences by exact quartiles, which those of the sketches are in groups of under about 5,000 values."""
    metrics = list(METRICS)
    of = {m: f"CASE WHEN {m} > 0 THEN {m} END" if m in WHERE_ANY else m for m in metrics}
    quartiles = ", ".join(f"quantile_disc({of[m]}, 0.25) AS low_{m}, quantile_disc({of[m]}, 0.75) AS high_{m}, count({of[m]}) AS n_{m}" for m in metrics)
    levels = ("own", "by_lang", "by_source", "whole")

    def fence(m: str) -> str:
        enough = [f"{k}.n_{m} >= {LEAST_VALUES}" for k in levels[:3]] + ["TRUE"]
        quartile = ", ".join(f"CASE WHEN {e} THEN {k}.high_{m} END" for e, k in zip(enough, levels))
        distance = ", ".join(f"CASE WHEN {e} AND {k}.high_{m} > {k}.low_{m} THEN {k}.high_{m} - {k}.low_{m} END" for e, k in zip(enough, levels))
        return f"coalesce({quartile}, 0) + greatest({spread} * coalesce({distance}, 0), {METRICS[m]}) AS most_{m}"

    within = " AND ".join(f"coalesce({m} <= most_{m}, FALSE)" for m in metrics)
    return f"""
WITH words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{WORD}')] AS l FROM documents),
windows AS (SELECT r, i, array_to_string(w[i : i + 2], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r),
counts AS MATERIALIZED (
  SELECT doc_id, lang, source, len(w) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines, len(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals
  FROM words LEFT JOIN covered USING (r)),
measured AS MATERIALIZED (
  SELECT *, coalesce(CAST(n_symbols AS DOUBLE) / nullif(word_chars, 0), 0) AS symbols, coalesce(CAST(n_dup_lines AS DOUBLE) / nullif(n_lines, 0), 0) AS dup_lines,
    coalesce(CAST(n_repeat_words AS DOUBLE) / nullif(n_words, 0), 0) AS repeats, coalesce(CAST(word_chars AS DOUBLE) / nullif(n_words, 0), 0) AS word_length,
    coalesce(CAST(n_capitals AS DOUBLE) / nullif(word_chars, 0), 0) AS capitals, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counts),
quartiles AS MATERIALIZED (
  SELECT lang, source, grouping(lang, source) AS level, {quartiles} FROM measured WHERE NOT base_failed GROUP BY CUBE (lang, source)),
fences AS (
  SELECT own.lang AS g_lang, own.source AS g_source, {", ".join(fence(m) for m in metrics)}
  FROM (FROM quartiles WHERE level = 0) own
  LEFT JOIN (FROM quartiles WHERE level = 1) by_lang ON by_lang.lang IS NOT DISTINCT FROM own.lang
  LEFT JOIN (FROM quartiles WHERE level = 2) by_source ON by_source.source IS NOT DISTINCT FROM own.source
  CROSS JOIN (FROM quartiles WHERE level = 3) whole)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {within} AS kept
FROM measured LEFT JOIN fences ON lang IS NOT DISTINCT FROM g_lang AND source IS NOT DISTINCT FROM g_source
"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEARCH = f"""
WITH terms AS MATERIALIZED (
  SELECT r, doc_id, unnest(t) AS term, len(t) AS n FROM (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS t FROM documents)),
items AS (
  SELECT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
asked AS MATERIALIZED (SELECT q, item_id, term, count(*) AS times FROM items GROUP BY ALL),
whole AS MATERIALIZED (SELECT count(DISTINCT r) AS n_docs, count(*) AS n_terms FROM terms),
counted AS MATERIALIZED (SELECT r, doc_id, term, n, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, whole GROUP BY term, n_docs),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weighed USING (term), whole GROUP BY ALL)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0) WHERE place <= 20
"""


def _cheapest(*ways: str) -> str:
    """The least of structs of cost, edits and lines."""
    return f"list_sort([{', '.join(ways)}])[1]"


def _more(lane: str, cost: str, edit: str, line: str = "") -> str:
    lines = f"list_append({lane}.t, {line})" if line else f"{lane}.t"
    return f"{{'c': {lane}.c + {cost}, 'a': {lane}.a || '{edit}', 't': {lines}}}"


def _open(lane: str) -> str:
    """The expressions of the four lanes (nothing, s, u, a) when turns may be inserted first."""
    user, assistant = "'user:'", "'assistant:'"
    return f"{lane}.b AS b, {lane}.s AS s, {_cheapest(f'{lane}.u', *(_more(f'{lane}.{x}', '5', 'I', user) for x in 'bsa'))} AS u, {_cheapest(f'{lane}.a', *(_more(_more(f'{lane}.{x}', '5', 'I', user), '5', 'I', assistant) for x in 'bs'), _more(f'{lane}.u', '5', 'I', assistant))} AS a"


def turns() -> str:
    """Damage by a CRC-32 written out, and a search forward with the cheapest edits of each state."""
    never = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"
    same, made = "r.role || ':' || r.text", {"u": "'user:' || r.text", "a": "'assistant:' || r.text"}
    extra = "CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END"

    def to(state: str, froms: str, initial: str) -> str:
        ways = [_more(f"o.{state}", "2", "D")]
        ways += [f"CASE WHEN r.fault NOT IN ('blank', 'duplicate') AND left(r.role, 1) = '{initial}' THEN {_more(f'o.{x}', extra, 'K', same)} ELSE {_more(f'o.{state}', '2', 'D')} END" for x in froms]
        if state in made:
            ways += [f"CASE WHEN r.fault NOT IN ('blank', 'duplicate') THEN {_more(f'o.{x}', f'1 + {extra}', 'R', made[state])} ELSE {_more(f'o.{state}', '2', 'D')} END" for x in froms]
        return _cheapest(*ways)

    return rf"""
WITH RECURSIVE crcs AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)), lambda c, b: xor(c >> 8, crcs.t[(xor(c, b) & 255) + 1]))) % 20 AS d
  FROM conversations, crcs),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM drawn)),
placed AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k FROM damaged),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY k) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY g ORDER BY k) || left(role, 1) AS pair
  FROM placed),
walk AS (
  SELECT g, 0::BIGINT AS k, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS b, {never} AS s, {never} AS u, {never} AS a FROM (SELECT DISTINCT g FROM placed)
  UNION ALL SELECT o.g, r.k, {_more('o.b', '2', 'D')}, {to('s', 'b', 's')}, {to('u', 'bsa', 'u')}, {to('a', 'u', 'a')}
  FROM (SELECT w.g, w.k, {_open('w')} FROM walk w) o JOIN judged r ON r.g = o.g AND r.k = o.k + 1),
ends AS (SELECT o.g, {_cheapest('o.b', 'o.a')} AS e FROM (SELECT w.g, {_open('w')} FROM walk w JOIN (SELECT g, max(k) AS k FROM placed GROUP BY g) m ON m.g = w.g AND m.k = w.k) o),
found AS (
  SELECT any_value(conv_id) AS conv_id, g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY g)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(array_to_string(e.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM i.conv_id AND f.g IS NOT NULL LEFT JOIN ends USING (g)
"""


ORACLE_SQL: dict[str, str] = {"op4_suffixes": REPEATS, "op5_vectors": VECTORS, "op8_rules": rules(), "op9_jaccard": JACCARD, "op11_search": SEARCH, "op12_turns": turns()}
