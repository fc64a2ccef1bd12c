"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from affinity.llm.license_scan import THRESHOLD, default_templates, seeds_of
from affinity.llm.secret_scan import BASE64, BASE_RULES, IS_BASE64, IS_OTHER, IS_SHORT, KEY_END, KEY_LINE, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH parts AS (
  SELECT page_id, url, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
site AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule,
  CASE
    WHEN ends_with(low, '/robots.txt') THEN '/robots.txt|'
    WHEN regexp_matches(low, '^[^:/?#]*://([^/?#]*\\.)?.*\\.gov([^0-9a-z_.%-]|$)', 's') THEN '||*.gov^'
    WHEN contains(low, '-bets.') THEN '-bets.'
    WHEN contains(low, '-casino.') THEN '-casino.'
    WHEN contains(low, '-pills.') THEN '-pills.'
    WHEN contains(low, '.casino-') THEN '.casino-'
    WHEN regexp_matches(low, '/cgi-bin/.*\\.exe$', 's') THEN '/cgi-bin/*.exe|'
    WHEN contains(low, '/wp-login.php') THEN '/wp-login.php'
    WHEN contains(low, '://casino-') THEN '://casino-'
    WHEN contains(low, '://spam-') THEN '://spam-'
    WHEN regexp_matches(low, '[^0-9a-z_.%-]sessionid=', 's') THEN '^sessionid='
    WHEN regexp_matches(low, '^[^:/?#]*://([^/?#]*\\.)?xxx\\.', 's') THEN '||xxx.'
  END AS pat
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN pat IS NULL OR pat IN ('/robots.txt|', '||*.gov^') THEN 'allow' ELSE 'block' END AS verdict,
  CASE WHEN rule IS NULL THEN pat END AS pattern
FROM site
"""



def _op5() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    each = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS k, {quoted(r.kind)} AS kind, {r.least} AS least, {i < len(BASE_RULES)} AS base, {r.tail is not None} AS tailed, "
        f"regexp_extract_all(t, {quoted(r.regex)}, 0) AS ms, regexp_extract_all(t, {quoted(r.regex)}, {r.group}) AS gs, "
        f"string_split_regex(t, {quoted(r.regex)}) AS ps FROM texts"
        for i, r in enumerate(RULES)
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
each AS ({each}),
numbered AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM each WHERE len(ms) > 0),
raw_spans AS (
  SELECT doc_id, k, kind, base,
    list_sum(list_transform(ps[1:i], lambda p: length(p)))
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0) AS a,
    length(ms[i]) AS m, CASE WHEN tailed THEN ps[i + 1] END AS rest
  FROM numbered WHERE length(gs[i]) >= least),
ended AS (
  SELECT *, CASE WHEN contains(rest, '-----') THEN strpos(rest, '-----') END AS h,
    CASE WHEN contains(rest, '-----') THEN regexp_extract(substr(rest, strpos(rest, '-----')), {quoted(KEY_END)}, 0) END AS e
  FROM raw_spans),
cut AS (SELECT *, CASE WHEN coalesce(e, '') = '' THEN regexp_extract_all(rest, {quoted(KEY_LINE)}, 0) END AS lines FROM ended),
begun AS (
  SELECT *, lines[1:coalesce(nullif(list_position(list_transform(lines,
    lambda x: regexp_matches(x, {quoted(IS_BASE64)}) OR regexp_matches(x, {quoted(IS_OTHER)})), false), 0) - 1, len(lines))] AS ok
  FROM cut),
closed AS (
  SELECT *, coalesce(list_max(list_transform(ok, lambda x, i: CASE WHEN regexp_matches(x, {quoted(IS_BASE64)}) THEN i ELSE 0 END)), 0) AS last
  FROM begun),
spans AS (
  SELECT doc_id, k, kind, base, a, m + CASE
    WHEN rest IS NULL THEN 0
    WHEN coalesce(e, '') <> '' THEN h - 1 + length(e)
    WHEN last = 0 THEN 0
    WHEN regexp_matches(coalesce(lines[last + 1], ''), {quoted(IS_SHORT)}) THEN
      list_sum(list_transform(lines[1:last], lambda x: length(x))) + length(regexp_extract(lines[last + 1], {quoted(IS_SHORT)}, 0))
    ELSE coalesce(list_sum(list_transform(lines[1:last - 1], lambda x: length(x))), 0)
      + length(regexp_extract(lines[last], {quoted(BASE64)}, 0)) END AS n
  FROM closed),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat_ws(':', kind, a::BIGINT, (a + n)::BIGINT), ',' ORDER BY a, k) FILTER (base) AS base,
    string_agg(concat_ws(':', kind, a::BIGINT, (a + n)::BIGINT), ',' ORDER BY a, k) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id
"""


def _op2() -> str:
    templates = sorted(default_templates(), key=lambda t: t.name)
    rows = ", ".join(f"({i}, '{t.name}', [{', '.join(f"'{a} {b}'" for a, b in t.bigrams)}])" for i, t in enumerate(templates))
    seeds = ", ".join(f"('{a} {b}', {k}, {q})" for (a, b), held in seeds_of(templates, THRESHOLD).items() for k, q in held)
    return f"""
WITH templates(k, name, grams) AS (VALUES {rows}),
seeds(gram, k, q) AS (VALUES {seeds}),
plain AS (
  SELECT doc_id, regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS t
  FROM documents),
cut AS (SELECT *, string_split_regex(t, '\\n\\s*\\n') AS paragraphs FROM plain),
passages AS (
  SELECT doc_id, unnest(list_concat(string_split(t, chr(10)), list_concat(
    list_transform(list_filter(paragraphs, lambda p: contains(p, chr(10))), lambda p: regexp_replace(p, '\\s+', ' ', 'g')),
    CASE WHEN len(paragraphs) > 1 THEN [regexp_replace(t, '\\s+', ' ', 'g')] ELSE [] END))) AS p FROM cut),
words AS (SELECT doc_id, row_number() OVER () AS id, string_split(trim(p), ' ') AS w FROM passages),
grams AS (
  SELECT doc_id, id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g
  FROM words WHERE len(w) > 1),
template_grams AS (
  SELECT k, name, b, gram, count(*) AS held
  FROM (SELECT k, name, len(grams) AS b, unnest(grams) AS gram FROM templates) GROUP BY ALL),
passage_grams AS (
  SELECT doc_id, id, n, gram, count(*) AS here
  FROM (SELECT doc_id, id, len(g) AS n, unnest(g) AS gram FROM grams) GROUP BY ALL),
met AS (
  SELECT doc_id, id, k, any_value(name) AS name, any_value(n) AS a, any_value(b) AS b, sum(least(here, held)) AS c
  FROM passage_grams JOIN template_grams USING (gram) GROUP BY doc_id, id, k),
dice AS (SELECT *, 2.0::DOUBLE * c / (a + b) AS d FROM met),
best AS (
  SELECT doc_id, id, name, k, d, b FROM dice WHERE d >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id, id ORDER BY d DESC, b DESC, k) = 1),
flat AS (SELECT doc_id, string_split(trim(regexp_replace(t, '\\s+', ' ', 'g')), ' ') AS w FROM plain),
whole AS MATERIALIZED (
  SELECT doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM flat WHERE len(w) > 1),
hits AS (SELECT doc_id, unnest(g) AS gram, generate_subscripts(g, 1) - 1 AS p, len(g) AS n FROM whole),
windows AS (
  SELECT DISTINCT doc_id, k, len(grams) AS b, greatest(0, least(p - q, n - len(grams))) AS s
  FROM hits JOIN seeds USING (gram) JOIN templates USING (k) WHERE n >= len(grams)),
window_grams AS (
  SELECT doc_id, k, s, gram, count(*) AS here
  FROM (SELECT doc_id, k, s, unnest(g[s + 1 : s + b]) AS gram FROM windows JOIN whole USING (doc_id)) GROUP BY ALL),
window_dice AS (
  SELECT doc_id, k, s, any_value(name) AS name, any_value(b) AS b, 2.0::DOUBLE * sum(least(here, held)) / (2 * any_value(b)) AS d
  FROM window_grams JOIN template_grams USING (k, gram) GROUP BY doc_id, k, s HAVING d >= {THRESHOLD}),
runs AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, b, k ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, CASE WHEN s >= coalesce(max(s + b) OVER (
    PARTITION BY doc_id ORDER BY s, b, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN 1 ELSE 0 END AS fresh
    FROM window_dice)),
notices AS (
  SELECT doc_id, name, k, d, b FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id, run ORDER BY d DESC, b DESC, k) = 1),
both_kinds AS (SELECT doc_id, name, k, d, b, 1 AS p, 0 AS w FROM best UNION ALL SELECT doc_id, name, k, d, b, 0, 1 FROM notices),
found AS (
  SELECT doc_id, first(name ORDER BY d DESC, b DESC, k) AS license, max(d) AS license_dice,
    CAST(sum(p) AS BIGINT) AS n_passages, CAST(sum(w) AS BIGINT) AS n_notices, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM both_kinds GROUP BY doc_id)
SELECT d.doc_id, license, license_dice, coalesce(n_passages, 0) AS n_license_passages,
  coalesce(n_notices, 0) AS n_license_notices, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id
"""


OP12 = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.r <> b.r
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS place
  FROM scored WHERE same QUALIFY place <= 5
), windows AS (
  SELECT p.anchor, s.anchor_id, p.place, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor = s.anchor
  WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
  QUALIFY rank <= 3
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows
"""


SQL = {
    "op2_license_scans": _op2(),
    "op5_secret_scans": _op5(),
    "op1_url_filters": OP1,
    "op12_hard_negatives": OP12,
}
