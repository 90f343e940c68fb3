"""SQL that the queries must agree with, for DuckDB, over the same tables."""

from __future__ import annotations

from civiclake.llm.urls import DAMPING, LINK, ROUNDS, RULES, THRESHOLD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ascii_lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _alnum_words(text: str) -> str:
    return rf"regexp_extract_all({_ascii_lower(f'coalesce({text}, {chr(39) * 2})')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {_alnum_words("text")} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_alnum_words("text")} AS ws FROM benchmark),
b2 AS (SELECT item, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
b3 AS (SELECT item, ws, k, unnest(range(len(ws) - k + 1)) AS i FROM b2),
bw AS (SELECT DISTINCT item, k, array_to_string(ws[i + 1 : i + k], ' ') AS p FROM b3),
sizes AS (SELECT DISTINCT k FROM bw),
d2 AS (SELECT rid, ws, k, unnest(range(greatest(len(ws) - k + 1, 0))) AS i FROM w, sizes),
hits AS (SELECT rid, i, d2.k, item FROM d2 JOIN bw ON d2.k = bw.k AND array_to_string(ws[i + 1 : i + d2.k], ' ') = p),
spread AS (SELECT rid, unnest(range(i, i + k)) AS x FROM hits),
n AS (SELECT rid, count(DISTINCT x) AS c FROM spread GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item) AS c, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.c, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(it.c, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256, coalesce(n.c, 0) > 0 AS contaminated
FROM w LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT rid, doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n, unnest(range(length(h) // 2)) AS i FROM d),
s AS (SELECT rid, doc_id, i, CASE WHEN i <= n - 50 THEN substr(h, 2 * i + 1, 100) END AS x, substr(h, 2 * i + 1, 2) AS b FROM b),
f AS (SELECT x, min(doc_id) AS first_id FROM s WHERE x IS NOT NULL GROUP BY x),
m AS (SELECT s.rid, s.i, s.b, coalesce(f.first_id < s.doc_id, false) AS hit FROM s LEFT JOIN f ON s.x = f.x),
c AS (SELECT rid, i, b, bool_or(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM m),
l AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), false) AS was FROM c),
r AS (SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT was) AS n_spans,
  string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept FROM l GROUP BY rid)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (rid)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
b AS (SELECT rid, doc_id, ws, unnest(range(len(ws))) AS i FROM d),
s AS (SELECT rid, doc_id, i, ws[i + 1] AS word, CASE WHEN i <= len(ws) - 50 THEN array_to_string(ws[i + 1 : i + 50], ' ') END AS x FROM b),
f AS (SELECT x, min(doc_id) AS first_id FROM s WHERE x IS NOT NULL GROUP BY x),
m AS (SELECT s.rid, s.i, s.word, coalesce(f.first_id < s.doc_id, false) AS hit FROM s LEFT JOIN f ON s.x = f.x),
c AS (SELECT rid, i, word, bool_or(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM m),
r AS (SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (rid)
"""


def _host(url: str) -> str:
    return _ascii_lower(rf"regexp_extract({_after(url)}, '^[^/?#]*', 0)")


def _after(url: str) -> str:
    return f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"


def _rule_cases(value: int) -> str:
    """The longest rule first; ``value`` picks the action (0) or the rule (1)."""
    cases = []
    for rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        name, _, path = rule[1].partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{path}')"
        cases.append(f"WHEN {fits} THEN '{rule[value]}'")
    return f"CASE {' '.join(cases)} END"


def _url_filter() -> str:
    link = LINK.replace("'", "''")
    own = 1 - DAMPING
    parts = [
        f"""p AS MATERIALIZED (SELECT page_id, html, {_host("url")} AS host,
  regexp_extract({_after("url")}, '^[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
        f"j AS MATERIALIZED (SELECT *, {_rule_cases(1)} AS rule, {_rule_cases(0)} AS action FROM p)",
        f"""raw AS (SELECT host AS source, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS link FROM p)""",
        f"""targets AS (SELECT source, {_host("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS target FROM raw)""",
        """e AS MATERIALIZED (SELECT source, target, count(*) AS weight FROM targets
  WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL)""",
        "fw AS MATERIALIZED (SELECT source AS s, target AS t, weight / sum(weight) OVER (PARTITION BY source) AS share FROM e)",
        "bw AS MATERIALIZED (SELECT target AS s, source AS t, weight / sum(weight) OVER (PARTITION BY target) AS share FROM e)",
        """n AS MATERIALIZED (SELECT host, max(a) AS a, max(b) AS b FROM (
  SELECT host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END) AS b
  FROM j GROUP BY host UNION ALL SELECT source, 0.0, 0.0 FROM e UNION ALL SELECT target, 0.0, 0.0 FROM e) GROUP BY host)""",
        f"r0 AS MATERIALIZED (SELECT host, {own} * a AS trust, {own} * b AS distrust FROM n)",
    ]
    for k in range(ROUNDS):
        parts.append(
            f"""r{k + 1} AS MATERIALIZED (SELECT n.host, {own} * a + coalesce(x.v, 0) AS trust, {own} * b + coalesce(y.v, 0) AS distrust FROM n
  LEFT JOIN (SELECT t, {DAMPING} * sum(trust * share) AS v FROM fw JOIN r{k} ON s = host GROUP BY t) x ON x.t = n.host
  LEFT JOIN (SELECT t, {DAMPING} * sum(distrust * share) AS v FROM bw JOIN r{k} ON s = host GROUP BY t) y ON y.t = n.host)"""
        )
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT page_id, j.host, path, rule, coalesce(action, CASE WHEN distrust - trust >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN r{ROUNDS} r ON j.host = r.host
"""
    )


URL_FILTER = _url_filter()

CHAT = r"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id AS c, CAST(turn AS BIGINT) AS t, role AS r, coalesce(text, '') AS x FROM conversations),
s AS (SELECT rid, c, t, string_split(x, chr(10)) AS ls FROM m),
ln AS (SELECT rid, c, t, generate_subscripts(ls, 1) AS p, unnest(ls) AS line FROM s),
lv AS (SELECT *, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), '[ \t]', '', 'g')) AS lev,
  regexp_replace(line, '^((?:[ \t]*>)+)', '') AS bare FROM ln),
per AS (SELECT rid, count(*) FILTER (lev > 0) AS n_quoted, max(lev) AS quote_depth,
  trim(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (lev = 0), '')) AS own_text FROM lv GROUP BY rid),
runs AS (SELECT *, p - row_number() OVER (PARTITION BY rid, lev ORDER BY p) AS run FROM lv),
wide AS (SELECT rid, c, t, lev, string_agg(bare, ' ' ORDER BY p) AS body FROM runs GROUP BY rid, c, t, lev, run HAVING count(*) > 1),
raw AS (SELECT c, t, lev, bare AS u FROM lv UNION ALL SELECT c, t, lev, unnest(string_split_regex(body, '[.!?]+')) FROM wide),
un AS (SELECT c, t, lev, trim(regexp_replace(lower(u), '[^\p{L}\p{N}]+', ' ', 'g')) AS nl FROM raw WHERE c IS NOT NULL AND t IS NOT NULL),
o AS (SELECT DISTINCT c, t, nl FROM un WHERE lev = 0 AND nl <> ''),
q AS (SELECT c, t, lev, nl, count(*) AS n FROM un WHERE lev > 0 AND nl <> '' GROUP BY ALL),
lk AS (SELECT q.c, q.t, q.lev, q.nl, q.n, max(o.t) AS source FROM q JOIN o ON o.c = q.c AND o.nl = q.nl AND o.t < q.t GROUP BY ALL),
ps AS (SELECT c, t, lev, source, sum(n) AS n FROM lk GROUP BY ALL),
rp AS (SELECT c, t, source AS quoted_turn, sum(n) OVER (PARTITION BY c, t) AS n_linked FROM ps
  QUALIFY row_number() OVER (PARTITION BY c, t ORDER BY lev, n DESC, source DESC) = 1),
pv AS (SELECT c, t, lag(t) OVER (PARTITION BY c ORDER BY t) AS previous FROM (SELECT DISTINCT c, t FROM m WHERE c IS NOT NULL AND t IS NOT NULL)),
rt AS (SELECT pv.c, pv.t, coalesce(quoted_turn, previous) AS reply_to, coalesce(n_linked, 0) AS n_linked FROM pv LEFT JOIN rp ON rp.c = pv.c AND rp.t = pv.t),
fc AS (SELECT *, row_number() OVER (PARTITION BY c, reply_to ORDER BY t) = 1 AS goes_on FROM rt),
tree AS (SELECT c, t, t AS thread, t AS branch FROM fc WHERE reply_to IS NULL
  UNION ALL SELECT fc.c, fc.t, tree.thread, CASE WHEN goes_on THEN tree.branch ELSE fc.t END FROM fc JOIN tree ON fc.c = tree.c AND fc.reply_to = tree.t)
SELECT m.c AS conv_id, m.t AS turn, m.r AS role, rt.reply_to, tree.thread, tree.branch, CAST(n_quoted AS BIGINT) AS n_quoted,
  CAST(quote_depth AS BIGINT) AS quote_depth, CAST(coalesce(rt.n_linked, 0) AS BIGINT) AS n_linked, own_text,
  '<|' || coalesce(m.r, 'user') || '|>' || chr(10) || own_text || chr(10) AS formatted
FROM m JOIN per USING (rid) LEFT JOIN rt ON rt.c = m.c AND rt.t = m.t LEFT JOIN tree ON tree.c = m.c AND tree.t = m.t
"""


FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, d.doc_id,
    CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
st AS (SELECT o, s, CAST(pow(2, ascii(substr(o, s, 1)) - 65) AS INTEGER) AS own,
    CAST(list_sum(list_transform(range(1, s), lambda i: pow(2, ascii(substr(o, i, 1)) - 65))) AS INTEGER) AS prior
  FROM (SELECT o, unnest(range(1, 6)) AS s FROM orders)),
r AS (SELECT part, o, s, own,
    sum(CASE WHEN mask & (own | coalesce(prior, 0)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM st, cells GROUP BY part, o, s, own)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""
