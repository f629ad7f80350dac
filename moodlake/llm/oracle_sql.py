"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP3 = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5"""

OP11 = """WITH rules(r_host, r_path, r_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (SELECT row_number() OVER () AS n, page_id,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
f AS (SELECT n, page_id, host, path, r_host || r_path AS rule, r_verdict FROM p LEFT JOIN rules
  ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(r_host || r_path) DESC NULLS LAST, length(r_host) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM f"""

# Forward dynamic programming over whole audit strings, one turn a step.
OP12 = """WITH RECURSIVE ids AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
lucky AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384::BIGINT * (d & 1)))),
    4294967295::BIGINT) % 20 AS luck FROM ids),
hurt AS (SELECT conv_id, turn, CASE WHEN luck = 4 THEN 'user' ELSE role END AS role,
         CASE luck WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM lucky, range(CASE luck WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
convs AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
h AS (SELECT c, turn, role, text, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST) AS copy,
         right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) AS tail
  FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM h),
f AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate'
         WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         ini || lead(ini) OVER (PARTITION BY c ORDER BY i) AS pair FROM o),
ins(x, k, y, lines) AS (VALUES (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
  (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (3, 1, 2, ['user:']), (2, 1, 3, ['assistant:']),
  (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']), (3, 2, 3, ['user:', 'assistant:']),
  (2, 2, 2, ['assistant:', 'user:'])),
say(y, ini, z) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edit(y, letter, ini, z, price) AS (
  SELECT y, 'D', NULL, y, 2 FROM (VALUES (0), (1), (2), (3)) t(y)
  UNION ALL SELECT y, 'K', ini, z, 0 FROM say UNION ALL SELECT y, 'R', ini, z, 1 FROM say WHERE ini <> 's'),
dp(c, i, state, best) AS (
  SELECT c, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} FROM convs
  UNION ALL
  SELECT c, i, z, min(best) FROM (
    SELECT f.c, f.i, edit.z, {'cost': best.cost + 5 * k + price + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
      'audit': best.audit || repeat('I', k) || letter,
      'lines': list_concat(best.lines, ins.lines, CASE letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
               ELSE [CASE edit.ini WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END)} AS best
    FROM dp JOIN f ON f.c = dp.c AND f.i = dp.i + 1 JOIN ins ON ins.x = dp.state JOIN edit ON edit.y = ins.y
    WHERE letter = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (letter = 'R' OR edit.ini = f.ini))) GROUP BY c, i, z),
sums AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c),
fin AS (SELECT convs.c, conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    min({'cost': best.cost + 5 * k, 'audit': best.audit || repeat('I', k), 'lines': list_concat(best.lines, ins.lines)}) AS best
  FROM convs LEFT JOIN sums USING (c) JOIN dp ON dp.c = convs.c AND dp.i = coalesce(n, 0)
  JOIN ins ON ins.x = dp.state AND ins.y IN (0, 3) GROUP BY ALL)
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(best.cost AS BIGINT) AS cost,
  best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256 FROM fin"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """One common table expression per codebook and per assignment."""
    square = "list_sum(list_transform(list_zip(x.v, b.e), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    sql = [f"""sized AS (SELECT vec_id, label, embedding, len(embedding) AS w,
    count(*) OVER (PARTITION BY len(embedding)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM sized
  WHERE w = (SELECT w FROM sized ORDER BY c DESC, w DESC LIMIT 1))""",
           f"""x AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v
  FROM kept, range({parts}) t(p))""",
           f"""b0 AS MATERIALIZED (SELECT x.p, s.j, x.v AS e FROM x JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS j
  FROM kept QUALIFY row_number() OVER (ORDER BY vec_id NULLS LAST, v) <= {entries}) s USING (r))"""]
    for i in range(rounds + 1):
        sql.append(f"""a{i} AS MATERIALIZED (SELECT x.r, x.p, min({{'d': CAST({square} AS BIGINT), 'j': b.j}}) AS m
  FROM x JOIN b{i} b ON b.p = x.p GROUP BY x.r, x.p)""")
        if i < rounds:
            sql.append(f"""s{i} AS (SELECT p, j, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY pos) AS e FROM (
    SELECT a.p, a.m.j AS j, pos, sum(x.v[pos]) AS s, count(*) AS n FROM a{i} a JOIN x ON x.r = a.r AND x.p = a.p,
      range(1, len(x.v) + 1) t(pos) GROUP BY ALL) GROUP BY p, j),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.j, coalesce(s.e, b.e) AS e FROM b{i} b LEFT JOIN s{i} s ON s.p = b.p AND s.j = b.j)""")
    return "WITH " + ",\n".join(sql) + f""",
coded AS (SELECT r, string_agg(printf('%02x', m.j), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), book"""


def queries_sql() -> dict[str, str]:
    return {"op3_top_k": OP3, "op11_url_filters": OP11, "op12_conversation_repair": OP12, "op13_vector_codes": _op13()}
