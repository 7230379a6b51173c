"""DuckDB SQL for the rows of ``op11_filter_audit``."""

SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
least AS (SELECT t, min(doc_id) AS first_id FROM words GROUP BY t),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
flags AS (
  SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_extract_all(w.t, '[A-Z]')) > 10 * length(w.t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN w.doc_id > l.first_id THEN 'E' ELSE '' END) AS fails
  FROM words w JOIN least l ON w.t = l.t LEFT JOIN marks m ON w.doc_id = m.doc_id),
grouped AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, filter_order[step:step] AS own, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
rows AS (
  SELECT g.part, s.filter_order, s.step, s.own, g.n, g.good, g.toxic, g.fails,
         contains(g.fails, s.own) AS hit,
         regexp_matches(g.fails, '[' || s.earlier || '_]') AS gone
  FROM grouped g, steps s),
totals AS (
  SELECT part, filter_order, step, any_value(own) AS own,
         sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END) AS toxic_lost
  FROM rows GROUP BY part, filter_order, step),
over_all AS (SELECT part, own, sum(removed) AS shapley FROM totals GROUP BY part, own)
SELECT t.part, t.filter_order, CAST(t.step AS INTEGER) AS step, CAST(t.kept AS BIGINT) AS kept,
       CAST(t.removed AS BIGINT) AS removed, CAST(t.redundant AS BIGINT) AS redundant,
       CAST(t.unique_fails AS BIGINT) AS unique_fails, CAST(t.good_lost AS BIGINT) AS good_lost,
       CAST(t.toxic_lost AS BIGINT) AS toxic_lost, CAST(o.shapley AS BIGINT) AS shapley
FROM totals t JOIN over_all o ON t.part = o.part AND t.own = o.own
"""
