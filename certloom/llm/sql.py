"""DuckDB SQL for the queries that SQL can express, written from their contracts.

The other operators are tested against brute force (``tests/llm``): op3 and op6 need byte strings and
XXH64, op8 a tokenizer, and op1, op2, op4, op7 and op12 fit models or align.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP5 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS i FROM w)),
lead AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p FROM win JOIN lead USING (s) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN hit USING (doc_id, p)
         GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP9 = rf"""
WITH p AS (SELECT page_id, url,
             coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, b, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (SELECT p.url, p.host, p.path, max(struct_pack(n := length(h || b), r := h || b, v := v)) AS x
         FROM (SELECT DISTINCT url, host, path FROM p) p
         JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, b) GROUP BY ALL),
site AS (SELECT DISTINCT url, regexp_matches(regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.', ''),
             '^(casino-win|spam-farm|cheap-pills|free-bets|adult-x|ads-track)\.example\.(com|org|net)$') AS listed FROM p)
SELECT p.page_id, p.host, p.path, x.r AS rule, coalesce(listed, false) AS listed,
       coalesce(x.v, CASE WHEN listed THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN best ON p.url IS NOT DISTINCT FROM best.url
       LEFT JOIN site ON p.url IS NOT DISTINCT FROM site.url
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS s
       FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(range(1, greatest(len(ws) - 11, 2))) AS i
             FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 2, 1))) AS i
             FROM d, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT DISTINCT doc_id, i, n FROM dw SEMI JOIN bw USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS j FROM hit)
            GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM dw JOIN bw USING (n, s)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

OP11 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT item_id, x, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x
          FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d),
m AS (SELECT doc_id, 75 + ((25 * len(ws) * n_docs) // n_terms) AS m FROM d, s WHERE len(ws) > 0),
t AS (SELECT doc_id, x, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS x FROM d) SEMI JOIN q USING (x) GROUP BY ALL),
w AS (SELECT x, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT x, count(*) AS df FROM t GROUP BY x), s),
r AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN t USING (x) JOIN w USING (x) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 20
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (SELECT part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY t) AS e,
             coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
      FROM d LEFT JOIN labels USING (doc_id)),
g AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f GROUP BY ALL),
h AS (SELECT *, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
                || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails FROM g),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM l p, l q, l r, l s, l t
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
hit AS (SELECT part, filter_order, n, good, toxic, fails,
               (SELECT min(position(u.x IN filter_order)) FROM l u WHERE contains(fails, u.x)) AS hit_at FROM h, o),
z AS (SELECT part, filter_order, k AS step, substr(filter_order, k, 1) AS x,
             coalesce(sum(n) FILTER (hit_at IS NULL OR hit_at > k), 0) AS kept, coalesce(sum(n) FILTER (hit_at = k), 0) AS removed,
             coalesce(sum(n) FILTER (hit_at < k AND contains(fails, substr(filter_order, k, 1))), 0) AS redundant,
             coalesce(sum(n) FILTER (fails = substr(filter_order, k, 1)), 0) AS unique_fails,
             coalesce(sum(good) FILTER (hit_at = k), 0) AS good_lost, coalesce(sum(toxic) FILTER (hit_at = k), 0) AS toxic_lost
      FROM hit, (SELECT unnest(range(1, 6)) AS k) GROUP BY part, filter_order, k)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM z
"""

ORACLE_SQL = {"op5_substring_dedup": OP5, "op9_url_filters": OP9, "op10_benchmark_decontamination": OP10,
              "op11_ranked_lexical_search": OP11, "op13_filter_interaction_audit": OP13}
