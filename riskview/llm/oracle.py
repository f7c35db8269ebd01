"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format(text='text')} AS ws FROM documents),
     win AS (SELECT r, unnest(range(1, len(ws) - 33)) AS i, ws FROM w),
     seqs AS (SELECT r, i, list_slice(ws, i, i + 34) AS s FROM win),
     again AS (SELECT s FROM seqs GROUP BY s HAVING count(*) > 1),
     hits AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM seqs SEMI JOIN again USING (s)),
     word AS (SELECT doc_id, r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
     kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
              FROM word ANTI JOIN hits USING (r, i) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""

_HOST = r"translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(regexp_extract(rest, '(?s)^([^?#]*)', 1), '(?s)^[^/]*(.*)$', 1)"

OP10 = rf"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
     u AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM p),
     rules(rule, rhost, rpath, verdict) AS (VALUES
       ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
       ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
       ('com/de/', 'com', '/de/', 'block')),
     fit AS (SELECT page_id, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict
             FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
             GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN contains(host || path, 'spam-') OR contains(host || path, 'cheap-pills')
                                OR contains(host || path, 'casino') OR ends_with(path, '.exe') OR ends_with(path, '.zip')
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit USING (page_id)
"""

OP3 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP6 = rf"""
WITH RECURSIVE w AS (
       SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
       FROM documents),
     sh AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
              ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END)) AS s FROM w),
     cls AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM sh WHERE len(s) > 0 GROUP BY s),
     item AS (SELECT c, n, unnest(s) AS g FROM cls),
     pairs AS (SELECT a.c AS x, b.c AS y, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k
              FROM item a JOIN item b ON a.g = b.g AND a.c < b.c GROUP BY a.c, b.c),
     link AS (SELECT x, y FROM pairs WHERE 100 * k >= 85 * (m + n - k)),
     edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
     reach(x, y) AS (SELECT x, y FROM edge UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x),
     comp AS (SELECT c, least(c, coalesce(min(y), c)) AS component_id FROM cls LEFT JOIN reach ON x = c GROUP BY c)
SELECT doc_id, len(sh.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM sh LEFT JOIN cls ON sh.s = cls.s LEFT JOIN comp USING (c)
"""

OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS.format(text='text')} AS ws FROM documents),
     l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
     least_id AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
     f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                  [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
                   100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t), regexp_matches(t, '[#$%&*|]'),
                   coalesce(d.doc_id > m, false)] AS fails
           FROM d JOIN least_id USING (t) LEFT JOIN l USING (doc_id)),
     g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
     one AS (SELECT unnest(range(1, 6)) AS i),
     orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM one a, one b, one c, one d, one e
                WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
     steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
     r AS (SELECT part, o, step, n, good, toxic, fails[o[step]] AS fail,
                  list_bool_or(list_transform(o[1:step - 1], lambda j: fails[j])) AS gone,
                  len(list_filter(fails, lambda x: x)) = 1 AS alone
           FROM g, steps),
     c AS (SELECT part, o, step, sum(n) FILTER (WHERE NOT coalesce(gone, false) AND NOT fail) AS kept,
                  sum(n) FILTER (WHERE NOT coalesce(gone, false) AND fail) AS removed,
                  sum(n) FILTER (WHERE gone AND fail) AS redundant, sum(n) FILTER (WHERE fail AND alone) AS unique_fails,
                  sum(good) FILTER (WHERE NOT coalesce(gone, false) AND fail) AS good_lost,
                  sum(toxic) FILTER (WHERE NOT coalesce(gone, false) AND fail) AS toxic_lost
           FROM r GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda j: substr('ABCDE', j, 1)), '') AS filter_order, step::INTEGER AS step,
       coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, o[step]), 0)::BIGINT AS shapley
FROM c
"""

OP13 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
     ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                              AND len(list_filter(e, lambda x: x <> 0)) > 0),
     link AS (SELECT a.r AS x, b.r AS y FROM ok a JOIN ok b ON a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
     reach(x, y) AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
     n AS (SELECT x AS r, count(*) AS n FROM link GROUP BY x),
     c AS (SELECT x AS r, min(vec_id) AS c FROM reach JOIN v ON v.r = reach.y GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c, vec_id)) AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN c USING (r)
"""

ORACLES = {"op11_filter_audit": OP11, "op13_metric_join": OP13, "op6_chosen_path": OP6, "op3_exact_topk": OP3, "op2_substring_dedup": OP2, "op10_url_rules": OP10}
