"""SQL for the training-text queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "p2_found": r"""
        SELECT id, CASE WHEN max(len(regexp_extract(content, '[^ \t\r\n]{1000}[^ \t\r\n]{1000}[^ \t\r\n]{1000}[^ \t\r\n]{1000}[^ \t\r\n]'))) > 0 THEN 'forced' ELSE 'boundary' END AS cut
        FROM extract_context WHERE length(content) > 4000 GROUP BY id""",
    "p8_found": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
             i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
             dg AS (SELECT doc_id, list_slice(w, k, k + 12) AS g FROM d, unnest(range(1, len(w) - 11)) AS u(k) WHERE len(w) >= 13),
             ig AS (SELECT DISTINCT item_id, list_slice(w, k, k + 12) AS g FROM i, unnest(range(1, len(w) - 11)) AS u(k) WHERE len(w) >= 13)
        SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
    "p8_report": r"""
        WITH d AS (SELECT DISTINCT doc_id, text FROM documents), dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM d),
             i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
             dg AS (SELECT doc_id, k, list_slice(w, k, k + 12) AS g FROM dw, unnest(range(1, len(w) - 11)) AS u(k) WHERE len(w) >= 13),
             ig AS (SELECT item_id, k, list_slice(w, k, k + 12) AS g FROM i, unnest(range(1, len(w) - 11)) AS u(k) WHERE len(w) >= 13),
             m AS (SELECT DISTINCT doc_id, item_id, dg.k - ig.k AS diag, ig.k AS k FROM dg JOIN ig USING (g)),
             r AS (SELECT doc_id, item_id, diag, k - row_number() OVER (PARTITION BY doc_id, item_id, diag ORDER BY k) AS island FROM m),
             n AS (SELECT doc_id, item_id, count(*) + 12 AS run FROM r GROUP BY doc_id, item_id, diag, island)
        SELECT item_id, count(DISTINCT doc_id) AS n_docs, max(run) AS most_words FROM n GROUP BY item_id""",
    "p2_whole": """
        SELECT id, coalesce(length(content), 0)::BIGINT AS n_chars, md5(content) AS content_md5, true AS fits, true AS laps FROM (SELECT DISTINCT id, content FROM extract_context)""",
    "p10_found": """
        WITH w AS (SELECT DISTINCT doc_id, md5(substr(text, k, 300)) AS h FROM documents, unnest(range(1, length(text) - 298)) AS u(k) WHERE length(text) >= 300)
        SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM w a JOIN w b ON a.h = b.h AND a.doc_id < b.doc_id""",
    "p10_shared": """
        WITH t AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 300),
             m AS (SELECT doc_id, text, n, min(doc_id) OVER (PARTITION BY text) AS class_id, count(*) OVER (PARTITION BY text) AS n_copies FROM t),
             w AS (SELECT doc_id AS class_id, k, md5(substr(text, k, 300)) AS h FROM m, unnest(range(1, n - 298)) AS u(k) WHERE doc_id = class_id),
             g AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT class_id) > 1),
             s AS (SELECT w.* FROM w JOIN g USING (h)),
             l AS (SELECT a.class_id, count(DISTINCT b.class_id) AS n_linked FROM s a JOIN s b ON a.h = b.h AND a.class_id != b.class_id GROUP BY a.class_id),
             c AS (SELECT class_id, sum(least(300, coalesce(nxt - k, 300)))::BIGINT AS n_shared FROM (SELECT class_id, k, lead(k) OVER (PARTITION BY class_id ORDER BY k) AS nxt FROM s) GROUP BY class_id)
        SELECT doc_id, class_id, n_copies, coalesce(n_linked, 0) AS n_linked, n AS n_chars, CASE WHEN n_copies > 1 THEN n ELSE coalesce(n_shared, 0) END AS n_shared,
               (CASE WHEN n_copies > 1 THEN n ELSE coalesce(n_shared, 0) END) / n::DOUBLE AS share FROM m LEFT JOIN l USING (class_id) LEFT JOIN c USING (class_id)""",
    "p4_found": r"""
        WITH RECURSIVE u AS (
            SELECT disc_id, title, try_strptime(publication_date, '%Y-%m-%d')::DATE AS d, regexp_replace(regexp_replace(trim(url), '^([A-Za-z][A-Za-z0-9+.\-]*:)?//', ''), '#.*$', '') AS r FROM discovered WHERE trim(coalesce(url, '')) != ''),
        v AS (SELECT disc_id, title, d, regexp_replace(regexp_replace(regexp_replace(lower(split_part(split_part(r, '?', 1), '/', 1)), ':\d*$', ''), '^.*@', ''), '^(www\d?|m|mobile|amp)\.', '') AS site,
                     regexp_replace(regexp_replace(url_decode(regexp_extract(split_part(r, '?', 1), '^[^/]*/(.*)$', 1)), '/{2,}', '/', 'g'), '(/+(amp|print|index\.(html?|php)|amp\.html))?/*$', '', 'i') AS path,
                     array_to_string(list_sort(list_filter(string_split(regexp_extract(r, '\?(.*)$', 1), '&'), lambda x: x != '' AND NOT regexp_matches(x, '^(utm_\w+|fbclid|gclid|ref|cmp|session)=', 'i'))), '&') AS q FROM u),
        k AS (SELECT disc_id, 'p' || site || '/' || path || '&' || q AS page, CASE WHEN d IS NOT NULL AND trim(coalesce(title, '')) != '' THEN 'h' || site || chr(9) || lower(regexp_replace(trim(title), '\s+', ' ', 'g')) || chr(9) || d END AS head FROM v),
        f AS (SELECT x, min(disc_id) AS m FROM (SELECT page AS x, disc_id FROM k UNION ALL SELECT head, disc_id FROM k WHERE head IS NOT NULL) GROUP BY x),
        e AS (SELECT DISTINCT page AS a, head AS b FROM k WHERE head IS NOT NULL),
        n AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
        reach(x, y) AS (SELECT x, x FROM f UNION SELECT reach.x, n.b FROM reach JOIN n ON reach.y = n.a),
        root AS (SELECT reach.x, min(f.m) AS first_disc_id FROM reach JOIN f ON reach.y = f.x GROUP BY reach.x)
        SELECT first_disc_id, disc_id FROM k JOIN root ON k.page = root.x WHERE first_disc_id < disc_id""",
}
