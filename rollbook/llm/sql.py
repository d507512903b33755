"""The same results in DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

STATEMENTS: dict[str, str] = {
    "op7_url_filters": """
WITH parsed AS (
    SELECT page_id, coalesce(url, '') AS url,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
           coalesce(regexp_extract(url, '://[^/?#]*(.*)', 1, 's'), '') AS tail
    FROM pages
), rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), ranked AS (
    SELECT p.page_id, p.url, p.host, p.path, r.host || r.path AS rule, r.verdict,
           CASE WHEN contains(p.url, '://') THEN '://' || p.host || p.tail ELSE p.url END AS subject,
           row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS place
    FROM parsed p LEFT JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
         AND contains(p.url, '://')
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict
            WHEN regexp_matches(subject, '^://([^/?#]*[.-])?(ads|adult|bets|betting|casino|pills|poker|porn|spam|warez)[.-]')
              OR regexp_matches(subject, '^://[^/?#]*/([^?#]*/)?(login|signin|cart|checkout)([/?#.]|$)')
              OR regexp_matches(subject, '[?&](sessionid|phpsessid|sid)=') THEN 'block'
            ELSE 'allow' END AS verdict
FROM ranked WHERE place = 1
""",
    "op8_line_dedup": """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keep_id FROM keyed
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), flagged AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keep_id AS lost
    FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
""",
    "op9_exact_dedup": """
WITH rows AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text) AS kept,
       sha256(text) AS text_sha256
FROM rows
""",
}
