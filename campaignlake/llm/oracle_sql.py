"""DuckDB SQL of the queries that SQL can express, written independently of the Spark code."""

from __future__ import annotations

from . import license_scan, quality_rules

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


MARKS = quality_rules.SENTENCE_MARKS.replace(r"\u037E", "\u037e")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, unnest(regexp_extract_all(text, '{WORD}')) AS w,
                 generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) AS i FROM d),
windows AS (SELECT r, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c
            FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
often AS (SELECT r, i FROM windows WHERE c IS NOT NULL
          QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
repeats AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM often) GROUP BY r),
all_lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
worded AS (SELECT r, i, line, regexp_extract_all(line, '{WORD}') AS ws FROM all_lines),
-- Lines with words between the same lines without: a paragraph.
lines AS (SELECT *, sum(CASE WHEN len(ws) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS para,
                 length(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13))) AS size FROM worded),
fitted AS (SELECT r, para, len(ws) AS n, size, len(regexp_extract_all(line, '{MARKS}')) AS marks,
                  max(size) OVER (PARTITION BY r, para) AS width,
                  size + 1 + length(lead(ws[1]) OVER (PARTITION BY r, para ORDER BY i)) AS needed
           FROM lines WHERE len(ws) > 0),
prose AS (SELECT r, para, count(*) >= 3 AND 40 * sum(marks) >= sum(n) AND bool_and(coalesce(needed > width, true)) AS prose
          FROM fitted GROUP BY r, para),
judged AS (
  SELECT r, line, ws, len(ws) AS n, prose,
         length(regexp_replace(line, '{SPACE}', '', 'g')) AS chars,
         len(list_filter(ws, lambda w: regexp_matches(w, '!!|\?\?'))) AS shouts,
         len(list_filter(ws, lambda w: regexp_matches(w, '{quality_rules.SYMBOLS}'))) AS symbols,
         len(list_filter(ws, lambda w: regexp_full_match(w, '{quality_rules.SEPARATORS}'))) AS separators
  FROM lines JOIN prose USING (r, para) WHERE len(ws) > 0),
by_doc AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(chars) AS chars,
         sum(CASE WHEN (shouts > 0 AND 100 * shouts >= 20 * n) OR (symbols > 0 AND 100 * symbols >= 20 * n)
                    OR (n >= 5 AND NOT prose AND NOT regexp_matches(line, '{MARKS}'))
                    OR (separators >= 2 AND 100 * separators >= 20 * n)
                    OR regexp_matches(lower(line), '{"|".join(quality_rules.BOILERPLATE)}')
             THEN chars ELSE 0 END) AS lost
  FROM judged GROUP BY r),
figures AS (
  SELECT doc_id, len(regexp_extract_all(text, '{WORD}'))::BIGINT AS n_words,
         coalesce(chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost, 0)::BIGINT AS removed_chars
  FROM d LEFT JOIN by_doc USING (r) LEFT JOIN repeats USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_chars <= 30 * word_chars AS kept
FROM figures
"""


def _license() -> str:
    known = ", ".join(f"{quoted(t)}: '<{i}>'" for t, i in license_scan.BY_TEXT.items())
    marks = "array_to_string(ids, '')"
    for n, rule in enumerate(license_scan.ORDERED):
        marks = f"replace({marks}, '{license_scan.pattern(rule)}', '[{n}]')"
    rules = ", ".join(f"({n}, {quoted(r[0])}, {quoted(r[1])})" for n, r in enumerate(license_scan.ORDERED))
    return rf"""
WITH known AS (SELECT MAP {{{known}}} AS m),
parts AS (SELECT doc_id, string_split(regexp_replace(text, '{license_scan.SENTENCE_END}', '\1' || chr(10), 'g'),
                                      chr(10)) AS ss FROM documents WHERE text IS NOT NULL),
named AS (SELECT doc_id, list_filter(list_transform(ss, lambda s: m[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))]),
                                     lambda x: x IS NOT NULL) AS ids FROM parts, known),
marked AS (SELECT doc_id, {marks} AS marks FROM named WHERE len(ids) > 0),
rules(n, rule, license) AS (VALUES {rules})
SELECT doc_id, rule, license, ((length(marks) - length(replace(marks, '[' || n || ']', '')))
       // length('[' || n || ']'))::BIGINT AS n_found
FROM marked, rules WHERE contains(marks, '[' || n || ']')
QUALIFY rule <> '{license_scan.ALONE}' OR count(*) OVER (PARTITION BY doc_id) = 1
"""


# Turn p of n, given by the id; from there on the rejected side gives each reply the text of the reply before.
CHAT = r"""
WITH t AS (SELECT conv_id, turn, role, text, coalesce(role, 'user') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
                  count(*) OVER (PARTITION BY conv_id) AS n
           FROM conversations WHERE conv_id IS NOT NULL),
replies AS (SELECT conv_id, i, coalesce(lag(x) OVER (PARTITION BY conv_id ORDER BY i), '') AS earlier
            FROM t WHERE r = 'assistant'),
other AS (SELECT t.*, CASE WHEN r = 'assistant' AND i >= 1 + (conv_id % 1000003 * 7919 + 17) % n THEN earlier ELSE x END AS y
          FROM t LEFT JOIN replies USING (conv_id, i)),
sides AS (SELECT *, conv_id % 10 <> 1 AS has_a, conv_id % 10 <> 2 AS has_b FROM other),
shared AS (SELECT conv_id, CASE WHEN bool_and(has_a AND has_b) THEN coalesce(min(i) FILTER (x <> y) - 1, max(n)) ELSE 0 END AS k
           FROM sides GROUP BY conv_id),
turns AS (SELECT conv_id, i, k, r, side, replace(role_text, '<|', '< |') AS role_text, replace(body, '<|', '< |') AS body
          FROM (SELECT conv_id, i, k, r, r AS role_text, 'a' AS side, x AS body FROM sides JOIN shared USING (conv_id) WHERE has_a
                UNION ALL
                SELECT conv_id, i, k, r, r, 'b', y FROM sides JOIN shared USING (conv_id) WHERE has_b)),
shown AS (SELECT *, '<|im_start|>' || role_text || chr(10) || body || '<|im_end|>' || chr(10) AS line FROM turns),
placed AS (SELECT *, coalesce(sum(length(line)) FILTER (i > k) OVER (PARTITION BY conv_id, side ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM shown),
spans AS (SELECT *, before + length(role_text) + 13 AS s FROM placed)
SELECT conv_id, k::INTEGER AS n_prompt_turns,
       coalesce(string_agg(line, '' ORDER BY i) FILTER (i <= k AND side = 'a'), '') AS prompt,
       coalesce(string_agg(line, '' ORDER BY i) FILTER (i > k AND side = 'a'), '') AS chosen,
       coalesce(string_agg(line, '' ORDER BY i) FILTER (i > k AND side = 'b'), '') AS rejected,
       coalesce(string_agg(s || '-' || (s + length(body) + 10), ',' ORDER BY i)
                FILTER (i > k AND side = 'a' AND r = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(s || '-' || (s + length(body) + 10), ',' ORDER BY i)
                FILTER (i > k AND side = 'b' AND r = 'assistant'), '') AS rejected_mask
FROM spans GROUP BY conv_id, k
"""

LICENSE = _license()

WARC = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, sha1(coalesce(html, '')) AS payload_digest,
                  strlen(coalesce(html, '')) AS payload_bytes FROM pages),
hosts AS (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
                 regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '#.*', '') AS rest,
                 max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p),
keyed AS (SELECT *, array_to_string(list_reverse(string_split(lower(regexp_replace(regexp_replace(host, '^.*@', ''),
                    ':[0-9]*$', '')), '.')), ',') || ')' || rest AS url_key,
                 1704067200 + page_id % 31536000 AS captured_at,
                 payload_bytes >= 1000 AND page_id <> top AS again FROM hosts)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to, url_key, captured_at,
       row_number() OVER (ORDER BY url_key, captured_at) - 1 AS index_row
FROM keyed
"""
