"""Queries and SQL of the operators; one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, jaccard_join, lang_id, line_rules, mixing, quality_model, suffix_dedup, token_files, url_filter, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": token_files.op1,
        "op2_source_mix": mixing.op2,
        "op3_jaccard_join": jaccard_join.op3,
        "op4_suffix_dedup": suffix_dedup.op4,
        "op5_line_rules": line_rules.op5,
        "op6_quality_model": quality_model.op6,
        "op7_url_filter": url_filter.op7,
        "op8_warc_index": warc.op8,
        "op9_language_id": lang_id.op9,
        "op10_decontaminate": decontaminate.op10,
    }


_WORD = r"[^\x20\x09-\x0D]+"

LINE_RULES = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w, string_split(t, chr(10)) AS lines FROM d),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1) GROUP BY rid),
l AS (SELECT rid, o, lines[o] AS l FROM (SELECT rid, lines, unnest(range(1, len(lines) + 1)) AS o FROM w)),
m AS (SELECT *, regexp_extract_all(l, '{_WORD}') AS v, row_number() OVER (PARTITION BY rid, l ORDER BY o) > 1 AS again FROM l WHERE regexp_matches(l, '{_WORD}')),
c AS (
  SELECT *, len(v) AS n, length(array_to_string(v, '')) AS chars,
    length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) AS symbols,
    len(list_filter(v, lambda x: regexp_matches(x, '[.!?"'')\]:;]$'))) AS closed,
    len(list_filter(v, lambda x: length(x) > 1 AND regexp_matches(x, '!!$'))) AS loud,
    len(list_filter(v, lambda x: x IN ('|', '>'))) AS bars,
    len(list_filter(range(2, len(v) + 1), lambda i: v[i] = v[i - 1])) AS echoes,
    regexp_matches(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{"|".join(line_rules.PHRASES)}') AS phrase
  FROM m),
x AS (SELECT rid, o, chars, phrase OR again OR (n >= 4 AND (closed = 0 OR 2 * echoes > n)) OR 10 * symbols > chars OR 2 * loud > n OR (bars >= 2 AND 6 * bars > n) AS fails FROM c),
f AS (
  SELECT l.rid, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost, sum(CASE WHEN again THEN 1 ELSE 0 END) AS n_dup_lines,
    coalesce(string_agg(l.l, chr(10) ORDER BY l.o) FILTER (WHERE NOT coalesce(fails, FALSE)), '') AS clean
  FROM l LEFT JOIN x ON x.rid = l.rid AND x.o = l.o LEFT JOIN m ON m.rid = l.rid AND m.o = l.o GROUP BY l.rid),
b AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lost, sha256(clean) AS clean_sha256
  FROM w JOIN f USING (rid) LEFT JOIN r USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, CAST(lost AS BIGINT) AS lost_chars,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * lost <= word_chars AS kept, clean_sha256
FROM b
"""

#: All pairs that share a shingle, then the closure of those that are similar enough.
JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS w FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
e AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
s AS (SELECT DISTINCT doc_id, g FROM e),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 5 * c >= 4 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
k AS (SELECT a, min(b) AS class_id FROM r GROUP BY a),
l AS (SELECT p.a, count(*) AS n_links, count(DISTINCT CASE WHEN y.t <> z.t THEN z.t END) AS n_texts, count(CASE WHEN y.t = z.t THEN 1 END) AS n_copies FROM p JOIN d y ON y.doc_id = p.a JOIN d z ON z.doc_id = p.b GROUP BY p.a)
SELECT k.a AS doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_texts, 0) AS n_texts, coalesce(n_copies, 0) AS n_copies FROM k LEFT JOIN l ON l.a = k.a
"""

#: Base 32 of 40 hexadecimal digits: five bits at a time out of three digits. The index is in order of URL key and time.
WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS best FROM p),
a AS (SELECT page_id, regexp_extract(regexp_replace(coalesce(url, ''), '^(?s:.*?)://', ''), '^[^#]*') AS rest FROM pages),
h AS (SELECT page_id, regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^.*@', '') AS host, substr(rest, 1 + length(regexp_extract(rest, '^[^/?]*'))) AS tail FROM a),
u AS (SELECT page_id, array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(host, '^[^:]*'), '^www\.', ''), '.')), ',') || CASE WHEN host LIKE '%:_%' THEN regexp_extract(host, ':.*$') ELSE '' END || ')' || CASE WHEN tail = '' THEN '/' ELSE tail END AS url_key FROM h),
i AS (SELECT page_id, row_number() OVER (ORDER BY url_key, page_id) - 1 AS index_rank FROM u),
v AS (SELECT *, list_transform(range(0, 32), lambda i: list_transform(range(0, 3), lambda j: strpos('0123456789abcdef', substr(s || '00', 1 + (i * 5) // 4 + j, 1)) - 1)) AS n FROM q)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (((n[i + 1][1] * 256 + n[i + 1][2] * 16 + n[i + 1][3]) // CAST(pow(2, 7 - (i * 5) % 4) AS BIGINT)) % 32) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to, index_rank
FROM v JOIN i USING (page_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_join": JACCARD, "op5_line_rules": LINE_RULES, "op8_warc_index": WARC}
