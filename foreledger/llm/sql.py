"""DuckDB SQL of the queries that SQL can express, for checking only."""

OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), windows AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM w, unnest(range(1, len(ws) - 1)) u(i)
), found_twice AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM found_twice, unnest([i, i + 1, i + 2]) u(p) GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_upper
  FROM w LEFT JOIN covered USING (rid)
), f AS (
  SELECT *, CAST(
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 20 * n_symbols > word_chars THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_upper > 4 * word_chars THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 64 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, 'v2' AS policy FROM f
"""

# every window of an item's size, by exact similarity
OP5 = r"""
WITH d AS (
  SELECT DISTINCT doc_id, text FROM documents
), dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws
  FROM d
), ds AS (
  SELECT rid, doc_id, len(ws) - 4 AS n_doc, i - 1 AS place, array_to_string(ws[i:i + 4], ' ') AS s
  FROM dw, unnest(range(1, len(ws) - 3)) u(i)
), b AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM benchmark
), bs AS (
  SELECT item_id, len(ws) - 4 AS n, array_to_string(ws[i:i + 4], ' ') AS s
  FROM b, unnest(range(1, len(ws) - 3)) u(i)
), bw AS (
  SELECT item_id, n, s, count(*) AS in_item FROM bs GROUP BY ALL
), hits AS (
  SELECT rid, doc_id, n_doc, place, item_id, n, s, in_item FROM ds JOIN bw USING (s)
), counted AS (
  SELECT rid, doc_id, item_id, n, start, s, in_item, count(*) AS in_window
  FROM hits, unnest(range(greatest(place - n + 1, 0), least(place, n_doc - n) + 1)) u(start)
  GROUP BY ALL
), shared AS (
  SELECT rid, doc_id, item_id, n, start, CAST(sum(least(in_window, in_item)) AS BIGINT) AS shared
  FROM counted GROUP BY ALL
)
SELECT doc_id, item_id, CAST(start AS BIGINT) AS window_start, CAST(n AS BIGINT) AS n_shingles,
  shared, shared / (2 * n - shared) AS similarity
FROM shared WHERE shared >= 0.8 * (2 * n - shared) - 1e-9
QUALIFY row_number() OVER (PARTITION BY rid, item_id ORDER BY shared DESC, start) = 1
"""

OP10 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
), r AS (
  SELECT *, coalesce(payload_bytes >= 100 AND first_id < page_id, false) AS later FROM f
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN later THEN first_id END AS refers_to
FROM r
"""

OP11 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

OP12 = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, k, ws[i:i + k - 1] AS ws
  FROM split, unnest([1, 2, 3, 4]) g(k), unnest(range(1, len(ws) - k + 2)) u(i)
), f AS (
  SELECT lang, k, ws, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, ws, f AS a FROM f WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT c.lang, c.ws, c.k, c.a, cut, l.f AS l, r.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.ws = c.ws[1:cut]
  JOIN f r ON r.lang = c.lang AND r.ws = c.ws[cut + 1:]
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, ws[i:i + m - 1] AS ws, max(a) AS longest
  FROM candidates, unnest([2, 3]) g(m), unnest(range(1, k - m + 2)) u(i) WHERE m < k GROUP BY ALL
), kept AS (
  SELECT w.*, array_to_string(w.ws, ' ') AS phrase FROM worst w LEFT JOIN inside i USING (lang, ws)
  WHERE coalesce(100 * longest < 80 * a, true)
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op5_decontamination": OP5,
    "op10_warc": OP10,
    "op11_exact_dedup": OP11,
    "op12_collocations": OP12,
}
