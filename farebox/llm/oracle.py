"""DuckDB SQL of the operators whose results SQL can express, written from their contracts."""

from __future__ import annotations

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = f"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, unnest(regexp_extract_all(t, '{TERM}')) AS term FROM low),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lens AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lens),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM wanted) GROUP BY term), total),
adds AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS s
         FROM tf JOIN weights USING (term) JOIN lens USING (doc_id), total),
scores AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM wanted JOIN adds USING (term) GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 50
"""

#: crc32 bit by bit over the bytes of the id's digits.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda v, u: xor(v >> 1, (v & 1) * 3988292384))), 4294967295::BIGINT)"""

OP12 = f"""
WITH base AS (SELECT doc_id, {CRC32} AS h, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
              FROM documents),
planned AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS e FROM base),
texts AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
              w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + e)) END + 1]) END AS w FROM planned),
words AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM texts),
same AS (SELECT l.doc_id, r.i - l.i AS q, l.i FROM words l JOIN words r ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
islands AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
best AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
         FROM runs GROUP BY doc_id),
-- of two fractions of this size that differ, so do their doubles
first AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM words w ANTI JOIN runs r
         ON w.doc_id = r.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, f.start, f.length, f.period, (1000 * f.length) // f.period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM texts t LEFT JOIN best USING (doc_id) LEFT JOIN first f USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

#: The given pages hold their article in one element, its blocks between h1 and p tags.
OP11 = r"""
WITH parts AS (SELECT page_id, url, generate_subscripts(b, 1) AS i, unnest(b) AS x FROM (
    SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:h1|p)>') AS b FROM pages)),
bare AS (SELECT page_id, url, i, regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS x FROM parts),
clean AS (SELECT page_id, url, i, trim(regexp_replace(
    replace(replace(replace(replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&#39;', chr(39)), '&#x27;', chr(39)),
    '\s+', ' ', 'g')) AS x FROM bare),
decoded AS (SELECT page_id, url, i, regexp_replace(x, '&amp;?', '&', 'g') AS x FROM clean)
SELECT page_id, url, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (x <> ''), '') AS text,
       coalesce(length(string_agg(x, chr(10) ORDER BY i) FILTER (x <> '')), 0)::BIGINT AS n_chars
FROM decoded GROUP BY page_id, url
"""

OP8 = r"""
WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS t FROM (SELECT doc_id, w, unnest(range(len(w) - 12)) AS i FROM texts)),
firsts AS (SELECT t, min(doc_id) AS lo FROM windows GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (t) WHERE lo < doc_id),
words AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS x FROM texts),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_phrase_dedup": OP8, "op11_min_cut_text": OP11, "op12_periodic_runs": OP12, "op13_pair_maxscore": OP13}
