"""SQL twins (DuckDB) of the operators that SQL can express, over whole tables."""

from __future__ import annotations

import math

from forkcast.llm.license_join import PHRASES, TEMPLATES, _width, _words

#: The words of a text, as a list.
SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
#: A-Z lower-cased.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

RULES_CASCADE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {SPACED.format("coalesce(text, '')")} AS w FROM documents),
k AS (SELECT row_number() OVER () AS r, * FROM d),
u AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM k),
g AS (SELECT r, i, {' || chr(32) || '.join(['x', *(f'lead(x, {j}) OVER o' for j in range(1, 8))])} AS gram FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g WHERE gram IS NOT NULL),
t AS (SELECT r, count(*) AS n FROM (SELECT r, x = lag(x) OVER (PARTITION BY r ORDER BY i) AS again FROM u) WHERE again GROUP BY r),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM h WHERE n > 1) GROUP BY r),
m AS (
  SELECT k.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(t.n, 0) AS n_stutters,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_letters, length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower_letters
  FROM k LEFT JOIN c USING (r) LEFT JOIN t USING (r)),
f AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * len(lines))
            OR 100 * n_stutters > 30 * n_words OR upper_letters > lower_letters
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM f
"""


def _phrase_sql(words: list[str], at: str) -> str:
    """Whether a phrase starts at place ``at`` of the list w."""
    return " AND ".join(f"w[{at} + {i}] = '{x}'" for i, x in enumerate(words))


def _license_join(threshold: float = 0.8) -> str:
    places = ",\n".join(f"       list_filter(range(1, len(w) + 1), lambda i: {_phrase_sql(p.words.split(), 'i')}) AS places{k}" for k, p in enumerate(PHRASES))
    every = " || ".join(f"places{k}" for k in range(len(PHRASES)))
    base = " || ".join(f"CASE WHEN len(places{k}) > 0 THEN ['{p.label}'] ELSE [] END" for k, p in enumerate(PHRASES))
    rows = []
    for t in TEMPLATES:
        words, marks = _words(t), t.marks.split()
        need, width = math.ceil(threshold * len(words) - 1e-9), _width(t)
        listed = f"[{', '.join(repr(w) for w in words)}]"
        inside = f"list_intersect(list_distinct(w[i:i + {width - 1}]), {listed})"
        whole = f"len(list_intersect(list_distinct(w), {listed})) >= {need}"
        full = f"list_has_all(x, [{', '.join(repr(m) for m in marks)}])"
        starts = f"list_filter(range(1, len(w) + 1), lambda i: list_contains({listed}, w[i]))"
        found = f"list_filter(list_transform({starts}, lambda i: {inside}), lambda x: len(x) >= {need} AND {full})"
        rows.append(f"SELECT r, '{t.label}' AS label, list_max(list_transform({found}, lambda x: len(x))) / {len(words)}.0::DOUBLE AS containment FROM w WHERE {whole} AND len({found}) > 0")
    union = "\nUNION ALL ".join(rows)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {LOWER.format("coalesce(text, '')")} AS low FROM documents),
w AS (SELECT *, {ALNUM.format('low')} AS w FROM d),
p AS (SELECT r, doc_id, len(w) AS n_words,
{places}
      FROM w),
hits AS ({union}),
found AS (SELECT r, list(label) AS more, max(containment) AS containment FROM hits GROUP BY r),
q AS (SELECT p.*, {every} AS starts, {base} AS base, coalesce(more, []) AS more, containment FROM p LEFT JOIN found USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base,
       CAST(list_min(starts) - 1 AS BIGINT) AS first_word, CAST(list_max(starts) - 1 AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
       CASE WHEN len(starts) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM q
"""


LICENSE_JOIN = _license_join()

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACED.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g, len(w) < 5 AS short FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.short = b.short AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT pairs.a, pairs.b FROM pairs JOIN n x ON x.doc_id = pairs.a JOIN n y ON y.doc_id = pairs.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(least(d.doc_id, coalesce(c.m, d.doc_id)) AS BIGINT) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.m, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""

REPEATS = rf"""
WITH d AS (SELECT doc_id, {SPACED.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h HAVING min(doc_id) < max(doc_id)),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN f USING (h) WHERE first < doc_id),
x2 AS (SELECT doc_id, count(*) AS n, list(p) AS p FROM x GROUP BY doc_id),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d WHERE doc_id IN (SELECT doc_id FROM x2)),
k AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.p) AS kept FROM u LEFT JOIN x ON x.doc_id = u.doc_id AND x.p = u.p WHERE x.p IS NULL GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(x2.n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN x2.n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(k.kept, '') END) AS kept_sha256
FROM d LEFT JOIN x2 ON x2.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""

#: Rows i, l: the 256 remainders that a byte-wise crc32 needs, as a list.
_CRC = """steps AS (SELECT k, 0 AS i, CAST(k AS BIGINT) AS c FROM range(256) t(k)
          UNION ALL SELECT k, i + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM steps WHERE i < 8),
remainders AS (SELECT list(c ORDER BY k) AS l FROM steps WHERE i = 8)"""


def _crc32(hexed: str) -> str:
    """The unsigned crc32 of bytes given in hex, from a row with l."""
    byte = f"CAST(('0x' || substr({hexed}, 2 * j - 1, 2)) AS BIGINT)"
    return (f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, length({hexed}) // 2 + 1), lambda j: {byte}), "
            f"lambda c, b: xor(c >> 8, l[xor(c, b) % 256 + 1])), CAST(4294967295 AS BIGINT))")


PREFIX_TRIE = rf"""
WITH RECURSIVE {_CRC},
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, sha256(strlen(role) || ':' || role || text) AS said, strlen(text) AS bytes, turn FROM t),
o AS (SELECT conv_id, said, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) - 1 AS p FROM s),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("hex(CAST(conv_id AS VARCHAR))")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM o), remainders),
r AS (SELECT c.conv_id, 0 AS part, p, said, bytes FROM c JOIN o ON o.conv_id = c.base AND p < h
      UNION ALL SELECT c.conv_id, 1 AS part, p, said, bytes FROM c JOIN o ON o.conv_id = c.conv_id AND p >= h),
q AS (SELECT conv_id, bytes, row_number() OVER w AS d, string_agg(said, ',') OVER (w ROWS UNBOUNDED PRECEDING) AS path FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)),
v AS (SELECT conv_id, bytes, d, path FROM q UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM v GROUP BY path, d),
m AS (SELECT n.*, up.path AS parent, pn.conv_id AS parent_conv_id
      FROM n LEFT JOIN v up ON up.conv_id = n.conv_id AND up.d = n.d - 1 LEFT JOIN n pn ON pn.path = up.path AND pn.d = n.d - 1),
k AS (SELECT parent AS path, count(*) AS n_children FROM m WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT m.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM m LEFT JOIN k ON k.path = m.path),
g AS (SELECT up.path, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved_tokens FROM w JOIN v up ON up.conv_id = w.conv_id AND up.d <= w.d GROUP BY up.path),
e AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max_by(path, d) AS path FROM v GROUP BY conv_id) GROUP BY path)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, w.parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs, CAST(w.n_children AS BIGINT) AS n_children,
       CAST(g.n_leaves AS BIGINT) AS n_leaves, CAST(g.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM w JOIN g ON g.path = w.path LEFT JOIN e ON e.path = w.path
"""


def _importance(percent: int = 5) -> str:
    words = ALNUM.format(LOWER.format("coalesce(text, '')"))
    grams = " || ".join(f"list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))" for k in (1, 2, 3))
    return rf"""
WITH RECURSIVE {_CRC},
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
g AS (SELECT r, unnest({grams}) AS gram FROM d),
y AS (SELECT unnest({grams}) AS gram FROM (SELECT {words} AS w FROM benchmark)),
x AS (SELECT gram, {_crc32("hex(gram)")} % 10000 AS bucket FROM (SELECT gram FROM g UNION SELECT gram FROM y), remainders),
s AS (SELECT bucket, count(*) AS n FROM g JOIN x USING (gram) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM y JOIN x USING (gram) GROUP BY bucket),
gain AS (SELECT CAST(b.bucket AS BIGINT) AS bucket,
                CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000) AS DOUBLE)
                                     / CAST((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000) AS DOUBLE))) AS BIGINT) AS gain
         FROM range(10000) b(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (SELECT r, count(*) AS n_features, sum(gain) AS weight FROM g JOIN x USING (gram) JOIN gain USING (bucket) GROUP BY r),
h AS (SELECT d.doc_id, d.r, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             CAST(CAST(('0x' || substr(sha256('42:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS DOUBLE) AS h FROM d LEFT JOIN weights USING (r)),
z AS (SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM h),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, n_words) AS rank, count(*) OVER () AS n FROM z WHERE n_words >= 20)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score, CAST(CASE WHEN k.rank <= {percent} * n // 100 THEN k.rank END AS BIGINT) AS rank
FROM z LEFT JOIN k USING (r)
"""


IMPORTANCE = _importance()

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, coalesce(url, '') AS url FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha256(body) AS digest, url, regexp_extract(url, '^[^:/?#]*://([^/?#]*)', 1) AS host FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest),
k AS (SELECT d.*, first, CASE WHEN regexp_matches(url, '^[^:/?#]*://')
             THEN array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || regexp_extract(url, '^[^:/?#]*://([^/?#]*)([^#]*)', 2) ELSE url END AS url_key
      FROM d LEFT JOIN f USING (digest))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, url_key,
       CAST(row_number() OVER (ORDER BY url_key, page_id % 1000000000, '<urn:page:' || page_id || '>') - 1 AS BIGINT) AS position
FROM k
"""
