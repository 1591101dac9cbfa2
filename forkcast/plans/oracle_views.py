"""SQL text of the shared views, for the independent SQL oracle.

This is the fixture definition (FIXTURES.md §2) written as CTEs; the Spark
side builds the same rows with the DataFrame API in
``forkcast.sources.tables``.
"""

VENUE_SQL = """
SELECT c.c_custkey AS id,
       CASE WHEN c.c_custkey % 2 = 0 THEN concat('  ', n.n_name, ' ') ELSE lower(n.n_name) END AS subzone,
       concat('[', chr(39), replace(p.p_name, ' ', concat(chr(39), ', ', chr(39))), chr(39), ']') AS cuisine,
       CASE WHEN c.c_custkey % 25 = 0 THEN NULL ELSE concat('[', chr(39), c.c_mktsegment, chr(39), ']') END AS type,
       CASE WHEN c.c_custkey % 20 = 0 THEN NULL ELSE CAST((c.c_custkey * 37) % 521 AS DOUBLE) END AS cost,
       CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE CAST((c.c_custkey * 11) % 97 AS DOUBLE) END AS cost_2,
       CASE WHEN c.c_custkey % 50 = 7 THEN NULL ELSE CAST((c.c_custkey * 13) % 101 AS DOUBLE) END AS lat,
       CASE WHEN c.c_custkey % 50 = 7 THEN NULL ELSE CAST((c.c_custkey * 17) % 103 AS DOUBLE) END AS lng,
       CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST(10 + (c.c_custkey * 29) % 41 AS DOUBLE) / CAST(10 AS DOUBLE) END AS rating_number,
       CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST((c.c_custkey * 31) % 997 AS DOUBLE) END AS votes,
       CASE WHEN c.c_custkey % 4 = 0 THEN NULL
            WHEN (c.c_custkey * 29) % 41 >= 35 THEN 'Excellent'
            WHEN (c.c_custkey * 29) % 41 >= 30 THEN 'Very Good'
            WHEN (c.c_custkey * 29) % 41 >= 25 THEN 'Good'
            WHEN (c.c_custkey * 29) % 41 >= 15 THEN 'Average'
            ELSE 'Poor' END AS rating_text
FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN part p ON p.p_partkey = c.c_custkey
"""

BOUNDARIES_SQL = """
SELECT n_nationkey AS region_id, upper(concat(' ', n_name)) AS region_name,
       CAST(n_nationkey AS DOUBLE) AS min_x, CAST(n_nationkey + 1 AS DOUBLE) AS max_x,
       CAST(-n_nationkey AS DOUBLE) AS min_y, CAST(1 - n_nationkey AS DOUBLE) AS max_y
FROM nation
"""

WITH_VIEWS = f"WITH venue AS ({VENUE_SQL}), boundaries AS ({BOUNDARIES_SQL})"

# The whitespace class and strip expression in RE2 syntax (same text as
# forkcast.functions.text.WHITESPACE_CLASS).
WS = ("[\\t\\n\\x0b\\x0c\\r \\x1c\\x1d\\x1e\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def fold(expr: str) -> str:
    return ("replace(replace(replace(replace(lower(" + expr + "), 'ß', 'ss'), 'ẞ', 'ss'), 'ſ', 's'), 'ς', 'σ')")


def with_views(body: str) -> str:
    return WITH_VIEWS + "\n" + body
