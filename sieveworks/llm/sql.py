"""The same results as SQL, where SQL can express them."""

_LETTERS = "lower(regexp_replace(l.line, '[^\\p{L}]+', '', 'g'))"

_P2 = f"""
WITH total AS (SELECT company_name, count(*) AS n FROM job WHERE trim(company_name) <> '' GROUP BY 1),
lines AS (
  SELECT j.row_id, j.company_name, l.line, l.line_no
  FROM job j, LATERAL (SELECT unnest(string_split(j.description, chr(10))) AS line, generate_subscripts(string_split(j.description, chr(10)), 1) AS line_no) l
  WHERE trim(j.company_name) <> '' AND j.description IS NOT NULL
),
keyed AS (SELECT l.row_id, l.company_name, l.line_no, {_LETTERS} AS key FROM lines l),
often AS (
  SELECT k.company_name, k.key FROM keyed k JOIN total t ON k.company_name = t.company_name
  WHERE k.key <> '' GROUP BY k.company_name, k.key, t.n HAVING count(DISTINCT k.row_id) >= 8 AND count(DISTINCT k.row_id) >= 0.1 * t.n
)
SELECT k.row_id, CAST(k.line_no AS BIGINT) AS line_no FROM keyed k JOIN often o ON k.company_name = o.company_name AND k.key = o.key
"""


# Runs of repeated lines, all windows of each, those that enough documents hold, less those that one more line keeps in every place.
_P2_BLOCKS = _P2[: _P2.rindex("SELECT k.row_id")].rstrip() + """,
placed AS (SELECT row_id, company_name, line_no, key, row_number() OVER (PARTITION BY row_id ORDER BY line_no) AS pos FROM keyed WHERE key <> ''),
mine AS (
  SELECT p.*, p.pos - row_number() OVER (PARTITION BY p.row_id ORDER BY p.pos) AS run
  FROM placed p JOIN often o ON p.company_name = o.company_name AND p.key = o.key
),
runs AS (SELECT row_id, company_name, run, list(key ORDER BY pos) AS keys, list(line_no ORDER BY pos) AS nos FROM mine GROUP BY 1, 2, 3),
starts AS (SELECT *, unnest(generate_series(1, len(keys))) AS a FROM runs),
windows AS (SELECT *, unnest(generate_series(a, len(keys))) AS b FROM starts),
blocks AS (
  SELECT w.company_name, w.keys[w.a : w.b] AS k, max(w.b - w.a + 1) AS n_lines, count(DISTINCT w.row_id) AS docs, count(*) AS occurrences, min(struct_pack(r := w.row_id, l := w.nos[w.a])) AS first
  FROM windows w JOIN total t ON w.company_name = t.company_name GROUP BY w.company_name, k, t.n HAVING count(DISTINCT w.row_id) >= 8 AND count(DISTINCT w.row_id) >= 0.1 * t.n
)
SELECT company_name, CAST(n_lines AS BIGINT) AS n_lines, CAST(docs AS BIGINT) AS docs, CAST(occurrences AS BIGINT) AS occurrences, CAST(first.r AS BIGINT) AS first_row, CAST(first.l AS BIGINT) AS first_line
FROM blocks b WHERE NOT EXISTS (
  SELECT 1 FROM blocks e WHERE e.company_name = b.company_name AND e.n_lines = b.n_lines + 1 AND e.occurrences = b.occurrences AND (e.k[1 : b.n_lines] = b.k OR e.k[2 : b.n_lines + 1] = b.k)
)
"""

_P2_CLEANED = _P2[: _P2.rindex("SELECT k.row_id")].rstrip() + """,
bad AS (SELECT k.row_id, k.line_no FROM keyed k JOIN often o ON k.company_name = o.company_name AND k.key = o.key),
every AS (
  SELECT j.row_id, l.line, l.line_no FROM job j,
  LATERAL (SELECT unnest(string_split(j.description, chr(10))) AS line, generate_subscripts(string_split(j.description, chr(10)), 1) AS line_no) l WHERE j.description IS NOT NULL
),
cleaned AS (
  SELECT e.row_id, coalesce(string_agg(CASE WHEN b.row_id IS NULL THEN e.line END, chr(10) ORDER BY e.line_no), '') AS description, count(b.row_id) AS n
  FROM every e LEFT JOIN bad b ON e.row_id = b.row_id AND e.line_no = b.line_no GROUP BY 1
)
SELECT j.row_id, c.description, CAST(coalesce(c.n, 0) AS INTEGER) AS lines_removed FROM job j LEFT JOIN cleaned c ON j.row_id = c.row_id
"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _P2, "p2_blocks": _P2_BLOCKS, "p2_cleaned": _P2_CLEANED}
