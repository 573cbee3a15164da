"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

_SETS = r"""
{name}_w AS (
  SELECT {id} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM {table}),
{name}_s AS (
  SELECT id, CASE WHEN coalesce(len(ws), 0) = 0 THEN []
    WHEN len(ws) < 5 THEN ['#' || array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS s
  FROM {name}_w)"""

_NEAR = f"""
WITH RECURSIVE {_SETS.format(name="d", id="doc_id", table="documents")},
x AS (SELECT id, unnest(s) AS g FROM d_s),
rare AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
y AS (SELECT id, g FROM x JOIN rare USING (g)),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM y a JOIN y b ON a.g = b.g AND a.id < b.id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN d_s p ON p.id = a JOIN d_s q ON q.id = b WHERE 100 * c >= 75 * (len(p.s) + len(q.s) - c)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
low AS (SELECT a AS id, min(b) AS m FROM reach GROUP BY a)
SELECT id AS doc_id, len(s)::BIGINT AS n_shingles, least(id, coalesce(m, id)) AS component_id, id = least(id, coalesce(m, id)) AS kept
FROM d_s LEFT JOIN low USING (id)"""

_LEAKS = f"""
WITH {_SETS.format(name="d", id="doc_id", table="documents")},
{_SETS.format(name="b", id="item_id", table="benchmark")},
x AS (SELECT id, unnest(s) AS g FROM d_s),
y AS (SELECT id, unnest(s) AS g FROM b_s)
SELECT x.id AS doc_id, y.id AS item_id, any_value(len(b_s.s))::BIGINT AS n_item, count(*)::BIGINT AS n_shared, count(*) / any_value(len(b_s.s))::DOUBLE AS containment
FROM x JOIN y USING (g) JOIN b_s ON b_s.id = y.id GROUP BY x.id, y.id HAVING 100 * count(*) >= 75 * any_value(len(b_s.s))"""


def oracle_sql() -> dict[str, str]:
    from .centroids import oracle as centroids
    from .licenses import oracle as licenses
    from .main_text import oracle as main_text
    from .url_lists import oracle as url_lists

    return {"op3_url_lists": url_lists(), "op9_license_scan": licenses(), "op4_near_duplicates": _NEAR, "op7_decontamination": _LEAKS, "op11_centroid_clusters": centroids(), "op12_main_text": main_text()}
