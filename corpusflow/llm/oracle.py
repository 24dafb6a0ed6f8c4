"""DuckDB SQL of the queries on conversations, filters and vectors."""

from __future__ import annotations

#: The digests follow from the turns; the length of the output from its marks and escapes.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || role || chr(10) || '<|im_end|>' || chr(10))
    + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

#: Every document's failed filters, then every order of the five.
OP12_SQL = r"""
WITH l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(words) < 200,
    'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)
  } AS f
  FROM w LEFT JOIN l USING (doc_id)
), s AS (
  SELECT part, good, toxic, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END)
    || (CASE WHEN f.C THEN 'C' ELSE '' END) || (CASE WHEN f.D THEN 'D' ELSE '' END)
    || (CASE WHEN f.E THEN 'E' ELSE '' END) AS failed, count(*) AS n
  FROM d GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, left(filter_order, step - 1) AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
    sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (NOT gone AND fails) AS removed,
    sum(n) FILTER (gone AND fails) AS redundant, sum(n) FILTER (failed = own) AS unique_fails,
    sum(n) FILTER (NOT gone AND fails AND good) AS good_lost, sum(n) FILTER (NOT gone AND fails AND toxic) AS toxic_lost
  FROM (SELECT *, contains(failed, own) AS fails,
          len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0 AND earlier <> '' AND failed <> '' AS gone
        FROM s, steps)
  GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""


def _lloyd(parts: int = 8, entries: int = 16, rounds: int = 6, width: int = 64) -> str:
    """Each round is two more tables: assignments `a` and the codebooks `b` that follow."""
    size = width // parts
    means = ", ".join(
        f"(sum(m[{c}]) - ((sum(m[{c}]) % count(*)) + count(*)) % count(*)) // count(*)" for c in range(1, size + 1)
    )

    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT r, p.pos, any_value(p.m) AS m,
    min({{'d': list_sum(list_transform(list_zip(p.m, b.m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS best
  FROM p JOIN b{n} b ON p.pos = b.pos GROUP BY r, p.pos
)"""

    tables = [assigned(0)]
    for n in range(1, rounds + 1):
        tables.append(f"""b{n} AS MATERIALIZED (
  SELECT o.pos, o.e, coalesce(u.m, o.m) AS m FROM b{n - 1} o LEFT JOIN (
    SELECT pos, best.e AS e, list_transform([{means}], lambda y: CAST(y AS BIGINT)) AS m FROM a{n - 1} GROUP BY pos, best.e
  ) u ON o.pos = u.pos AND o.e = u.e
)""")
        tables.append(assigned(n))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT r, pos, list_slice(v, pos * {size} + 1, (pos + 1) * {size}) AS m FROM k, (SELECT unnest(range({parts})) AS pos)
), b0 AS MATERIALIZED (SELECT pos, r - 1 AS e, m FROM p WHERE r <= {entries}),
{", ".join(tables)}
, c AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY pos, e)) FROM b{rounds}) AS codebooks_sha256
FROM k JOIN c USING (r)
"""


OP13_SQL = _lloyd()
