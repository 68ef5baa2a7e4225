"""DuckDB SQL of the results that SQL can express, over the same tables."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

#: windows of ten words, every place of which is hit; near: one of the four rarest pairs of a window at its place and all its words within three words of it
DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, w FROM (SELECT DISTINCT item_id, w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0)),
win AS (SELECT i, item_id, f, least(10, len(w)) AS n, w[f + 1 : f + least(10, len(w))] AS ws FROM (SELECT *, unnest(range(len(w) - least(10, len(w)) + 1)) AS f FROM i)),
grams AS (SELECT r, p, n, array_to_string(w[p + 1 : p + n], ' ') AS g FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hits AS (SELECT DISTINCT r, item_id, p, n FROM grams JOIN (SELECT item_id, n, array_to_string(ws, ' ') AS g FROM win) USING (n, g)),
hit AS (SELECT r, count(DISTINCT p + k) AS n_hit FROM (SELECT r, p, unnest(range(n)) AS k FROM hits) GROUP BY 1),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS x FROM hits) GROUP BY 1),
pairs AS (SELECT r, p, w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT r, w, unnest(range(len(w) - 1)) AS p FROM d)),
cf AS (SELECT g, count(*) AS cf FROM pairs GROUP BY 1),
rare AS (SELECT i, item_id, f, n, ws, k, g FROM (SELECT *, row_number() OVER (PARTITION BY i, f ORDER BY coalesce(cf, 0), k) AS rank
  FROM (SELECT *, ws[k + 1] || ' ' || ws[k + 2] AS g FROM (SELECT *, unnest(range(n - 1)) AS k FROM win)) LEFT JOIN cf USING (g)) WHERE rank <= 4 AND cf > 0),
starts AS (SELECT DISTINCT r, item_id, p - k AS s, n, ws FROM pairs JOIN rare USING (g) WHERE p >= k
  UNION SELECT r, item_id, p, n, ws FROM (SELECT r, w, unnest(range(len(w))) AS p FROM d) x JOIN win ON n = 1 AND w[p + 1] = ws[1]),
near AS (SELECT r, count(DISTINCT coalesce(CAST(item_id AS VARCHAR), '')) AS n_near FROM starts JOIN d USING (r) WHERE list_has_all(w[greatest(s - 3, 0) + 1 : s + n + 3], ws) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN near USING (r)"""

#: a turn's markers are 20 characters; a backslash stands before each backslash and inside each control string
CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
u AS (SELECT *, role || chr(10) || text || chr(10) AS whole, 20 + length(role || text)
  + length(role || text) - length(replace(role || text, '\', ''))
  + list_sum(list_transform([role, text], lambda x: list_sum(list_transform(['<s>', '</s>', '[INST]', '[/INST]'], lambda c: (length(x) - length(replace(x, c, ''))) // length(c))))) AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(whole, '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(size) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id"""

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d"""


def _vector_codes() -> str:
    """Every part against every entry, in three assignments with the codebooks made anew between them."""
    near = """n{r} AS (SELECT vec_id, label, p, x, arg_min(e, (far, e)) AS e, min(far) AS far FROM
  (SELECT v.*, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far FROM v JOIN c{r} USING (p)) GROUP BY ALL)"""
    again = """c{s} AS (SELECT p, e, coalesce(m, c) AS c FROM c{r} LEFT JOIN
  (SELECT p, e, list(m ORDER BY i) AS m FROM (SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM n{r}, range(1, 5) t(i) GROUP BY p, e, i) GROUP BY p, e) USING (p, e))"""
    steps = ",\n".join([near.format(r=0), again.format(r=0, s=1), near.format(r=1), again.format(r=1, s=2), near.format(r=2).replace("n2 AS", "n2 AS MATERIALIZED")])
    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
v AS MATERIALIZED (SELECT vec_id, label, p, x[4 * p + 1 : 4 * p + 4] AS x FROM k, range(16) t(p)),
c0 AS (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x AS c FROM v WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
{steps},
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2),
codes AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM n2 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, books"""


ORACLES: dict[str, str] = {"op12_exact_dedup": EXACT_DEDUP, "op13_vector_codes": _vector_codes(), "op5_decontamination": DECONTAMINATION, "op10_chat_formatting": CHAT}
