"""The operators' contracts as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_BLANK = r"'[^\x20\x09-\x0D]+'"


def words(text: str = "text", pattern: str = _ALNUM) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_LOWER}), {pattern})"


MIXING = rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '~') AS k,
         len(regexp_extract_all(coalesce(text, ''), {_BLANK})) AS size
  FROM documents),
h AS (SELECT *, md5('mix:' || coalesce(doc_id::VARCHAR, '~') || ':' || size) AS drawn FROM d),
s AS (
  SELECT k, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY k),
f AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / w, k
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
    sum(w) OVER (ORDER BY source_size * 2.0::DOUBLE / w, k
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
    sum(source_size) OVER () * 1.5::DOUBLE AS goal,
    row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, k) AS place
  FROM s),
lv AS (
  SELECT arg_min((goal - clamped) / open_w, place) AS level FROM f
  WHERE cap > (goal - clamped) / open_w * w),
t AS (SELECT k, source_size, least(cap, coalesce(level * w, cap)) AS target FROM f, lv),
r AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
    coalesce(sum(size) OVER (PARTITION BY k ORDER BY drawn, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached
  FROM h JOIN t USING (k))
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (whole + CASE WHEN size > 0 AND 2 * reached + size
     <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {words()} AS w FROM documents),
b AS (SELECT item_id, {words()} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win))),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN win USING (n, s)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items,
         sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_COMPONENTS = """
linked AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT x, y FROM linked
  UNION
  SELECT reach.x, linked.y FROM reach JOIN linked ON reach.y = linked.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {words(pattern=_BLANK)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
  WHERE 100 * c >= 90 * (nx.n + ny.n - c)),{_COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles,
  least(doc_id, coalesce(least.y, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.x = doc_id
"""

EMBEDDINGS = f"""
WITH RECURSIVE u AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label
  WHERE a.vec_id < b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),{_COMPONENTS},
counts AS (SELECT x, count(*) AS n FROM linked GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links,
  least(vec_id, coalesce(least.y, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least.y, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.x = vec_id LEFT JOIN least ON least.x = vec_id
"""

NEGATIVES = """
WITH u AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM u a JOIN u b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, r AS p, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor, p ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM s JOIN p USING (anchor) WHERE NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10
"""

SQL = {
    "op1_embeddings": EMBEDDINGS,
    "op6_jaccard": JACCARD,
    "op7_mixing": MIXING,
    "op10_decontamination": DECONTAMINATION,
    "op12_negatives": NEGATIVES,
}
