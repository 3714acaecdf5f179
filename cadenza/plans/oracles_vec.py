"""SQL oracles for the embedding queries (vectors as DOUBLE lists)."""

from __future__ import annotations

from .oracles import ORACLES, oracle, with_ctes
from .oracles_ml import R, gd_sql, rd
from .queries_vec import ENET_ALPHA, ENET_REG

DIM = 64
EMB_CTE = """
emb AS MATERIALIZED (
  SELECT vec_id, CAST(label AS DOUBLE) AS y, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
)"""

oracle("embedding_sum", with_ctes(EMB_CTE, body=f"""
SELECT CAST(y AS INTEGER) AS label, CAST(i AS INTEGER) AS i, {rd('sum(v)', 's')} FROM (
  SELECT y, unnest(e) AS v, unnest(range({DIM})) AS i FROM emb) GROUP BY y, i"""))
oracle("embedding_norm", with_ctes(EMB_CTE, body=f"""
SELECT vec_id, {rd('list_sum(list_transform(e, lambda x: x * x))', 'norm2')} FROM emb"""))
_GD64 = gd_sql(DIM, xs=[f"e[{j + 1}]" for j in range(DIM)], src="emb")
oracle("embedding_gd_weights", with_ctes(EMB_CTE, _GD64, body=f"""
SELECT CAST(j AS INTEGER) AS i, round(w, {R}) AS weight FROM (
  SELECT unnest(range({DIM})) AS j, unnest([{', '.join(f'w{j}' for j in range(DIM))}]) AS w
  FROM it WHERE i = 100)"""))
oracle("embedding_gd_iterative", ORACLES["embedding_gd_weights"])

# elastic net by proximal gradient steps on the correlations; the step's bound is the largest row sum
oracle("embedding_enet_span", with_ctes(EMB_CTE, f"""
x AS MATERIALIZED (SELECT vec_id, y, unnest(e) AS v, unnest(range({DIM})) AS i FROM emb),
m AS MATERIALIZED (SELECT i, avg(v) AS mu, stddev_pop(v) AS sd, corr(v, y) AS r FROM x GROUP BY i),
pairs AS MATERIALIZED (SELECT a.i, b.i AS j, corr(a.v, b.v) AS c FROM x a JOIN x b USING (vec_id) GROUP BY ALL),
k AS MATERIALIZED (SELECT (SELECT list(row ORDER BY i) FROM (SELECT i, list(c ORDER BY j) AS row FROM pairs GROUP BY i)) AS cc,
  (SELECT max(s) FROM (SELECT sum(abs(c)) AS s FROM pairs GROUP BY i)) AS top,
  (SELECT list(r ORDER BY i) FROM m) AS r, (SELECT {ENET_REG} / stddev_pop(y) FROM emb) AS lam),
it(n, w) AS (
  SELECT 0 AS n, list_transform(range({DIM}), lambda i: 0.0::DOUBLE)::DOUBLE[]
  UNION ALL
  SELECT n + 1, list_transform(list_transform(range(1, {DIM + 1}), lambda i:
      w[i] - (list_dot_product(cc[i], w) - r[i] + lam * {1 - ENET_ALPHA} * w[i]) / (top + lam * {1 - ENET_ALPHA})),
    lambda z: sign(z) * greatest(abs(z) - lam * {ENET_ALPHA} / (top + lam * {1 - ENET_ALPHA}), 0)) FROM it, k WHERE n < 4000
),
coef AS (SELECT i, w[i + 1] * (SELECT stddev_pop(y) FROM emb) / sd AS c, mu FROM m, it WHERE n = 4000)""", body=f"""
SELECT 'x' || CAST(i + 1 AS VARCHAR) AS term, round(c, {R}) + 0.0 AS value FROM coef
UNION ALL SELECT 'intercept', round((SELECT avg(y) FROM emb) - sum(c * mu), {R}) FROM coef"""))
