"""SQL oracles for vectors, features, splits and models.

The models are restated as SQL recursions over aggregate statistics:
gradient descent on Gram sums, and elastic net as coordinate descent on
correlations with population deviations (the standardised form of the
objective). They are generated for any number of features ``d``.
"""

from __future__ import annotations

from .oracles import SONG_CTE, oracle, with_ctes
from .queries_ml import ALPHA, GD_GRID_ITERS, GD_GRID_STEP, GRID_MAX_ITER, GRID_REG, REG

R = 4

# song rows with the 80/20 md5 split and the 3-fold assignment
SPLIT_CTE = """
part AS (
  SELECT *, CASE WHEN ('0x' || substr(md5(song_id), 1, 8))::BIGINT % 100 < 80
                 THEN 'train' ELSE 'test' END AS part,
         CAST(('0x' || substr(md5('fold|' || song_id), 1, 8))::BIGINT % 3 AS INTEGER) AS fold
  FROM song
),
mn AS (SELECT min(year) AS m FROM part WHERE part = 'train'),
train AS MATERIALIZED (SELECT p.*, p.year - mn.m AS y FROM part p, mn WHERE part = 'train'),
test AS MATERIALIZED (SELECT p.*, p.year - mn.m AS y FROM part p, mn WHERE part = 'test')"""

ALL_MIN_CTE = """
amn AS (SELECT min(year) AS m FROM song),
shifted AS (SELECT s.*, s.year - amn.m AS y FROM song s, amn)"""

POLY_EXPR = ["f1", "f1*f1", "f2", "f1*f2", "f2*f2", "f3", "f1*f3", "f2*f3", "f3*f3"]


def rd(expr: str, name: str) -> str:
    return f"round({expr}, {R}) AS {name}"


# --- parsing / features --------------------------------------------------------

oracle("tokenize", with_ctes(SONG_CTE, body="""
SELECT song_id, CAST(13 AS INTEGER) AS n_tokens, year AS label FROM song"""))
oracle("tokens_to_features", with_ctes(SONG_CTE, body="""
SELECT song_id, year AS v0, f1 AS v1, f2 AS v2, f3 AS v3, f4 AS v4, f5 AS v5, f6 AS v6,
       f7 AS v7, f8 AS v8, f9 AS v9, f10 AS v10, f11 AS v11, f12 AS v12 FROM song"""))
oracle("label_slice", with_ctes(SONG_CTE, body="SELECT song_id, year AS label FROM song"))
oracle("label_shift", with_ctes(SONG_CTE, ALL_MIN_CTE, body="""
SELECT song_id, year AS label, y AS label_shifted FROM shifted"""))
oracle("feature_frame", with_ctes(SONG_CTE, ALL_MIN_CTE, body="""
SELECT song_id, year AS label, y AS label_shifted, f1 AS x1, f2 AS x2, f3 AS x3 FROM shifted"""))
oracle("poly_features", with_ctes(SONG_CTE, body="SELECT song_id, " + ", ".join(
    f"{e} AS p{i + 1}" for i, e in enumerate(POLY_EXPR)) + " FROM song"))
oracle("min_label", with_ctes(SONG_CTE, body="SELECT min(year) AS min_label FROM song"))
oracle("column_fn_stage", with_ctes(SONG_CTE, body="""
SELECT song_id, CAST(floor(year / 10) * 10 AS BIGINT) AS decade FROM song"""))
oracle("vector_fn_stage", with_ctes(SONG_CTE, body="""
SELECT song_id, f1 * 2.0E0 - f3 AS y FROM song"""))
oracle("top_row", with_ctes(SONG_CTE, body="""
SELECT year AS label, year AS v0, f1 AS v1, f2 AS v2, f3 AS v3, f4 AS v4, f5 AS v5, f6 AS v6,
       f7 AS v7, f8 AS v8, f9 AS v9, f10 AS v10, f11 AS v11, f12 AS v12
FROM song ORDER BY year, f1, f2, f3, f4, f5, f6, f7, f8, f9, f10, f11, f12 LIMIT 1"""))

# --- vectors -------------------------------------------------------------------

oracle("vector_dot", with_ctes(SONG_CTE, body="""
SELECT song_id, f1*f4 + f2*f5 + f3*f6 AS dot FROM song"""))
oracle("vector_scale", with_ctes(SONG_CTE, body="""
SELECT song_id, f1*2.5E0 AS s1, f2*2.5E0 AS s2, f3*2.5E0 AS s3 FROM song"""))
oracle("vector_add", with_ctes(SONG_CTE, body="""
SELECT song_id, f1+f4 AS a1, f2+f5 AS a2, f3+f6 AS a3 FROM song"""))
oracle("vector_fill", with_ctes(SONG_CTE, ALL_MIN_CTE, body="""
SELECT song_id, y AS z1, y AS z2, y AS z3 FROM shifted"""))
oracle("vector_sum", with_ctes(SONG_CTE, body=f"""
SELECT {rd('sum(f1)', 's1')}, {rd('sum(f2)', 's2')}, {rd('sum(f3)', 's3')} FROM song"""))
oracle("rmse_metric", with_ctes(SONG_CTE, ALL_MIN_CTE, body=f"""
SELECT {rd('sqrt(avg(e*e))', 'rmse')}, {rd('avg(e*e)', 'mse')}, {rd('avg(abs(e))', 'mae')}
FROM (SELECT y - (40*f1 + 25*f2 + 15*f3) AS e FROM shifted)"""))
oracle("split_counts", with_ctes(SONG_CTE, SPLIT_CTE, body="""
SELECT part, count(*) AS n FROM part GROUP BY part"""))


# --- gradient descent ----------------------------------------------------------

def bsum(terms: list[str]) -> str:
    """Sum written as a balanced tree (keeps the SQL expression depth
    logarithmic for wide vectors)."""
    if len(terms) == 1:
        return terms[0]
    mid = len(terms) // 2
    return f"({bsum(terms[:mid])} + {bsum(terms[mid:])})"


def gd_sql(d: int, iters: int = 100, step: float = 1.0, xs: list[str] | None = None,
           src: str = "train") -> str:
    """CTEs ``g`` (Gram sums), ``it`` (weights per iteration) and ``hist``
    (RMSE per iteration) for features ``xs`` (default f1..fd) of ``src``."""
    xs = xs or [f"f{j + 1}" for j in range(d)]
    g_cols = ["count(*) AS n", "sum(y*y) AS yy"]
    g_cols += [f"sum({xs[i]}*{xs[j]}) AS a{i}_{j}" for i in range(d) for j in range(d) if i <= j]
    g_cols += [f"sum({xs[i]}*y) AS b{i}" for i in range(d)]

    def a(i, j):
        return f"a{min(i, j)}_{max(i, j)}"

    ws = [f"w{j}" for j in range(d)]
    upd = [f"w{j} - {step}E0 * ({bsum([f'{a(j, k)}*w{k}' for k in range(d)])} - b{j})"
           f" / (n * sqrt(i + 1))" for j in range(d)]
    quad = bsum([f"w{i}*w{j}*{a(i, j)}" for i in range(d) for j in range(d)])
    lin = bsum([f"w{j}*b{j}" for j in range(d)])
    return f"""
g AS MATERIALIZED (SELECT {', '.join(g_cols)} FROM {src}),
it(i, {', '.join(ws)}) AS (
  SELECT 0, {', '.join('0.0E0' for _ in ws)}
  UNION ALL
  SELECT i + 1, {', '.join(upd)} FROM it, g WHERE i < {iters}
),
hist AS (SELECT i, sqrt(greatest(({quad}) - 2*({lin}) + yy, 0) / n) AS rmse FROM it, g)"""


GD = gd_sql(3)
oracle("gd_weights", with_ctes(SONG_CTE, SPLIT_CTE, GD, body=f"""
SELECT CAST(j AS INTEGER) AS i, round(w, {R}) AS weight FROM (
  SELECT unnest([0, 1, 2]) AS j, unnest([w0, w1, w2]) AS w FROM it WHERE i = 100)"""))
# parity: label shifted by the minimum over all rows (before the split)
SPLIT_ALLMIN_CTE = SPLIT_CTE.replace(
    "mn AS (SELECT min(year) AS m FROM part WHERE part = 'train')",
    "mn AS (SELECT min(year) AS m FROM part)")
oracle("gd_weights_parity", with_ctes(SONG_CTE, SPLIT_ALLMIN_CTE, GD, body=f"""
SELECT CAST(j AS INTEGER) AS i, round(w, {R}) AS weight FROM (
  SELECT unnest([0, 1, 2]) AS j, unnest([w0, w1, w2]) AS w FROM it WHERE i = 100)"""))
oracle("gd_history", with_ctes(SONG_CTE, SPLIT_CTE, GD, body=f"""
SELECT CAST(i AS INTEGER) AS iteration, {rd('rmse', 'rmse')} FROM hist WHERE i < 100"""))
oracle("gd_final_rmse", with_ctes(SONG_CTE, SPLIT_CTE, GD, body=f"""
SELECT {rd('max(rmse) FILTER (WHERE i = 99)', 'last_history')},
       {rd('max(rmse) FILTER (WHERE i = 100)', 'final')} FROM hist"""))
oracle("gd_gradient", with_ctes(SONG_CTE, SPLIT_CTE, body=f"""
SELECT {rd('avg((f1 + f2 + f3 - y)*f1)', 'g1')}, {rd('avg((f1 + f2 + f3 - y)*f2)', 'g2')},
       {rd('avg((f1 + f2 + f3 - y)*f3)', 'g3')} FROM train"""))
oracle("gd_predict", with_ctes(SONG_CTE, SPLIT_CTE, GD, body=f"""
SELECT t.song_id, {rd('w0*f1 + w1*f2 + w2*f3', 'prediction')}
FROM test t, (SELECT * FROM it WHERE i = 100) w"""))
oracle("gd_test_rmse", with_ctes(SONG_CTE, SPLIT_CTE, GD, body=f"""
SELECT {rd('sqrt(avg((y - (w0*f1 + w1*f2 + w2*f3))^2))', 'rmse')}
FROM test t, (SELECT * FROM it WHERE i = 100) w"""))


# --- elastic net ---------------------------------------------------------------

def enet_sql(xs: list[str], src: str, keys: list[str], reg_expr: str, rounds: int | list[int],
             alpha: float = ALPHA, group_src: str | None = None) -> str:
    """CTEs ``st`` (per key statistics), ``cd`` (coordinate descent per key)
    and ``coef`` (unscaled coefficients c0..cd per key).

    ``src`` must expose the feature expressions' inputs, ``y`` and the key
    columns; ``reg_expr`` is the regParam column (or literal)."""
    at = rounds if isinstance(rounds, list) else [rounds]  # the rounds whose coefficients count
    rounds = max(at)
    d = len(xs)
    kcols = ", ".join(keys)
    kpre = (kcols + ", ") if keys else ""
    grp = f"GROUP BY {kcols}" if keys else ""
    stats = [f"avg(x{j}) AS mx{j}" for j in range(d)] + ["avg(y) AS my"]
    stats += [f"stddev_pop(x{j}) AS sx{j}" for j in range(d)] + ["stddev_pop(y) AS sy"]
    stats += [f"corr(x{j}, y) AS r{j}y" for j in range(d)]
    stats += [f"corr(x{i}, x{j}) AS r{i}_{j}" for i in range(d) for j in range(i + 1, d)]
    proj = ", ".join(f"{e} AS x{j}" for j, e in enumerate(xs))
    src_sel = group_src or f"SELECT {kpre}{proj}, y FROM {src}"

    def r(i, j):
        return f"r{min(i, j)}_{max(i, j)}"

    ws = [f"w{j}" for j in range(d)]
    # nested update of w0, w1, ... in turn
    level = f"SELECT {kpre}reg, i + 1 AS i, {', '.join(ws)} FROM cd WHERE i < {rounds}"
    for j in range(d):
        z = f"r{j}y" + "".join(f" - {r(j, k)}*w{k}" for k in range(d) if k != j)
        new = (f"sign({z}) * greatest(abs({z}) - reg/sy*{alpha}E0, 0) "
               f"/ (1 + reg/sy*(1 - {alpha}E0))")
        cols = [f"{new} AS w{k}" if k == j else f"l.w{k}" for k in range(d)]
        on = " AND ".join(f"l.{k} = st.{k}" for k in keys) or "TRUE"
        level = (f"SELECT {''.join(f'l.{k}, ' for k in keys)}l.reg, l.i, {', '.join(cols)} "
                 f"FROM ({level}) l JOIN st ON {on}")
    seeds = f"SELECT {kpre}{reg_expr} AS reg, 0 AS i, {', '.join('0.0E0' for _ in ws)} FROM st"
    unscale = [f"w{j} * sy / sx{j} AS c{j + 1}" for j in range(d)]
    c0 = "my - (" + " + ".join(f"w{j} * sy / sx{j} * mx{j}" for j in range(d)) + ") AS c0"
    on2 = " AND ".join(f"cd.{k} = st.{k}" for k in keys) or "TRUE"
    kq = "".join(f"cd.{k}, " for k in keys)
    return f"""
st AS MATERIALIZED (SELECT {kpre}{', '.join(stats)} FROM ({src_sel}) {grp}),
cd({kpre}reg, i, {', '.join(ws)}) AS (
  {seeds}
  UNION ALL
  SELECT * FROM ({level})
),
coef AS (SELECT {kq}cd.reg, cd.i, {c0}, {', '.join(unscale)}
         FROM cd JOIN st ON {on2} WHERE cd.i IN ({', '.join(str(x) for x in at)}))"""


def enet_sql_named(prefix: str, *args, **kwargs) -> str:
    """:func:`enet_sql` with its CTEs renamed ``{prefix}st``/``cd``/``coef``,
    so several fits can share one statement."""
    import re
    sql = enet_sql(*args, **kwargs)
    return re.sub(r"\b(st|cd|coef)\b", lambda m: prefix + m.group(1), sql)


def _pred(xs: list[str]) -> str:
    return "c0 + " + " + ".join(f"c{j + 1}*{e}" for j, e in enumerate(xs))


X3 = ["f1", "f2", "f3"]
#: Rounds of coordinate descent after which no coefficient moves in its 9th decimal:
#: three nearly uncorrelated features, nine collinear terms.
SETTLED_3, SETTLED_9 = 60, 1500


def _settled(xs: list[str]) -> int:
    return SETTLED_9 if len(xs) > 3 else SETTLED_3


EN3 = enet_sql(X3, "train", [], f"{REG}E0", SETTLED_3)
oracle("enet_coefficients", with_ctes(SONG_CTE, SPLIT_CTE, EN3, body=f"""
SELECT term, CASE WHEN value = 0 THEN 0.0E0 ELSE round(value, {R}) END AS value FROM (
  SELECT unnest(['intercept', 'x1', 'x2', 'x3']) AS term, unnest([c0, c1, c2, c3]) AS value
  FROM coef)"""))
oracle("enet_train_metrics", with_ctes(SONG_CTE, SPLIT_CTE, EN3, body=f"""
SELECT {rd('sqrt(avg(e*e))', 'rmse')}, {rd('avg(e*e)', 'mse')}, {rd('avg(abs(e))', 'mae')}
FROM (SELECT y - ({_pred(X3)}) AS e FROM train, coef)"""))
oracle("enet_predict", with_ctes(SONG_CTE, SPLIT_CTE, EN3, body=f"""
SELECT song_id, {rd(_pred(X3), 'prediction')} FROM test, coef"""))
oracle("enet_test_rmse", with_ctes(SONG_CTE, SPLIT_CTE, EN3, body=f"""
SELECT {rd('sqrt(avg((y - (' + _pred(X3) + '))^2))', 'rmse')} FROM test, coef"""))

EN9 = enet_sql(POLY_EXPR, "train", [], f"{REG}E0", SETTLED_9)
oracle("poly_enet_test_rmse", with_ctes(SONG_CTE, SPLIT_CTE, EN9, body=f"""
SELECT {rd('sqrt(avg((y - (' + _pred(POLY_EXPR) + '))^2))', 'rmse')} FROM test, coef"""))

# cross-validation: statistics of the other folds per held-out fold k


def cv_sql(xs: list[str], label_offset: str = "0") -> tuple[str, str]:
    """CTE text for CV over the grid on features ``xs`` (column expressions
    over f1..f3): per held-out fold k, moments of the other folds, coordinate
    descent per (k, reg) until it has settled (every maxIter of the grid is enough
    for the fit), RMSE on fold k, mean over folds. The intercept absorbs the label's
    shift, so the minimum over all training rows does as well as that of each fold;
    ``label_offset`` is what the scored label has on top of the fold's own."""
    regs = ", ".join(f"{r}E0" for r in GRID_REG)
    src = ("SELECT k.k, " + ", ".join(f"{e} AS x{j}" for j, e in enumerate(xs))
           + ", t.y FROM train t JOIN (SELECT unnest([0, 1, 2]) AS k) k ON t.fold <> k.k")
    en = enet_sql(xs, "", ["k"], "unnest([" + regs + "])", _settled(xs), group_src=src)
    qual = [e.replace("f1", "t.f1").replace("f2", "t.f2").replace("f3", "t.f3") for e in xs]
    body = f"""
fold_min AS (SELECT k, min(year) AS m FROM train JOIN (SELECT unnest([0, 1, 2]) AS k) ON fold <> k GROUP BY k),
fold_rmse AS (
  SELECT c.k, c.i, c.reg, sqrt(avg((t.y + {label_offset} - ({_pred(qual)}))^2)) AS rmse
  FROM coef c JOIN train t ON t.fold = c.k JOIN fold_min o ON o.k = c.k GROUP BY c.k, c.i, c.reg
),
grid AS (SELECT CAST(max_iter AS INTEGER) AS max_iter, reg AS reg_param, avg(rmse) AS avg_rmse
         FROM fold_rmse, (SELECT unnest({GRID_MAX_ITER}) AS max_iter) GROUP BY max_iter, reg)"""
    return en, body


for _pre, _xs in (("", X3), ("poly_", POLY_EXPR)):
    _en, _body = cv_sql(_xs)
    oracle(_pre + "cv_metrics", with_ctes(SONG_CTE, SPLIT_CTE, _en, _body, body=f"""
SELECT max_iter, reg_param, {rd('avg_rmse', 'avg_rmse')} FROM grid"""))
    oracle(_pre + "cv_best", with_ctes(SONG_CTE, SPLIT_CTE, _en, _body, body=f"""
SELECT max_iter, reg_param, {rd('avg_rmse', 'avg_rmse')} FROM grid
ORDER BY round(avg_rmse, 9), max_iter, reg_param LIMIT 1"""))

# parity: scored against the unshifted year (label + the minimum learned without the fold)
_en, _body = cv_sql(X3, label_offset="o.m")
oracle("cv_parity_metrics", with_ctes(SONG_CTE, SPLIT_CTE, _en, _body, body=f"""
SELECT max_iter, reg_param, {rd('avg_rmse', 'avg_rmse')} FROM grid"""))


# best CV setting refitted on all training rows: training summary and test RMSE
_en, _body = cv_sql(X3)
_full = enet_sql_named("full_", X3, "train", [], "unnest([" + ", ".join(
    f"{r}E0" for r in GRID_REG) + "])", SETTLED_3)
_BEST = """
best AS (SELECT reg_param AS reg, max_iter FROM grid ORDER BY round(avg_rmse, 9), max_iter, reg_param LIMIT 1),
best_coef AS (SELECT f.* FROM full_coef f JOIN best b ON f.reg = b.reg)"""
oracle("cv_best_train_metrics", with_ctes(SONG_CTE, SPLIT_CTE, _en, _body, _full, _BEST, body=f"""
SELECT {rd('sqrt(avg(e*e))', 'rmse')}, {rd('avg(e*e)', 'mse')}, {rd('avg(abs(e))', 'mae')}
FROM (SELECT y - ({_pred(X3)}) AS e FROM train, best_coef)"""))
oracle("cv_best_test_rmse", with_ctes(SONG_CTE, SPLIT_CTE, _en, _body, _full, _BEST, body=f"""
SELECT {rd('sqrt(avg((y - (' + _pred(X3) + '))^2))', 'rmse')} FROM test, best_coef"""))

_pen, _pbody = cv_sql(POLY_EXPR)
_pfull = enet_sql_named("full_", POLY_EXPR, "train", [], "unnest([" + ", ".join(
    f"{r}E0" for r in GRID_REG) + "])", SETTLED_9)
oracle("poly_cv_best_test_rmse", with_ctes(SONG_CTE, SPLIT_CTE, _pen, _pbody, _pfull, _BEST,
                                           body=f"""
SELECT {rd('sqrt(avg((y - (' + _pred(POLY_EXPR) + '))^2))', 'rmse')} FROM test, best_coef"""))


def gd_cv_sql() -> str:
    """Per step and held-out fold: descent on the other folds, RMSE on the fold
    at each grid maxIter; averaged over folds."""
    import re
    ctes, scores = [], []
    for s, step in enumerate(GD_GRID_STEP):
        for k in range(3):
            # the label's minimum is that of the other folds
            held = f"(SELECT f1, f2, f3, fold, year - (SELECT min(year) FROM train WHERE fold <> {k}) AS y FROM train)"
            sql = gd_sql(3, max(GD_GRID_ITERS), step, src=f"(SELECT * FROM {held} WHERE fold <> {k})")
            ctes.append(re.sub(r"\b(g|it|hist)\b", rf"\1_{s}_{k}", sql))
            scores.append(f"SELECT i, {step}E0 AS step, sqrt(avg((y - (w0*f1 + w1*f2 + w2*f3))^2)) AS rmse "
                          f"FROM {held}, it_{s}_{k} WHERE fold = {k} AND i IN ({', '.join(map(str, GD_GRID_ITERS))}) GROUP BY i")
    return with_ctes(SONG_CTE, SPLIT_CTE, *ctes, body=f"""
SELECT CAST(i AS INTEGER) AS max_iter, step AS step_size, {rd('avg(rmse)', 'avg_rmse')}
FROM ({' UNION ALL '.join(scores)}) GROUP BY i, step""")


oracle("gd_cv_metrics", gd_cv_sql())

oracle("cv_fold_offsets", with_ctes(SONG_CTE, SPLIT_CTE, body="""
SELECT CAST(k AS INTEGER) AS fold, min(year) AS offset
FROM train JOIN (SELECT unnest([-1, 0, 1, 2]) AS k) ON fold <> k GROUP BY k"""))

# --- user aggregates -----------------------------------------------------------------
ERA = "CASE WHEN CAST(floor(year / 10) AS INTEGER) % 4 = 0 THEN CAST(floor(year / 10) AS INTEGER) * 10 ELSE -1 END"
oracle("user_reduce", with_ctes(SONG_CTE, body=f"""
SELECT CAST({ERA} AS INTEGER) AS era, max(f1) AS top1, max(f2) AS top2, max(f3) AS top3 FROM song GROUP BY 1"""))
oracle("user_aggregate", with_ctes(SONG_CTE, body=f"""
SELECT CAST({ERA} AS INTEGER) AS era, count(*) AS n, {rd('avg(f1)', 'mean')}, {rd('var_pop(f1)', 'variance')},
  {', '.join(f'count(*) FILTER (WHERE floor(f2 * 10) = {i}) AS t{i}' for i in range(11))} FROM song GROUP BY 1"""))

# --- one to many ------------------------------------------------------------------------
oracle("one_to_many_stage", with_ctes(SONG_CTE, """
high AS (SELECT song_id, list_filter(list_transform([f1, f2, f3, f4, f5, f6, f7, f8, f9, f10, f11, f12],
    lambda v, i: {'field': i, 'level': v}), lambda e: e.level > 0.9) AS h FROM song),
each AS (SELECT song_id, h, unnest(CASE WHEN len(h) = 0 THEN [NULL] ELSE range(1, len(h) + 1) END) AS k FROM high)""", body="""
SELECT song_id, CAST(k - 1 AS BIGINT) AS nth, CAST(h[k].field AS INTEGER) AS field, h[k].level AS level FROM each"""))
