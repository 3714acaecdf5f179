"""Linear models on vectors too wide for a d x d matrix on the driver.

The one thing asked of the rows is a pass that multiplies the (centred, scaled)
second-moment matrix with a block of ``k`` directions: ``Z' Z V``, d x k numbers,
as a user aggregate whose states merge in a tree. The solvers keep the directions
multiplied so far and work inside their span on the driver, where the products
are known exactly. Every pass adds the directions that matter most, so a pass is
worth many steps of a plain loop.

* :func:`descend_in_span` follows gradient descent. What the steps lose outside the
  span is known, and bounds the error of the weights.
* :func:`elastic_net_by_columns` holds the columns of the coefficients that are not
  zero, and is done when the others meet their optimality conditions.
* :func:`ridge_in_span` solves the normal equations where there is no L1 term.

With ``state_key`` a solver writes basis and products to the shared folder after
every pass, and a driver that starts again on the same rows continues there. A
complete fit removes its state.
"""

from __future__ import annotations

import io
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import Aggregator, aggregate
from .stats import check_rows

#: Directions per pass.
BLOCK = 16


def _rows(batch, d: int):
    """(x, y, rows of another size, bad rows) of an Arrow batch with columns x and y."""
    import pyarrow as pa
    import pyarrow.compute as pc
    sizes = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
    whole = sizes == d
    off = bad = 0
    if not whole.all():
        bad = int(np.isnan(np.asarray(sizes, dtype=float)).sum())
        off = int((~whole).sum()) - bad
        batch = batch.filter(pa.array(whole))
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
    y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
    finite = np.isfinite(x).all(axis=1) & np.isfinite(y)
    if not finite.all():
        bad += int((~finite).sum())
        x, y = x[finite], y[finite]
    return x, y, off, bad


class _State(Aggregator):
    schema = "state binary"

    def dump(self, state):
        out = io.BytesIO()
        np.savez(out, *state)
        return out.getvalue()

    def load(self, data):
        with np.load(io.BytesIO(data)) as f:
            return tuple(f[k] for k in f.files)

    def finish(self, state):
        return (self.dump(state),)


class Spreads(_State):
    """n, rows off, bad rows, and the means, squared deviations and products with
    the label's deviation of every column; the label is the last."""

    def __init__(self, d: int):
        self.d, self.state_bytes = d, 24 * (d + 2) + 4096

    def zero(self):
        return np.zeros(3), np.zeros(self.d + 1), np.zeros(self.d + 1), np.zeros(self.d + 1)

    def update(self, state, rows):
        x, y, off, bad = _rows(rows, self.d)
        counts = np.array([len(y), off, bad], float)
        if not len(y):
            return self.merge(state, (counts, *self.zero()[1:]))
        z = np.column_stack([x, y])
        mean = z.mean(axis=0)
        z -= mean
        return self.merge(state, (counts, mean, (z * z).sum(axis=0), z.T @ z[:, -1]))

    def merge(self, a, b):
        n, m = a[0][0], b[0][0]
        if not n or not m:
            return (a[0] + b[0], *(b if m else a)[1:])
        gap, share = b[1] - a[1], n * m / (n + m)
        return a[0] + b[0], a[1] + gap * (m / (n + m)), a[2] + b[2] + gap * gap * share, a[3] + b[3] + gap * gap[-1] * share


class Products(_State):
    """n, rows off, bad rows, ``y.y`` and the sum of squares of Z; ``Z' y``; ``Z' Z V``, for
    rows ``z = (x - centre) / scale``. ``V`` is a matrix, or the numbers of unit vectors
    among ``d``."""

    def __init__(self, V: np.ndarray, centre: np.ndarray | None = None, scale: np.ndarray | None = None, d: int | None = None):
        self.V, self.centre, self.scale = V, centre, scale
        self.shape = V.shape if V.ndim == 2 else (d, len(V))
        self.state_bytes = 8 * (self.shape[0] * (self.shape[1] + 1)) + 8192

    def zero(self):
        return np.zeros(5), np.zeros(self.shape[0]), np.zeros(self.shape)

    def update(self, state, rows):
        x, y, off, bad = _rows(rows, self.shape[0])
        if self.centre is not None:
            x = (x - self.centre) / self.scale
        with np.errstate(over="ignore", invalid="ignore"):
            part = x @ self.V if self.V.ndim == 2 else x[:, self.V]
            return self.merge(state, (np.array([len(y), off, bad, y @ y, (x * x).sum()]), x.T @ y, x.T @ part))

    def merge(self, a, b):
        return tuple(s + t for s, t in zip(a, b, strict=True))


def _passed(data: DataFrame, features: str, label: str, agg: _State, d: int):
    """The aggregate's state over the rows, which are validated like those of the moments."""
    src = data.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y"))
    found = aggregate(src, agg, ["x", "y"]).collect()  # one row
    state = agg.load(bytes(found[0]["state"])) if found else agg.zero()
    check_rows(d, state[0][1], state[0][2])
    if not state[0][0]:
        raise ValueError("empty training set: no rows to learn from")
    return state


@dataclass
class Span:
    """Orthonormal directions ``S`` and their products with the matrix."""

    S: np.ndarray
    GS: np.ndarray

    @property
    def inner(self) -> np.ndarray:
        a = self.S.T @ self.GS
        return (a + a.T) / 2

    def outside(self, X: np.ndarray) -> np.ndarray:
        """The parts of the columns of X outside the span (removed twice, for accuracy)."""
        for _ in range(2):
            X = X - self.S @ (self.S.T @ X)
        return X

    def fresh(self, wanted: list[np.ndarray], k: int) -> np.ndarray:
        """At most ``k`` orthonormal directions outside the span, from the columns of
        ``wanted`` in order; what is left is filled with the products' largest parts."""
        d, m = self.S.shape
        k = min(k, d - m)
        found = np.zeros((d, 0))
        rest = np.zeros((d, 0))
        if m and k:
            left, size, _ = np.linalg.svd(self.outside(self.GS[:, -2 * k:]), full_matrices=False)
            rest = left[:, size > 1e-10 * max(float(np.abs(self.GS).max()), 1e-300)]
        for block in [*wanted, rest]:
            block = block.reshape(d, -1)
            sizes = np.linalg.norm(block, axis=0)
            block = block[:, sizes > 0] / sizes[sizes > 0]
            for x in self.outside(block).T if m else block.T:
                if found.shape[1] == k:
                    return found
                y = x - found @ (found.T @ x)
                if np.linalg.norm(y) <= 1e-8:
                    continue
                for _ in range(2):  # once more from a vector of length 1, which leaves no rounding
                    y = y / np.linalg.norm(y)
                    y = y - self.S @ (self.S.T @ y) - found @ (found.T @ y)
                found = np.column_stack([found, y / np.linalg.norm(y)])
        return found

    def grown(self, V: np.ndarray, GV: np.ndarray) -> Span:
        return Span(np.column_stack([self.S, V]), np.column_stack([self.GS, GV]))


def _random_block(d: int, k: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(7).normal(size=(d, min(k, d))))[0]


class Saved:
    """A solver's state in the shared folder, one file a pass."""

    def __init__(self, df: DataFrame, key: str | None, kind: str, d: int):
        self.spark, self.path, self.d = df.sparkSession, None, d
        if key:
            from ..session import checkpoint_root
            self.path = f"{checkpoint_root(self.spark)}/cadenza/solver-{kind}-{key}"

    def load(self) -> dict[str, np.ndarray] | None:
        from ..sources import storage
        if not self.path or not (files := storage.glob(self.spark, f"{self.path}/*.npz")):
            return None
        with np.load(io.BytesIO(storage.read_bytes(self.spark, files[-1][0]))) as f:
            held = {k: f[k] for k in f.files}
        if held["d"] != self.d:
            raise ValueError(f"the state {self.path} is of vectors of size {held['d']}, not {self.d}")
        return held

    def done(self) -> None:
        """The fit is complete: its state goes, so that its name can be used again."""
        from ..sources import storage
        if self.path:
            storage.remove(self.spark, self.path)

    def store(self, number: int, **arrays) -> None:
        from ..sources import storage
        if self.path:
            out = io.BytesIO()
            np.savez(out, **arrays | {"d": self.d})
            storage.write_bytes(self.spark, f"{self.path}/{number:06d}.npz", out.getvalue())


def _trajectory(span: Span, b: np.ndarray, yy: float, n: float, trace: float, iters: int, step: float):
    """(weights, history, final RMSE, error bound, directions lost) of the steps inside the span."""
    A, c = span.inner, span.S.T @ b
    # the part of a gradient outside the span, for coordinates (y, -1)
    basis, factor = np.linalg.qr(span.outside(np.column_stack([span.GS, b])))
    ritz = float(np.linalg.eigvalsh(A)[-1])
    largest = min(trace, 1.05 * (ritz + float(np.linalg.norm(factor[:, :-1], 2))))
    y, hist, bound, lost = np.zeros(len(c)), [], 0.0, []

    def rmse():
        return math.sqrt(max(float(y @ A @ y - 2.0 * y @ c + yy), 0.0) / n)
    for i in range(iters):
        with np.errstate(over="ignore", invalid="ignore"):
            hist.append(rmse())
            rate = step / (n * math.sqrt(i + 1))
            lost.append(rate * (factor @ np.append(y, -1.0)))
            bound = bound * max(1.0, rate * largest - 1.0) + float(np.linalg.norm(lost[-1]))
            y = y - rate * (A @ y - c)
        if not np.all(np.isfinite(y)):
            raise FloatingPointError(f"gradient descent diverged at iteration {i}; scale the features or lower stepSize")
    left, size, _ = np.linalg.svd(np.array(lost).T, full_matrices=False)
    return span.S @ y, hist, rmse(), bound, basis @ left[:, size > 1e-3 * size[0]] if size[0] else basis[:, :0]


def descend_in_span(data: DataFrame, features: str, label: str, d: int, iters: int, step: float,
                    block: int = BLOCK, tol: float = 1e-10, state_key: str | None = None):
    """(weights, history, final RMSE, passes) of ``iters`` steps of gradient descent.

    The weights are within ``tol`` of their length of those of the plain loop, by a
    bound that follows the part of every step outside the span; a span of all d
    dimensions, or one that the matrix does not leave, is exact.
    """
    saved = Saved(data, state_key, "descent", d)
    held = saved.load()
    if held is None:
        V = _random_block(d, block)
        counts, b, GV = _passed(data, features, label, Products(V), d)
        n, yy, trace = counts[0], counts[3], counts[4]
        span, passes = Span(V, GV), 1
        saved.store(passes, S=span.S, GS=span.GS, b=b, scalars=np.array([n, yy, trace, passes]))
    else:
        span, b = Span(held["S"], held["GS"]), held["b"]
        n, yy, trace, passes = held["scalars"]
        passes = int(passes)
    if not iters:
        return np.zeros(d), [], math.sqrt(yy / n), passes
    while True:
        w, hist, final, bound, lost = _trajectory(span, b, yy, n, trace, iters, step)
        close = bound <= tol * max(float(np.linalg.norm(w)), 1e-300)
        V = np.zeros((d, 0)) if close or span.S.shape[1] == d else span.fresh([b, lost], block)
        if not V.shape[1]:
            saved.done()
            return w, hist, final, passes
        span = span.grown(V, _passed(data, features, label, Products(V), d)[2])
        passes += 1
        saved.store(passes, S=span.S, GS=span.GS, b=b, scalars=np.array([n, yy, trace, passes]))


@dataclass
class Standard:
    """A standardised problem: ``r`` are the features' correlations with the label."""

    n: float
    mean: np.ndarray
    scale: np.ndarray
    live: np.ndarray
    sy: float
    r: np.ndarray

    @staticmethod
    def of(n: float, mean: np.ndarray, squares: np.ndarray, cross: np.ndarray) -> Standard:
        sd = np.sqrt(np.maximum(squares, 0.0) / n)
        live, sy = sd[:-1] > 0, float(sd[-1])
        scale = np.where(live, sd[:-1], 1.0)
        return Standard(n, mean, scale, live, sy, np.where(live, cross[:-1] / n / (scale * (sy or 1.0)), 0.0))

    def unscaled(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """(coefficients, intercept)."""
        coef = np.where(self.live, w * self.sy / self.scale, 0.0) + 0.0
        return coef, float(self.mean[-1] - coef @ self.mean[:-1])


def _standard(data, features: str, label: str, d: int, saved: Saved):
    """(problem, state saved so far, passes)."""
    held = saved.load()
    if held is not None:
        return Standard.of(held["scalars"][0], held["mean"], held["squares"], held["cross"]), held, int(held["scalars"][1])
    counts, mean, squares, cross = _passed(data, features, label, Spreads(d), d)
    held = {"mean": mean, "squares": squares, "cross": cross, "scalars": np.array([counts[0], 1.0])}
    saved.store(1, **held)
    return Standard.of(counts[0], mean, squares, cross), held, 1


#: Columns of the correlation matrix that a fit may hold on the driver, d numbers each.
MOST_COLUMNS = 4096


def elastic_net_by_columns(data: DataFrame, features: str, label: str, d: int, reg: float, alpha: float,
                           max_passes: int, tol: float = 1e-9, block: int = 8 * BLOCK, most: int = MOST_COLUMNS,
                           state_key: str | None = None):
    """(coefficients, intercept, passes, converged) of the elastic net of :mod:`.linreg`.

    A pass gives ``block`` whole columns of the correlation matrix. The problem over
    the columns held is solved exactly; the gradient of all d coefficients is then
    known, and the coefficients that miss their optimality condition most are
    the next pass's columns. When none misses it by more than ``tol``, the solution is
    that of the whole problem. Needs about as many columns as it has coefficients
    that are not zero; with more than ``most`` it ends without having converged.
    """
    from .linreg import settle
    saved = Saved(data, state_key, "elastic", d)
    p, held, passes = _standard(data, features, label, d, saved)
    if p.sy == 0.0 or not p.live.any():
        return *p.unscaled(np.zeros(d)), passes, True
    l1, l2 = reg / p.sy * alpha, reg / p.sy * (1.0 - alpha)
    at, columns = held.get("at", np.zeros(0, np.int64)), held.get("columns", np.zeros((d, 0)))
    w = np.zeros(d)
    while True:
        if len(at):
            R = columns[at]
            w[at], _, solved = settle((R + R.T) / 2, p.r[at], l1, l2, w[at], tol * 0.1, 10_000)
        g = columns @ w[at] - p.r
        missed = np.where(p.live, np.abs(g) - l1, 0.0)
        missed[at] = 0.0
        worst = np.argsort(-missed, kind="stable")[:block]
        worst = worst[missed[worst] > tol]
        if not len(worst) or passes >= max_passes or len(at) + len(worst) > most:
            saved.done()
            return *p.unscaled(w), passes, not len(worst) and (not len(at) or solved)
        found = _passed(data, features, label, Products(np.sort(worst), p.mean[:-1], p.scale, d), d)[2] / p.n
        at, columns, passes = np.append(at, np.sort(worst)), np.column_stack([columns, found]), passes + 1
        saved.store(passes, **held | {"at": at, "columns": columns, "scalars": np.array([p.n, float(passes)])})


def ridge_in_span(data: DataFrame, features: str, label: str, d: int, reg: float, max_passes: int, tol: float = 1e-9,
                  block: int = BLOCK, state_key: str | None = None):
    """(coefficients, intercept, passes, converged) without an L1 term: the normal
    equations, over a span that grows by the residual and the products' largest parts."""
    saved = Saved(data, state_key, "ridge", d)
    p, held, passes = _standard(data, features, label, d, saved)
    if p.sy == 0.0 or not p.live.any():
        return *p.unscaled(np.zeros(d)), passes, True
    l2 = reg / p.sy
    span = Span(held.get("S", np.zeros((d, 0))), held.get("GS", np.zeros((d, 0))))
    w, rest = np.zeros(d), p.r
    while True:
        if span.S.shape[1]:
            z = np.linalg.lstsq(span.inner + l2 * np.eye(span.S.shape[1]), span.S.T @ p.r, rcond=None)[0]
            w, rest = span.S @ z, p.r - span.GS @ z - l2 * (span.S @ z)
        converged = float(np.linalg.norm(rest)) <= tol * max(float(np.linalg.norm(p.r)), 1e-300)
        V = np.zeros((d, 0)) if converged or passes >= max_passes else span.fresh([rest, *([] if span.S.shape[1] else [_random_block(d, block)])], block)
        if not V.shape[1]:
            saved.done()
            return *p.unscaled(w), passes, converged
        GV = _passed(data, features, label, Products(V, p.mean[:-1], p.scale), d)[2] / p.n
        span, passes = span.grown(V, GV), passes + 1
        saved.store(passes, **held | {"S": span.S, "GS": span.GS, "scalars": np.array([p.n, float(passes)])})
