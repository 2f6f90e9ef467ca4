"""Logistic and Huber regressions, many at a time, by Newton steps on sums of weighted cross-products.

A step is one pass over the table for all fits together: every fit's objective, gradient and curvature at its
present coefficients are sums over rows, and only these sums, some 2 * (features + 2)**2 numbers a fit, reach
the driver. Coefficients are found to a gradient of 1e-9, so that they can be checked and repeated elsewhere. A
step that does not lower the (convex) objective is taken back: reweighted least squares step in for it, whose
sums came with the same pass, and if they do no better, the step is halved.

Logistic: mean log loss plus `ridge` / 2 times the squares of the coefficients of features in units of their
standard deviation. Huber: the joint estimate of slope and scale, mean of sigma + sigma * H(residual / sigma), with
H(z) = z**2 up to `epsilon` and 2 * epsilon * |z| - epsilon**2 beyond. Where most residuals vanish the scale has no
positive minimum; it then stays at SCALE_FLOOR standard deviations of the label.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.functions.batches import map_batches, matrix

log = logging.getLogger(__name__)

LOGISTIC, HUBER = "logistic", "huber"
SCALE_FLOOR = 1e-6
STEPS, GRADIENT = 100, 1e-9
# Combinations of features that vary by less than this share of the largest count as constant.
LEAST_SHARE = 1e-11


@dataclass(frozen=True)
class Problem:
    """A fit of column `label` on the rows outside `fold`, or on all rows."""

    kind: str
    label: str
    fold: int | None = None
    ridge: float = 0.0
    epsilon: float = 1.35


@dataclass
class Solution:
    """Coefficients in units of standard deviations (`beta`, the intercept last, and for Huber the scale)."""

    problem: Problem
    rows: int
    mean: np.ndarray
    deviation: np.ndarray
    label_mean: float = 0.0
    label_deviation: float = 1.0
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))
    gradient: float = np.inf
    steps: int = 0

    def __post_init__(self):
        huber = self.problem.kind == HUBER
        self.beta = np.zeros(len(self.mean) + 1 + huber)
        if huber:
            self.beta[-1] = 1.0

    @property
    def slopes(self) -> np.ndarray:
        """For features in their own units; a feature that does not vary has none."""
        used = self.deviation > 0
        width = len(self.mean)
        return np.where(used, self.beta[:width] / np.where(used, self.deviation, 1.0), 0.0) * self.label_deviation

    @property
    def intercept(self) -> float:
        centre = self.beta[len(self.mean)] * self.label_deviation + self.label_mean
        return float(centre - self.slopes @ self.mean)

    @property
    def scale(self) -> float | None:
        return float(self.beta[-1] * self.label_deviation) if self.problem.kind == HUBER else None

    def linear(self, features: Column) -> Column:
        slopes = F.array(*[F.lit(float(b)) for b in self.slopes])
        products = F.zip_with(features, slopes, lambda x, b: x * b)
        return F.aggregate(products, F.lit(self.intercept), lambda total, p: total + p)

    def standardised(self, values: np.ndarray) -> np.ndarray:
        used = self.deviation > 0
        out = np.where(used, (values - self.mean) / np.where(used, self.deviation, 1.0), 0.0)
        return np.column_stack([out, np.ones(len(out))])

    def sums(self, values: np.ndarray, label: np.ndarray, beta: np.ndarray) -> np.ndarray:
        """Objective, gradient and curvature at `beta`, summed over rows, in one array; for Huber also the sums of
        reweighted least squares: weighted products of the features and with the label, and rows and squared
        residuals within epsilon."""
        x = self.standardised(values)
        if self.problem.kind == LOGISTIC:
            eta = x @ beta
            p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
            value = np.logaddexp(0.0, eta).sum() - (label * eta).sum()
            return np.concatenate([[value], x.T @ (p - label), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
        y, sigma, most = (label - self.label_mean) / self.label_deviation, beta[-1], self.problem.epsilon
        z = (y - x @ beta[:-1]) / sigma
        inside = np.abs(z) <= most
        loss = np.where(inside, z * z, 2 * most * np.abs(z) - most * most)
        slope = 2 * np.clip(z, -most, most)
        gradient = np.append(-(x.T @ slope), (1 + loss - z * slope).sum())
        own = np.column_stack([x[inside], z[inside]])
        curvature = 2 / sigma * (own.T @ own)
        weighted = x * np.minimum(1.0, most / np.maximum(np.abs(z), 1e-300))[:, None]
        again = [(weighted.T @ x).ravel(), weighted.T @ y, [inside.sum(), ((z[inside] * sigma) ** 2).sum()]]
        return np.concatenate([[(sigma + sigma * loss).sum()], gradient, curvature.ravel(), *again])


def _moments(rows: DataFrame, width: int, labels: Sequence[str]) -> list:
    """Rows, means and squared deviations by fold."""
    columns = [F.col("features")[j] for j in range(width)] + [F.col(c).cast("double") for c in labels]
    return (
        rows.groupBy("fold")
        .agg(
            F.count("*").alias("rows"),
            F.array(*[F.avg(c) for c in columns]).alias("mean"),
            F.array(*[F.var_pop(c) for c in columns]).alias("variance"),
        )
        .orderBy("fold")
        .collect()
    )


def _started(problem: Problem, moments: list, width: int, labels: Sequence[str]) -> Solution:
    """Means and sample deviations of the rows that the fit is made on, from those of the folds."""
    n, mean, squares = 0, np.zeros(width + len(labels)), np.zeros(width + len(labels))
    for row in moments:
        if row["fold"] != problem.fold:
            own, apart = row["rows"], np.array(row["mean"]) - mean
            squares += np.array(row["variance"]) * own + apart**2 * n * own / (n + own)
            mean = mean + apart * own / (n + own)
            n += own
    deviation = np.sqrt(squares / max(n - 1, 1))
    deviation[deviation <= 1e-12 * np.abs(mean)] = 0.0
    found = Solution(problem, n, mean[:width], deviation[:width])
    if problem.kind == HUBER:
        at = width + labels.index(problem.label)
        found.label_mean, found.label_deviation = float(mean[at]), float(deviation[at]) or 1.0
    return found


def _summed(rows: DataFrame, at: dict[int, np.ndarray], solutions: list[Solution], width: int) -> dict[int, np.ndarray]:
    """The sums of every open fit at its coefficients, from one pass."""
    labels = sorted({solutions[k].problem.label for k in at})

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            values, fold = matrix(batch.column(0), width), batch.column(1).to_numpy(zero_copy_only=False)
            columns = {c: batch.column(2 + i).to_numpy(zero_copy_only=False) for i, c in enumerate(labels)}
            for k, beta in at.items():
                problem = solutions[k].problem
                use = slice(None) if problem.fold is None else fold != problem.fold
                found = solutions[k].sums(values[use], columns[problem.label][use], beta)
                totals[k] = totals[k] + found if k in totals else found
        for k, total in totals.items():
            cells = np.arange(len(total), dtype=np.int32)
            arrays = [pa.array(np.full(len(total), k, np.int32)), pa.array(cells), pa.array(total)]
            yield pa.RecordBatch.from_arrays(arrays, ["fit", "cell", "value"])

    source = rows.select("features", "fold", *[F.col(c).cast("double").alias(c) for c in labels])
    sums = map_batches(source, run, "fit int, cell int, value double").groupBy("fit", "cell")
    found = sums.agg(F.sum("value").alias("value")).toArrow()
    fit, cell, value = (found.column(c).to_numpy() for c in ("fit", "cell", "value"))
    out = {}
    for k in at:
        own = fit == k
        out[k] = np.zeros(own.sum())
        out[k][cell[own]] = value[own]
    return out


def _objective(solution: Solution, beta: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean objective, gradient and curvature, with the ridge."""
    size, n = len(beta), solution.rows
    value, gradient = sums[0] / n, sums[1 : 1 + size] / n
    curvature = sums[1 + size : 1 + size + size * size].reshape(size, size) / n
    ridge = np.zeros(size)
    ridge[: len(solution.mean)] = solution.problem.ridge
    return value + (ridge * beta * beta).sum() / 2, gradient + ridge * beta, curvature + np.diag(ridge)


def _step(solution: Solution, beta: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> tuple[np.ndarray | None, float]:
    """Newton's step, and the largest component of the gradient that is not held by a bound. No step where the
    curvature says nothing of the gradient's direction, or leads the scale far below what it is."""
    size, width = len(beta), len(solution.mean)
    open_ = np.ones(size, bool)
    open_[:width] = solution.deviation > 0
    if solution.problem.kind == HUBER and beta[-1] <= SCALE_FLOOR and gradient[-1] >= 0:
        open_[-1] = False
    own = np.flatnonzero(open_)
    step = np.zeros(size)
    # Least squares, since features may follow from one another or no row may lie within epsilon.
    matrix_, slope = curvature[np.ix_(own, own)], gradient[own]
    step[own] = -np.linalg.lstsq(matrix_, slope, rcond=LEAST_SHARE)[0]
    missed = np.abs(matrix_ @ step[own] + slope).max(initial=0.0) > 1e-6 * np.abs(slope).max(initial=0.0)
    shrunk = solution.problem.kind == HUBER and beta[-1] + step[-1] < beta[-1] / 5
    return None if missed or shrunk else step, float(np.abs(slope).max(initial=0.0))


def _reweighted(solution: Solution, beta: np.ndarray, sums: np.ndarray) -> np.ndarray | None:
    """The way to the coefficients of weighted least squares and the scale that the present residuals ask for."""
    if solution.problem.kind != HUBER:
        return None
    size = len(beta)
    rest = sums[1 + size + size * size :]
    width = size - 1
    products, label = rest[: width * width].reshape(width, width), rest[width * width : -2]
    slopes = np.linalg.lstsq(products, label, rcond=LEAST_SHARE)[0]
    inside, squares = rest[-2:]
    free = solution.rows - solution.problem.epsilon**2 * (solution.rows - inside)
    # With too many rows beyond epsilon a larger scale is better, whatever their residuals.
    scale = np.sqrt(squares / free) if free > 0 else 10 * beta[-1]
    return np.append(slopes, scale) - beta


def _bounded(solution: Solution, beta: np.ndarray) -> np.ndarray:
    if solution.problem.kind == HUBER:
        beta = beta.copy()
        beta[-1] = max(beta[-1], SCALE_FLOOR)
    return beta


def solve(rows: DataFrame, problems: Sequence[Problem], width: int) -> list[Solution]:
    """Solutions of all problems. `rows`: features (array of `width` numbers), fold and the labels.

    Pass a written table: it is read once for the moments and once a step."""
    labels = sorted({p.label for p in problems})
    moments = _moments(rows, width, labels)
    solutions = [_started(p, moments, width, labels) for p in problems]
    at = {k: s.beta for k, s in enumerate(solutions) if s.rows}
    best: dict[int, tuple] = {}  # accepted coefficients, their objective, the step from them, and other steps to try
    for number in range(STEPS):
        if not at:
            break
        for k, sums in _summed(rows, at, solutions, width).items():
            solution, beta = solutions[k], at[k]
            value, gradient, curvature = _objective(solution, beta, sums)
            if k in best and not value <= best[k][1] + 1e-14 * abs(best[k][1]):
                accepted, reached, step, *others = best[k]
                step, *others = others or [step / 2]
            else:
                accepted, reached = beta, value
                newton, solution.gradient = _step(solution, beta, gradient, curvature)
                solution.beta, solution.steps = beta, number + 1
                step, *others = [s for s in (newton, _reweighted(solution, beta, sums)) if s is not None] or [-gradient]
            best[k] = (accepted, reached, step, *others)
            at[k] = _bounded(solution, accepted + step)
            if solution.gradient < GRADIENT or np.abs(at[k] - accepted).max() < 1e-14:
                del at[k]
    for solution in solutions:
        if solution.gradient > 1e-6 and solution.rows:
            log.warning("%s stopped at a gradient of %g", solution.problem, solution.gradient)
    return solutions


def coefficient_table(spark: SparkSession, solutions: Sequence[Solution], names: Sequence[str]) -> DataFrame:
    """kind, fold (missing: all rows), feature, coefficient for the feature in its own units; the intercept and,
    for Huber, the scale have rows of their own."""
    rows = []
    for s in solutions:
        values = [*zip(names, s.slopes, strict=True), ("(intercept)", s.intercept)]
        values += [("(scale)", s.scale)] if s.scale is not None else []
        rows += [(s.problem.kind, s.problem.fold, name, float(value)) for name, value in values]
    return spark.createDataFrame(rows, "kind string, fold int, feature string, coefficient double")
