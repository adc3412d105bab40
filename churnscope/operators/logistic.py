"""Logistic regression by damped Newton steps; the intercept is penalised like a weight.

The objective is  |w|^2 / 2 + C * sum_i s_i * log(1 + exp(-y_i * w.x_i)),  with the constant
1 as one of the features.  A step needs the loss, the gradient and the Gram matrix weighted
by s * p * (1 - p): one aggregation over all rows, whose result is a single row of
(k + 1) * (k + 2) / 2 + k + 2 numbers for k features.  The driver solves the k + 1 equations.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class LinearModel:
    """Weights by feature column and an intercept; the score is one expression."""

    columns: list[str]
    coefficients: list[float]
    intercept: float

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for c, w in zip(self.columns, self.coefficients):
            out = out + F.lit(w) * F.col(c)
        return out

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> LinearModel:
        return cls(**json.loads(text))


def _sums(rows: DataFrame, columns: Sequence[str], w: np.ndarray, c: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of the objective at ``w`` (the intercept last)."""
    k = len(columns) + 1
    at = LinearModel(list(columns), [float(v) for v in w[:-1]], float(w[-1]))
    z, s, y = at.margin(), F.col("_s"), F.col("_y")
    # log(1 + exp(z)) - y * z, without an overflow
    loss = s * (F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - y * z)
    p = at.probability()
    parts = rows.select(*columns, F.lit(1.0).alias("_one"), loss.alias("_loss"), (s * (p - y)).alias("_r"), (s * p * (1 - p)).alias("_v"))
    names = [*columns, "_one"]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    got = parts.agg(F.sum("_loss"), *[F.sum(F.col("_r") * F.col(n)) for n in names],
                    *[F.sum(F.col("_v") * F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    values = np.array([v or 0.0 for v in got], float)  # no rows: the penalty alone
    hessian = np.zeros((k, k))
    for (i, j), v in zip(pairs, values[k + 1 :]):
        hessian[i, j] = hessian[j, i] = v
    return float(w @ w / 2 + c * values[0]), w + c * values[1 : k + 1], np.eye(k) + c * hessian


def fit(rows: DataFrame, columns: Sequence[str], label: str, weight: str, c: float = 1.0, tolerance: float = 1e-9, steps: int = 100) -> LinearModel:
    """The minimum of the objective; stops where no component of the gradient passes ``tolerance`` times the rows' weight.

    A step that doesn't lower the loss is halved.  ``rows`` is read once a step, so it should
    be written out before; missing features or labels are the caller's to fill.
    """
    used = rows.select(*columns, F.col(label).cast("double").alias("_y"), F.col(weight).cast("double").alias("_s"))
    scale = max(1.0, float(used.agg(F.sum("_s")).first()[0] or 0.0))
    w = np.zeros(len(columns) + 1)
    loss, gradient, hessian = _sums(used, columns, w, c)
    for _ in range(steps):
        if np.abs(gradient).max() <= tolerance * scale:
            break
        step = np.linalg.solve(hessian, gradient)
        for _ in range(40):
            tried = _sums(used, columns, w - step, c)
            if tried[0] <= loss + 1e-12 * abs(loss):
                break
            step = step / 2
        else:
            break  # as low as the sums' precision allows
        w, (loss, gradient, hessian) = w - step, tried
    return LinearModel(list(columns), [float(v) for v in w[:-1]], float(w[-1]))
