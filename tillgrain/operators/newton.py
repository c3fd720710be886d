"""Logistic regression by Newton steps: one aggregate per step, one small system on the driver.

A step sums the gradient and the Gram matrix of the inputs, weighted by each row's curvature, in
Spark's own aggregates. What comes back is one row of numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps end once no coefficient moves by more than this.
SETTLED = 1e-10


@dataclass(frozen=True)
class Logistic:
    """Probability of the positive label from inputs scaled by ``means`` and ``deviations``."""

    inputs: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def probability(self) -> Column:
        margin = F.lit(self.intercept)
        for name, c, mean, deviation in zip(self.inputs, self.coefficients, self.means, self.deviations):
            margin = margin + (F.col(name).cast("double") - mean) / (deviation or 1.0) * c
        return 1.0 / (1.0 + F.exp(-margin))


def scales(rows: DataFrame, inputs: Sequence[str]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Mean and population deviation of every input."""
    found = rows.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in inputs],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"d_{c}") for c in inputs],
    ).first()
    return tuple(found[f"m_{c}"] for c in inputs), tuple(found[f"d_{c}"] for c in inputs)


def newton_sums(rows: DataFrame, inputs: Sequence[str], label: str, weight: str, beta: Sequence[float]) -> DataFrame:
    """One row: loss, g_i (gradient) and h_i_j (Gram matrix, i <= j) at ``beta``; index 0 is the intercept."""
    x = [F.lit(1.0), *[F.col(c) for c in inputs]]
    margin = sum((F.lit(float(b)) * v for b, v in zip(beta, x)), F.lit(0.0))
    taken = rows.select(
        *inputs, F.col(label).cast("double").alias("_y"), F.col(weight).alias("_w"), margin.alias("_margin")
    ).withColumn("_p", 1.0 / (1.0 + F.exp(-F.col("_margin"))))
    taken = taken.withColumns({"_slope": F.col("_w") * (F.col("_p") - F.col("_y")), "_bend": F.col("_w") * F.col("_p") * (1.0 - F.col("_p"))})
    # log(1 + exp(m)) without overflow.
    loss = F.greatest(F.col("_margin"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_margin"))) - F.col("_y") * F.col("_margin")
    places = range(len(x))
    return taken.agg(
        F.sum(F.col("_w") * loss).alias("loss"),
        *[F.sum(F.col("_slope") * x[i]).alias(f"g_{i}") for i in places],
        *[F.sum(F.col("_bend") * x[i] * x[j]).alias(f"h_{i}_{j}") for i in places for j in places if i <= j],
    )


def newton_steps(
    rows: DataFrame, inputs: Sequence[str], label: str, weight: str, penalty: float = 1.0, most_steps: int = 100
) -> np.ndarray:
    """Intercept and coefficients that minimise the weighted loss and ``penalty / 2`` times their squares.

    The intercept is free of the penalty. A step that raises the objective is halved.
    """
    size = len(inputs) + 1
    free = np.array([0.0, *[penalty] * (size - 1)])
    beta, before, last = np.zeros(size), np.zeros(size), np.inf
    for _ in range(most_steps):
        found = newton_sums(rows, inputs, label, weight, beta).first()
        objective = found["loss"] + float(free @ np.square(beta)) / 2
        if objective > last * (1 + 1e-12) + 1e-12:
            beta = (beta + before) / 2
            continue
        gradient = np.array([found[f"g_{i}"] for i in range(size)]) + free * beta
        bend = np.array([[found[f"h_{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)])
        step = np.linalg.lstsq(bend + np.diag(free), gradient, rcond=None)[0]
        before, last, beta = beta, objective, beta - step
        if np.abs(step).max() <= SETTLED:
            break
    return beta


def fit_logistic(rows: DataFrame, inputs: Sequence[str], label: str, weight: str, penalty: float = 1.0, most_steps: int = 100) -> Logistic:
    """Scale the inputs to mean 0 and deviation 1 and fit; inputs must not be NULL."""
    means, deviations = scales(rows, inputs)
    scaled = rows.select(
        *[((F.col(c).cast("double") - m) / (d or 1.0)).alias(c) for c, m, d in zip(inputs, means, deviations)], label, weight
    )
    beta = newton_steps(scaled, inputs, label, weight, penalty, most_steps)
    return Logistic(tuple(inputs), float(beta[0]), tuple(beta[1:].tolist()), means, deviations)
