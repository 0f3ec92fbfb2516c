"""M3: logistic regression by Newton steps over the distributed table.

Minimises 0.5 |w|^2 + C * sum of weighted log losses, the intercept being the
weight of a constant 1 and penalised like the others (the reference's solver
does the same).  A step is one pass: every task adds up its rows' gradient
and Hessian in numpy, the sums by matrix cell are added over the tasks, and
(features + 1)^2 numbers reach the driver, which solves the small system.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.operators import metrics
from voltwatch.plans.layout import materialize

TOLERANCE, MAX_STEPS = 1e-8, 100


@dataclass
class LogisticModel:
    """Scaling and coefficients; scores with column expressions only."""

    features: list[str]
    stats: dict[str, tuple[float, float]]
    coefficients: list[float]
    intercept: float
    steps: int = 0
    params: dict = field(default_factory=dict)

    def score(self, df: DataFrame, keep=()) -> DataFrame:
        """Keep columns, probability of class 1 and prediction; missing features are an error, NULL counts as 0."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"Missing features: {missing}")
        margin = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients, strict=True):
            mean, sd = self.stats[c]
            sd = sd if sd and not math.isnan(sd) else 1.0
            margin = margin + F.lit(w) * ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(mean or 0.0)) / F.lit(sd))
        d = df
        d = d.select(*keep, (1 / (1 + F.exp(-margin))).alias("probability"))
        return d.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "LogisticModel":
        d = json.loads(text)
        return LogisticModel(**{**d, "stats": {k: tuple(v) for k, v in d["stats"].items()}})


def _sums(rows: DataFrame, n: int, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of the weighted log losses at w, over all rows of (x0.., y, weight)."""

    def run(batches):
        total = np.zeros(1 + (n + 1) + (n + 1) ** 2)
        for b in batches:
            x = np.stack([*(b.column(f"x{i}").to_numpy() for i in range(n)), np.ones(b.num_rows)], 1)
            y, s = b.column("y").to_numpy(), b.column("weight").to_numpy()
            m = x @ w
            p = 1 / (1 + np.exp(-np.clip(m, -700, 700)))
            total[0] += (s * (np.logaddexp(0, m) - y * m)).sum()
            total[1 : n + 2] += x.T @ (s * (p - y))
            total[n + 2 :] += (x.T @ (x * (s * p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    found = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v")).collect()
    out = np.zeros(1 + (n + 1) + (n + 1) ** 2)
    for i, v in found:
        out[i] = v
    return out[0], out[1 : n + 2], out[n + 2 :].reshape(n + 1, n + 1)


def train(df: DataFrame, features: list[str], label: str, weight_mode: str | None = "balanced", c: float = 1.0,
          stats: dict | None = None, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> LogisticModel:
    """Fit on scaled features; ``weight_mode`` as in ``metrics.with_weights`` (None: unweighted).

    A step that does not lower the objective is halved.  Rows without a label
    are left out; without rows or with one class the penalty keeps the
    solution finite.
    """
    from voltwatch.operators import ml

    features, n = list(features), len(features)
    d = df.where(F.col(label).isNotNull()).select(*[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in features], F.col(label).cast("double").alias(label))
    stats = stats if stats is not None else ml.scaler_dict(ml.fit_scaler(d, features))
    d = ml.scale(d, stats)
    d = metrics.with_weights(d, label, weight_mode, "_vw_w") if weight_mode else d.withColumn("_vw_w", F.lit(1.0))
    rows = materialize(d.select(*[F.col(x).alias(f"x{i}") for i, x in enumerate(features)], F.col(label).alias("y"), F.col("_vw_w").cast("double").alias("weight")))
    w, steps = np.zeros(n + 1), 0
    loss, g, h = _sums(rows, n, w)
    value = c * loss + 0.5 * w @ w
    while steps < max_steps:
        gradient = c * g + w
        if np.abs(gradient).max() <= tolerance * max(1.0, c):
            break
        move = np.linalg.solve(c * h + np.eye(n + 1), gradient)
        size = 1.0
        while True:
            loss, g, h = _sums(rows, n, w - size * move)
            steps += 1
            new = c * loss + 0.5 * (w - size * move) @ (w - size * move)
            if new <= value + 1e-12 * abs(value) or size < 1e-6 or not math.isfinite(value):
                break
            size /= 2
        w, value = w - size * move, new
        if size * np.abs(move).max() < 1e-12:
            break
    return LogisticModel(features, stats, w[:-1].tolist(), float(w[-1]), steps, {"C": c, "weights": weight_mode})
