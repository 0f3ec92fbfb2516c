"""Logistic regression by Newton steps against a plain solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltwatch.operators import logistic


def plain(x, y, s, c):
    """Gradient descent with a fixed safe step on the penalised loss, then plain Newton steps."""
    x1 = np.c_[x, np.ones(len(x))]
    w = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x1 @ w))
        g = c * x1.T @ (s * (p - y)) + w
        h = c * (x1 * (s * p * (1 - p))[:, None]).T @ x1 + np.eye(len(w))
        step = np.linalg.solve(h, g)
        value = lambda v: c * (s * (np.logaddexp(0, x1 @ v) - y * (x1 @ v))).sum() + 0.5 * v @ v
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-8:
            t /= 2
        w = w - t * step
    return w


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y, strict=True)], "a double, b double, c double, y int")


@pytest.mark.parametrize("mode, c", [(None, 1.0), ("balanced", 1.0), ("balanced", 0.05), (None, 300.0)])
def test_equals_plain_solver(spark, mode, c):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 3, 1]
    y = (x[:, 0] - 0.4 * x[:, 1] + rng.logistic(size=400) > -2.5).astype(int)
    model = logistic.train(frame(spark, x, y).repartition(5), ["a", "b", "c"], "y", mode, c)
    z = (x - x.mean(0)) / x.std(0)
    s = np.where(y == 1, 400 / (2 * y.sum()), 400 / (2 * (1 - y).sum())) if mode else np.ones(400)
    want = plain(z, y, s, c)
    assert [*model.coefficients, model.intercept] == pytest.approx(want.tolist(), abs=1e-6)
    assert model.steps < 30
    got = logistic.LogisticModel.from_json(model.to_json()).score(frame(spark, x, y), ["a", "y"]).collect()
    p = {round(r.a, 9): r.probability for r in got}
    for row, a in zip(z, x[:, 0], strict=True):
        assert p[round(a, 9)] == pytest.approx(1 / (1 + np.exp(-(row @ want[:-1] + want[-1]))), abs=1e-6)
    assert {r.prediction for r in got} == {0, 1}


def test_edges(spark):
    """Separable data, one class, a constant feature, NULLs and no rows stay finite."""
    x = np.c_[np.arange(20.0), np.ones(20), np.arange(20.0) % 3]
    apart = logistic.train(frame(spark, x, x[:, 0] > 9), ["a", "b", "c"], "y", None, 1.0)
    assert apart.coefficients[0] > 1 and apart.coefficients[1] == 0
    d = frame(spark, x, np.zeros(20)).withColumn("a", F.when(F.col("a") > 3, F.col("a")))
    one = logistic.train(d, ["a", "c"], "y")
    assert all(r.prediction == 0 for r in one.score(d).collect())
    empty = logistic.train(d.limit(0), ["a", "c"], "y")
    assert empty.coefficients == [0.0, 0.0] and {r.probability for r in empty.score(d).collect()} == {0.5}
    with pytest.raises(ValueError, match="Missing features"):
        one.score(d.drop("a"))
