"""Mergeable statistics against exact ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltwatch.operators import drift, sketches
from voltwatch.streaming import streams as S


def exact_std(x):
    return np.std(x, ddof=1) if len(x) > 1 else None


def test_days_merge_into_the_whole(spark):
    """Any split into parts gives the statistics of all values; NULL, NaN and empty parts included."""
    rng = random.Random(2)
    rows = [(i % 9, None if i % 13 == 0 else float("nan") if i % 31 == 0 else 1e6 + rng.gauss(0, 3), 4.0 if i % 9 else None) for i in range(900)]
    d = spark.createDataFrame(rows, "day int, x double, y double")
    got = {r.feature: r for r in sketches.merge(sketches.sketch(d, ["x", "y"], ["day"])).select("*", sketches.std().alias("std"), sketches.quantile([0.0, 0.5, 0.95]).alias("q")).collect()}
    x = np.array(sorted(v for _, v, _ in rows if v is not None and v == v))
    r = got["x"]
    assert (r.n, r.n + r.nulls, r.min, r.max) == (len(x), 900, x[0], x[-1])
    assert r["mean"] == pytest.approx(x.mean(), abs=1e-9) and r["std"] == pytest.approx(exact_std(x), abs=1e-9)
    assert r.q == [x[0], x[-(-len(x) // 2) - 1], x[int(np.ceil(0.95 * len(x))) - 1]]
    assert got["y"].n == 800 and got["y"]["std"] == 0 and got["y"].q == [4.0] * 3
    dead = sketches.sketch(d.where("day = 0"), ["y"]).select("n", "mean", "m2", sketches.std().alias("s"), sketches.quantile(0.5).alias("q")).first()
    assert tuple(dead) == (0, None, None, None, None)


def test_size_and_rank_error(spark):
    """A sketch of 200 times K values stays small; ranks are within the stated error, also after merging."""
    k, n = 256, 51_200
    d = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"), (F.col("id") % 40).alias("part"))
    parts = sketches.sketch(d, ["v"], ["part"], k)
    whole = sketches.merge(parts, k=k).select("*", F.octet_length("sketch").alias("bytes"), sketches.quantile([i / 20 for i in range(1, 20)]).alias("q")).first()
    one = sketches.sketch(d, ["v"], k=k).select(F.octet_length("sketch").alias("bytes")).first()
    assert whole.n == n and max(whole.bytes, one.bytes) < 8 * k * 5
    assert max(abs(x / n - i / 20) for i, x in enumerate(whole.q, 1)) < 2.0 / k * 2


def test_compare_with_exact_drift(spark):
    rng = random.Random(7)
    ref = spark.createDataFrame([(rng.gauss(0, 1), float(i % 50)) for i in range(1500)], "x double, y double")
    cur = spark.createDataFrame([(rng.gauss(0.4, 1.2), float(i % 50)) for i in range(1200)], "x double, y double")
    got = {r.feature: r for r in sketches.compare(sketches.sketch(ref, ["x", "y"]), sketches.sketch(cur, ["x", "y"])).collect()}
    ks = {r.feature: r for r in drift.drift_ks(ref, cur, ["x", "y"]).collect()}
    psi = {r.feature: r.psi for r in drift.drift_psi(ref, cur, ["x", "y"]).collect()}
    for f in ("x", "y"):
        assert abs(got[f].ks_gap - ks[f].ks_stat) <= 1 / sketches.GRID + 1e-9
        assert got[f].psi == pytest.approx(psi[f], abs=0.01)
        assert not got[f].mean_drift and not got[f].no_data
    assert got["x"].ks_p < 1e-6 and got["y"].ks_p == pytest.approx(1.0)
    far = sketches.compare(sketches.sketch(ref, ["x"]), sketches.sketch(ref.withColumn("x", F.col("x") + 9), ["x"])).first()
    assert far.mean_drift and far.ks_gap == 1.0
    dead = sketches.compare(sketches.sketch(ref, ["x"]), sketches.sketch(ref.withColumn("x", F.lit(None).cast("double")), ["x"])).first()
    assert dead.no_data and dead.psi is None and dead.ks_p is None and dead.cur_median is None


def test_window_quantile_by_sketch(spark):
    """Bounded state gives a value of the window at the exact rank while it is small."""
    d = spark.range(600).select((F.col("id") * 37 % 600).cast("double").alias("v"), F.timestamp_add("SECOND", F.col("id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("ts"))
    a = {r.window_start: (r.p95, r.events) for r in S.value_quantile(d, "ts", "v", exact=False).collect()}
    b = {r.window_start: (r.v, r.n) for r in S.windowed(d, "ts", "5 minutes", "1 minute", [F.sort_array(F.collect_list("v")).alias("all"), F.count("v").alias("n")]).select(
        "window_start", F.expr("all[cast(ceil(0.95 * n) - 1 as int)]").alias("v"), "n").collect()}
    assert a == b and len(a) == 14
