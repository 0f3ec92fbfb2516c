"""Tail probabilities against known values and counting, and the monitoring that uses them."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from voltwatch.config import Scale
from voltwatch.functions import tails
from voltwatch.operators import drift, metrics


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(column).collect()]


def test_kolmogorov(spark):
    """Table values, and both series where they meet."""
    cases = {0.0: 1.0, 0.005: 1.0, 0.1: 1.0, 0.5: 0.963945, 0.828: 0.499, 1.0: 0.270000, 1.179: 0.1240, 1.18: 0.1235, 1.36: 0.0495, 1.63: 0.0098, 3.0: 3.05e-8, 40.0: 0.0}
    got = values(spark, [(x,) for x in cases], "x double", tails.kolmogorov_tail(F.col("x")))
    for x, g in zip(cases, got, strict=True):
        assert g == pytest.approx(cases[x], abs=6e-4 if cases[x] < 0.96 else 1e-6)
    series = lambda x: sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 200))
    xs = [0.3 + 0.05 * i for i in range(40)]
    assert values(spark, [(x,) for x in xs], "x double", tails.kolmogorov_tail(F.col("x"))) == pytest.approx([series(x) for x in xs], abs=1e-12)


def by_counting(d, n, m):
    """Share of all orderings of n and m values whose largest gap is at least d."""
    hits = total = 0
    for places in itertools.combinations(range(n + m), n):
        own, i, j, gap = set(places), 0, 0, 0.0
        for k in range(n + m):
            i, j = (i + 1, j) if k in own else (i, j + 1)
            gap = max(gap, abs(i / n - j / m))
        hits, total = hits + (gap >= d - 1e-12), total + 1
    return hits / total


def test_ks_exact(spark):
    cases = [(d, n, m) for n, m in ((1, 1), (3, 3), (2, 5), (6, 4), (1, 7)) for d in (0.0, 1 / 3, 0.5, 2 / 3, 1.0)]
    got = values(spark, cases, "d double, n long, m long", tails.ks_tail(F.col("d"), F.col("n"), F.col("m")))
    assert got == pytest.approx([1.0 if d == 0 else by_counting(d, n, m) for d, n, m in cases], abs=1e-12)
    near = values(spark, [(0.2, 100, 100), (0.2, 101, 100)], "d double, n long, m long", tails.ks_tail(F.col("d"), F.col("n"), F.col("m")))
    assert near[0] == pytest.approx(0.03638, abs=2e-4) and near[1] == pytest.approx(near[0], abs=6e-3)  # exact, then asymptotic


def test_chi2_tail(spark):
    cases = [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (0.0, 4, 1.0), (2.0, 2, math.exp(-1)), (6.634896601, 1, 0.01), (124.3421, 100, 0.05),
             (1074.6794, 1000, 0.05), (10232.737, 10_000, 0.0507309), (1e4, 3, 0.0), (5.0, 0, None), (9.0, 4, math.exp(-4.5) * 5.5)]
    got = values(spark, [c[:2] for c in cases], "x double, k long", tails.chi2_tail(F.col("x"), F.col("k")))
    for g, (_, _, want) in zip(got, cases, strict=True):
        assert g is None if want is None else g == pytest.approx(want, abs=1e-6)


def test_log_gamma(spark):
    xs = [0.5, 1.0, 1.5, 2.0, 7.25, 50.0, 5000.0]
    assert values(spark, [(x,) for x in xs], "x double", tails.log_gamma(F.col("x"))) == pytest.approx([math.lgamma(x) for x in xs], abs=1e-9)


def test_equal_samples_do_not_drift(spark):
    """The same values on both sides: statistic 0, p = 1, no trigger, at exact and asymptotic sizes."""
    for n in (20, 300):
        d = spark.createDataFrame([(float(i % 97),) for i in range(n)], "x double")
        r = drift.drift_ks(d, d, ["x"]).first()
        assert r.ks_stat == 0 and r.ks_p == 1.0
        scored = d.selectExpr("TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "int(x % 2) AS y", "int(x % 2) AS p")
        perf = drift.performance_by_period(scored, "ts", "y", "p")
        t = drift.triggers(drift.drift_summary(d, d, ["x"]), drift.drift_psi(d, d, ["x"]), drift.drift_ks(d, d, ["x"]), perf).first()
        assert not t.retrain and t.reasons == ""


def test_dead_sensor_triggers(spark):
    """All NULL, or no rows at all, on the current side."""
    ref = spark.createDataFrame([(float(i), float(i)) for i in range(30)], "x double, y double")
    cur = spark.createDataFrame([(None, float(i)) for i in range(30)], "x double, y double")
    scored = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 1)], "ts timestamp_ntz, y int, p int")
    perf = drift.performance_by_period(scored, "ts", "y", "p")
    for now, dead in ((cur, 1), (cur.limit(0), 2)):
        s = drift.drift_summary(ref, now, ["x", "y"])
        assert {r.feature: r.no_data for r in s.collect()} == {"x": True, "y": dead == 2}
        t = drift.triggers(s, drift.drift_psi(ref, now, ["x", "y"]), drift.drift_ks(ref, now, ["x", "y"]), perf).first()
        assert t.retrain and t.reasons == "no_data" and t.no_data_features == dead


def scored_days(spark, days=4, rows=200):
    rng = random.Random(3)
    out = []
    for day in range(days):
        for _ in range(rows):
            y = int(rng.random() < 0.3)
            s = round(rng.random() + (0.8 - 0.3 * day) * y, 2)
            out.append((dt.datetime(2024, 1, 1 + day, rng.randrange(24)), y, s, int(s > 0.7)))
    out += [(dt.datetime(2024, 2, 1), 1, 0.5, 0), (dt.datetime(2024, 2, 2), 0, None, None), (None, 1, 0.2, 0), (None, 0, 0.1, 0)]
    return spark.createDataFrame(out, "ts timestamp_ntz, y int, s double, p int")


@pytest.mark.parametrize("scale", [Scale(), Scale(hot_entity_rows=30)])
def test_areas_by_period(spark, scale):
    """Every period's areas are those of its rows alone, whether or not it is cut into segments."""
    d = scored_days(spark)
    got = {r.period_start: r for r in drift.performance_by_period(d, "ts", "y", "p", score="s", pr_baseline=0.8, scale=scale).collect()}
    assert len(got) == 7
    for start, r in got.items():
        own = d.where(F.date_trunc("day", "ts").cast("timestamp_ntz").eqNullSafe(F.lit(start).cast("timestamp_ntz")))
        want = metrics.ranking_metrics(own, "s", "y").first()
        assert r.roc_auc == (None if want.roc_auc is None else pytest.approx(want.roc_auc, abs=1e-12))
        assert r.pr_auc == (None if want.pr_auc is None else pytest.approx(want.pr_auc, abs=1e-12))
        assert r.pr_alarm == (r.pr_auc is not None and (0.8 - r.pr_auc) / 0.8 > 0.1)
    assert got[dt.datetime(2024, 2, 1)].roc_auc is None and got[dt.datetime(2024, 2, 1)].fn_rate == 1.0
    assert got[dt.datetime(2024, 2, 2)].fn_rate is None


def test_performance_triggers(spark):
    d = scored_days(spark)
    same = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    drifts = [drift.drift_summary(same, same, ["x"]), drift.drift_psi(same, same, ["x"]), drift.drift_ks(same, same, ["x"])]
    first = d.where("ts < '2024-01-02'")
    base = metrics.ranking_metrics(first, "s", "y").first().pr_auc
    fn = drift.performance_by_period(first, "ts", "y", "p").first().fn_rate
    quiet = drift.triggers(*drifts, drift.performance_by_period(first, "ts", "y", "p", score="s", pr_baseline=base), recall_floor=0.1, fn_baseline=fn).first()
    assert not quiet.retrain
    loud = drift.triggers(*drifts, drift.performance_by_period(d, "ts", "y", "p", score="s", pr_baseline=base), recall_floor=0.0, fn_baseline=fn).first()
    assert loud.reasons == "fn_rate,pr_auc"
    wide = spark.createDataFrame([(float(i), float(i + 300), float(i)) for i in range(200)], "a double, b double, c double")
    then = wide.select("a", (F.col("b") - 300).alias("b"), "c")
    ks = drift.drift_ks(then, wide, ["a", "b", "c"])
    assert [drift.triggers(*drifts[:2], ks, drift.performance_by_period(first, "ts", "y", "p"), recall_floor=0.0, fn_baseline=fn, ks_share=x).first().trigger_ks for x in (0.0, 0.3, 0.4)] == [True, True, False]
