"""Drift and monitoring on tiny cases with hand-computed answers."""

import datetime as dt

import pytest

from voltwatch.operators import drift


def test_ks_statistic(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    cur = spark.createDataFrame([(2.0,), (3.0,), (4.0,)], "x double")
    r = drift.drift_ks(ref, cur, ["x"]).first()
    assert r["ks_stat"] == pytest.approx(1 / 3) and r["n_ref"] == 3 and r["n_cur"] == 3
    assert 0.0 <= r["ks_p"] <= 1.0


def test_chi2_two_by_two(spark):
    ref = spark.createDataFrame([("a",)] * 10 + [("b",)] * 20, "c string")
    cur = spark.createDataFrame([("a",)] * 20 + [("b",)] * 10, "c string")
    r = drift.drift_chi2(ref, cur, ["c"]).first()
    assert r["chi2"] == pytest.approx(4 * 25 / 15) and r["dof"] == 1
    assert r["p_value"] == pytest.approx(0.009823, abs=1e-5)


def test_mean_shift_flag_and_triggers(spark):
    ref = spark.createDataFrame([(float(x),) for x in (9, 10, 11, 10, 9, 11)], "x double")
    cur = spark.createDataFrame([(float(x),) for x in (19, 20, 21, 20)], "x double")
    s = drift.drift_summary(ref, cur, ["x"]).first()
    assert s["mean_drift"] and s["ref_median"] == 10 and s["cur_mean"] == 20
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, 1, 1), (t0, 1, 0), (t0 + dt.timedelta(days=1), 1, 1)]
    scored = spark.createDataFrame(rows, "ts timestamp_ntz, y int, p int")
    perf = drift.performance_by_period(scored, "ts", "y", "p", "1 day")
    got = {r["period_start"].day: (r["recall"], r["recall_alarm"]) for r in perf.collect()}
    assert got == {1: (0.5, True), 2: (1.0, False)}
    trig = drift.triggers(drift.drift_summary(ref, cur, ["x"]), drift.drift_psi(ref, cur, ["x"]),
                          drift.drift_ks(ref, cur, ["x"]), perf).first()
    assert trig["retrain"] and "mean_shift" in trig["reasons"] and "recall" in trig["reasons"]


def test_side_without_values(spark):
    """A dead sensor gives NULL statistics; NULL is a category of its own."""
    from voltwatch.operators import drift
    ref = spark.createDataFrame([(float(i), "a" if i % 2 else None) for i in range(20)], "x double, c string")
    cur = spark.createDataFrame([(None, "a"), (None, None), (None, "b")], "x double, c string")
    ks = drift.drift_ks(ref, cur, ["x"]).first()
    assert ks.ks_stat is None and ks.ks_p is None and (ks.n_ref, ks.n_cur) == (20, 0)
    assert drift.drift_psi(ref, cur, ["x"]).first().psi is None
    chi = drift.drift_chi2(ref, cur, ["c"]).first()
    assert chi.dof == 2 and chi.chi2 > 0


def test_dead_reference_side_at_any_size(spark):
    """The report keeps a feature whose reference is all NULL or empty, whichever way its quantiles are computed."""
    from voltwatch.config import Scale
    from voltwatch.operators.quantiles import exact_quantiles
    ref = spark.createDataFrame([(None, float(i)) for i in range(20)], "x double, y double")
    cur = spark.createDataFrame([(float(i), float(i)) for i in range(20)], "x double, y double")
    for scale in (Scale(), Scale(hot_entity_rows=1)):
        got = {r.feature: r.psi for r in drift.drift_psi(ref, cur, ["x", "y"], scale=scale).collect()}
        assert got.keys() == {"x", "y"} and got["x"] is None and got["y"] == pytest.approx(0.0)
        assert {r.psi for r in drift.drift_psi(ref.limit(0), cur, ["x", "y"], scale=scale).collect()} == {None}
    rows = {r.g: (r.x, r.y) for r in exact_quantiles(ref.selectExpr("int(y) % 2 AS g", "x", "y"), ["g"], ["x", "y"], [0.5]).collect()}
    assert rows == {0: (None, [9.0]), 1: (None, [10.0])}
    dead = exact_quantiles(ref.selectExpr("IF(y < 5, NULL, 1) AS g", "x"), ["g"], ["x"], [0.5]).collect()
    assert sorted(map(str, dead)) == ["Row(g=1, x=None)", "Row(g=None, x=None)"]
