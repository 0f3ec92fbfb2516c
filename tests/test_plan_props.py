"""Plan shape and properties."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from conftest import SF001
from voltwatch.config import Columns
from voltwatch.operators import clean, features


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_chain_plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = physical(E.queries()["telemetry_features"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange") == 1  # one shuffle by entity for fill, clip, delta and rolling
    assert p.count("Sort [") == 2
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p


def test_scan_prunes_and_pushes(spark):
    df = E.queries()["drift_summary"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double,props:string>" in p


def test_shuffled_input_same_output(spark):
    from voltwatch.sources.tables import EVENTS, events_telemetry
    ev = events_telemetry(spark, SF001)
    a = features.rolling(clean.impute(ev, EVENTS, ["value"]), EVENTS, ["value"], (6,), ("mean", "std"))
    b = features.rolling(clean.impute(ev.repartition(7, "event_type").sortWithinPartitions("value"), EVENTS,
                                      ["value"]), EVENTS, ["value"], (6,), ("mean", "std"))
    key = ["event_id"]
    pa = a.toPandas().sort_values(key).reset_index(drop=True)
    pb = b.toPandas().sort_values(key).reset_index(drop=True)[pa.columns]
    pd.testing.assert_frame_equal(pa, pb)


CFG = Columns(entity="e", time="t", tie="i")
values = st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=values, b=values, n=st.integers(1, 5))
def test_fill_and_rolling_match_pandas(spark, a, b, n):
    rows = [("A", i, x) for i, x in enumerate(a)] + [("B", i, x) for i, x in enumerate(b)]
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(e, t0 + dt.timedelta(seconds=i), i, x) for e, i, x in rows],
                               "e string, t timestamp_ntz, i long, x double")
    out = features.rolling(clean.impute(df, CFG, ["x"]), CFG, ["x"], (n,), ("mean", "std", "max"))
    got = out.toPandas().sort_values(["e", "i"]).reset_index(drop=True)
    pdf = pd.DataFrame(rows, columns=["e", "i", "x"]).astype({"x": "float64"})
    pdf["x"] = pdf.groupby("e")["x"].ffill()
    pdf["x"] = pdf.groupby("e")["x"].bfill().fillna(0.0)
    # pandas' rolling moments use running sums whose error grows with the
    # largest magnitude seen (e.g. std of [0, 0, 6e-8] after 343 comes out
    # 2.7e-6 in pandas, 3.4e-8 exactly in Spark), so the tolerance scales too
    tol = 1e-6 * max(1.0, float(pdf["x"].abs().max()))
    for s in ("mean", "std", "max"):
        exp = pdf.groupby("e")["x"].transform(lambda v: v.rolling(n, min_periods=1).agg(s)).fillna(0.0)
        assert got[f"Rolling_{s}_{n}_x"].to_numpy() == pytest.approx(exp.to_numpy(), rel=1e-9, abs=tol)
    assert got["x"].to_numpy() == pytest.approx(pdf["x"].to_numpy())
