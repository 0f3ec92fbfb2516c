"""Known answers (hand-computed cases of the blueprint) and edge rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltwatch.config import Columns
from voltwatch.operators import clean, drift, features, labels, metrics
from voltwatch.plans.featureset import FeatureSpec, feature_pipeline

CFG = Columns(entity="e", time="t", tie="i", sensors=("x",), label="y")
T0 = dt.datetime(2024, 1, 1)


def series(spark, xs, entity="A"):
    rows = [(entity, T0 + dt.timedelta(seconds=10 * i), i, x) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "e string, t timestamp_ntz, i long, x double")


def col(df, name):
    return [r[0] for r in df.orderBy("i").select(name).collect()]


def test_clean_and_features_chain(spark):
    df = series(spark, [None, 10.0, None, 16.0, 12.0])
    filled = clean.impute(df, CFG, ["x"], "ffill")
    assert col(filled, "x") == [10, 10, 10, 16, 12]
    clipped = clean.clip_quantiles(filled, CFG, ["x"])
    assert col(clipped, "x") == pytest.approx([10, 10, 10, 15.84, 12])
    d = features.delta(clipped, CFG, ["x"])
    assert col(d, "Delta_1_x") == pytest.approx([0, 0, 0, 5.84, -3.84])
    r = features.rolling(clipped, CFG, ["x"], (3,), ("mean", "std"))
    assert col(r, "Rolling_mean_3_x") == pytest.approx([10, 10, 10, 11.946667, 12.613333], abs=1e-6)
    assert col(r, "Rolling_std_3_x") == pytest.approx([0, 0, 0, 3.371726, 2.967917], abs=1e-6)
    spec = FeatureSpec(fill=("x",), clip=("x",), delta=("x",), rolling=("x",), windows=(3,), stats=("mean", "std"))
    full = feature_pipeline(df, CFG, spec)
    assert col(full, "Rolling_std_3_x") == pytest.approx([0, 0, 0, 3.371726, 2.967917], abs=1e-6)


def test_edges(spark):
    df = series(spark, [None, None, None], "Z").unionByName(series(spark, [5.0], "Q"))
    out = clean.impute(df, CFG, ["x", "absent"], "ffill")
    assert sorted(r[0] for r in out.select("x").collect()) == [0, 0, 0, 5]
    one = series(spark, [7.0])
    assert col(features.delta(one, CFG, ["x"]), "Delta_1_x") == [0]
    assert col(features.rolling(one, CFG, ["x"], (6,), ("std",)), "Rolling_std_6_x") == [0]
    with pytest.raises(ValueError):
        clean.impute(df, CFG, ["x"], "spline")
    assert clean.impute(df, CFG, ["absent"], "mean").columns == df.columns
    with pytest.raises(ValueError):
        features.rolling(one, CFG, ["x"], (3,), ("kurt",))


def test_global_fill_variants(spark):
    df = series(spark, [None, 2.0, None, 4.0])
    g = CFG.with_(entity=None)
    assert col(clean.impute(df, g, ["x"], "ffill"), "x") == [2, 2, 2, 4]
    assert col(clean.impute(df, g, ["x"], "mean"), "x") == [3, 2, 3, 4]
    assert col(clean.impute(df, g, ["x"], "median"), "x") == [3, 2, 3, 4]


@pytest.mark.parametrize("pairs,roc,pr", [
    ([(.9, 1), (.8, 0), (.7, 1), (.7, 0), (.3, 1), (.1, 0)], 0.611111, 0.683333),
    ([(.9, 0), (.8, 1), (.7, 1), (.3, 0)], 0.5, 0.416667),
    ([(.9, 0), (.9, 1), (.7, 1), (.3, 0)], 0.625, 0.666667),
])
def test_ranking_metrics(spark, pairs, roc, pr):
    df = spark.createDataFrame(pairs, "s double, y int")
    r = metrics.ranking_metrics(df, "s", "y").first()
    assert r["roc_auc"] == pytest.approx(roc, abs=1e-6)
    assert r["pr_auc"] == pytest.approx(pr, abs=1e-6)


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(.5, 1), (.4, 1)], "s double, y int")
    r = metrics.ranking_metrics(df, "s", "y").first()
    assert r["roc_auc"] is None and r["pr_auc"] is None


def test_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(10)], "id long, y int")
    assert metrics.class_counts(df, "y").first()["positive_weight"] == 4
    w = metrics.with_weights(df, "y", "balanced")
    got = {r["y"]: r["weight"] for r in w.select("y", "weight").distinct().collect()}
    assert got == {0: pytest.approx(0.625), 1: pytest.approx(2.5)}
    assert w.agg(F.sum("weight")).first()[0] == pytest.approx(10)


def test_confusion_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    rep = {r["class"]: r for r in metrics.report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0 and rep["1"]["recall"] == 0 and rep["accuracy"]["f1"] == 1


def test_onsets(spark):
    ys = [1, 0, 0, 1, 1, 0, 1]
    df = spark.createDataFrame([("A", T0 + dt.timedelta(seconds=i), i, y) for i, y in enumerate(ys)],
                               "e string, t timestamp_ntz, i long, y int")
    out = features.onsets(df, CFG)
    assert [i + 1 for i, v in enumerate(col(out, "is_onset")) if v] == [4, 7]


def test_horizon_label(spark):
    rows = [("A", T0 + dt.timedelta(seconds=s), s) for s in range(0, 2400, 10)]
    df = spark.createDataFrame(rows, "e string, t timestamp_ntz, i long")
    ev = spark.createDataFrame([("A", T0 + dt.timedelta(seconds=2000))], "e string, event_time timestamp_ntz")
    out = labels.horizon_label(df, CFG, ev, 1200, 30).where("horizon_label = 1")
    secs = sorted(r[0] for r in out.select("i").collect())
    assert secs[0] == 770 and secs[-1] == 1960 and len(secs) == 120


def test_psi_identical_is_zero_and_ks_symmetric(spark):
    df = spark.createDataFrame([(float(i % 37),) for i in range(500)], "x double")
    assert drift.drift_psi(df, df, ["x"]).first()["psi"] == pytest.approx(0.0)
    other = spark.createDataFrame([(float(i % 41) + 0.5,) for i in range(300)], "x double")
    a = drift.drift_ks(df, other, ["x"]).first()["ks_stat"]
    b = drift.drift_ks(other, df, ["x"]).first()["ks_stat"]
    assert a == pytest.approx(b)


def test_clip_idempotent_and_fill_leaves_no_null(spark):
    from conftest import SF001
    from voltwatch.sources.tables import EVENTS, events_telemetry
    ev = events_telemetry(spark, SF001)
    once = clean.clip_quantiles(clean.impute(ev, EVENTS, ["value"]), EVENTS, ["value"])
    assert once.where(F.col("value").isNull()).count() == 0
    lo_hi = once.groupBy("user_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    twice = clean.clip_quantiles(once, EVENTS, ["value"])
    j = twice.groupBy("user_id").agg(F.min("value").alias("lo2"), F.max("value").alias("hi2")).join(lo_hi, "user_id")
    assert j.where("lo2 < lo - 1e-9 OR hi2 > hi + 1e-9").count() == 0
